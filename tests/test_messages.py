import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from postalspark.operators import messages as om
from postalspark.operators.pacing import paced
from postalspark.operators.scan import global_row_number, running_total


def simulate(oks, delay=1.0):
    """Brute force: walk one consumer's outcomes as the sequential consumer loop does."""
    consecutive, mult, clock, out = 0, 1.0, 0.0, []
    for ok in oks:
        start = clock
        if ok:
            consecutive, mult, pause = 0, 1.0, delay
        else:
            consecutive += 1
            if consecutive >= 3:
                mult = min(mult * 2.0, 10.0)
                pause = delay * mult
                consecutive = 0
            else:
                pause = delay * 1.5
        gap = max(pause, delay * mult)  # the rate gate before the next request
        out.append((start, gap))
        clock += gap
    return out


def test_pacing_matches_sequential_consumer(spark):
    rnd = random.Random(3)
    rows = []
    seq = 0
    for consumer in range(4):
        for _ in range(rnd.randint(20, 120)):
            seq += rnd.randint(1, 5)
            rows.append((seq, consumer, rnd.random() < 0.45))
    df = spark.createDataFrame(rows, "seq long, consumer long, ok boolean")
    got = {r.seq: (r.start, r.pause) for r in om.pacing_schedule(df).collect()}
    for consumer in range(4):
        mine = [r for r in rows if r[1] == consumer]
        for (s, _, _), (start, gap) in zip(mine, simulate([r[2] for r in mine])):
            assert math.isclose(got[s][0], start) and math.isclose(got[s][1], gap), (consumer, s)


@pytest.mark.parametrize("batch,ranges", [(1, 3), (7, 9), (10_000, 5)])
def test_the_fold_equals_the_walk_over_any_cut(spark, batch, ranges):
    rnd = random.Random(batch)
    rows = [(i, rnd.choice([1, 1, 1, 2, 3, None, 4 + i // 300]), rnd.choice([True, False, False, False, None] if i % 900 > 500 else [True, False])) for i in range(2400)]
    df = spark.createDataFrame(rows, "seq long, consumer long, ok boolean")
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, str(batch))
    try:
        got = {r.seq: (r.start, r.pause, r.k) for r in paced(df, 2.0, ranges=ranges).collect()}
    finally:
        spark.conf.set(size, before)
    assert len(got) == len(rows)
    for consumer in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == consumer]
        k = 0
        for (s, _, ok), (start, gap) in zip(mine, simulate([bool(r[2]) for r in mine], 2.0), strict=True):
            k = 0 if ok else k + 1
            assert got[s] == (start, gap, k), (consumer, s)


def test_pauses_of_a_run_add_up(spark):
    from postalspark.operators.pacing import Pauses
    import numpy as np
    p = Pauses(1.0)
    got = [r for r in spark.range(60).select("id", p.pause_of(F.col("id")).alias("one"), p.paused(F.col("id")).alias("all")).orderBy("id").collect()]
    ones = p.pause(np.arange(60))
    assert [r.one for r in got] == ones.tolist() and [r["all"] for r in got] == [float(ones[1:i + 1].sum()) for i in range(60)]


def test_one_range_shuffle_and_one_checkpoint(spark):
    df = spark.range(5000).select(F.col("id").alias("seq"), (F.col("id") % 7).alias("consumer"), (F.col("id") % 3 == 0).alias("ok"))
    plan = om.pacing_schedule(df)._jdf.queryExecution().executedPlan().toString()
    # rows are read from the checkpoint and joined with the broadcast states: no shuffle of rows is left
    assert plan.count("ExistingRDD") >= 1 and "SortMergeJoin" not in plan and plan.count("rangepartitioning") == 0


def test_streaks(spark):
    oks = [False, False, False, False, True, False, False, False, False, False, False]
    df = spark.createDataFrame([(i, 1, ok) for i, ok in enumerate(oks)], "seq long, consumer long, ok boolean")
    got = om.failure_streaks(df).orderBy("seq").collect()
    assert [r.streak for r in got] == [1, 2, 3, 1, 0, 1, 2, 3, 1, 2, 3]
    assert [r.paused for r in got] == [False, False, True, False, False, False, False, True, False, False, True]


def test_base_delay_has_one_second_floor():
    assert om.base_delay(5.0) == 1.0
    assert om.base_delay(0.5) == 2.0


def test_scans_match_windows(spark):
    rnd = random.Random(11)
    rows = [(rnd.randint(0, 10**9), rnd.choice([1, 2, 3]), rnd.randint(-5, 9)) for _ in range(3000)]
    rows = list({r[0]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "k long, g int, v long")
    w = Window.partitionBy("g").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = {r.k: r.s for r in df.select("k", F.sum("v").over(w).alias("s")).collect()}
    got = {r.k: r.s for r in running_total(df, "k", F.col("v"), "s", partition_by=["g"], ranges=7).collect()}
    assert got == want
    rn = {r.k: r.rn for r in global_row_number(df, "k", ranges=5).collect()}
    assert rn == {k: i + 1 for i, k in enumerate(sorted(r[0] for r in rows))}


def test_scan_ranges_follow_the_data(spark):
    # one far key leaves the other rows spread over all ranges
    df = spark.range(20_000).union(spark.createDataFrame([(2**62,)], "id long")).withColumn("g", F.lit(1))
    out = global_row_number(df, "id", "rn", partition_by=["g"], ranges=8)
    assert out.agg(F.max("rn"), F.count_distinct("rn")).first()[:] == (20_001, 20_001)
    ranged = df.repartitionByRange(8, "g", "id").groupBy(F.spark_partition_id().alias("b")).count()
    assert ranged.agg(F.max("count")).first()[0] < 6_000


def test_one_consumer_with_a_third_of_the_messages(spark):
    rnd = random.Random(4)
    rows = [(i, 1 if i % 3 == 0 else i % 50, rnd.random() < 0.6) for i in range(3000)]
    got = {r.seq: (r.streak, r.paused) for r in om.failure_streaks(spark.createDataFrame(rows, "seq long, consumer long, ok boolean")).collect()}
    run = {}
    for i, c, ok in rows:
        k = run[c] = 0 if ok else run.get(c, 0) + 1
        assert got[i] == ((0, False) if ok else ((k - 1) % 3 + 1, k % 3 == 0))


def test_text_after_an_object_is_malformed(spark):
    bodies = ['{"cep": "01310100"} xyz', '{"cep": "01310100"}}', '{"cep": "01310100"}], [', '{"cep": "01310100"}, {"a": 1}']
    df = spark.createDataFrame(list(enumerate(bodies)), "seq long, body string")
    assert om.drop_bad_messages(df).count() == 0
    assert {r.reason for r in om.dead_letters(df).collect()} == {"malformed"}


def test_message_intake(spark):
    df = spark.createDataFrame([(1, '{"cep": "01310100"}'), (2, "{bad"), (3, '{"other": 1}'), (4, '{"cep": ""}'),
                                (5, "[1]"), (6, '{"cep": "01001900"}')], "seq long, body string")
    assert [r.cep for r in om.drop_bad_messages(df).orderBy("seq").collect()] == ["01310100", "01001900"]
    assert {r.seq: r.reason for r in om.dead_letters(df).collect()} == {2: "malformed", 5: "not_an_object"}
    assert [r.seq for r in om.process_limit(om.drop_bad_messages(df), 1).collect()] == [1]


def test_publish_and_backlog(spark):
    valid = spark.createDataFrame([(1, "01310100"), (2, "01001900")], "seq long, cep string")
    pub = om.publish_messages(valid)
    assert [r.value for r in pub.orderBy("seq").collect()] == ['{"cep": "01310100"}', '{"cep": "01001900"}']
    r = om.publish_reconcile(valid, pub).first()
    assert (r.valid, r.published, r.complete, r.missing) == (2, 2, True, 0)
    r = om.publish_reconcile(valid, pub.where("seq = 1")).first()  # a message got lost on the way
    assert (r.valid, r.published, r.complete, r.missing) == (2, 1, False, 1)
    assert om.backlog(pub, pub.where("seq = 1")).first().backlog == 1


def test_consumer_stop_point_and_backlog(spark):
    bodies = ['{"cep": "01310100"}', "{bad", '{"cep": "01001900"}', '{"x": 1}', '{"cep": "20040020"}',
              '{"cep": "30130100"}', "{bad", '{"cep": "40020100"}']
    m = spark.createDataFrame([(i + 1, b) for i, b in enumerate(bodies)], "seq long, body string")
    kept = om.drop_bad_messages(m)
    taken = sorted(r.seq for r in om.consumed_until(m, kept, 3).collect())
    assert taken == [1, 2, 3, 4, 5]          # stops after the third usable message (seq 5)
    assert om.backlog(m, om.consumed_until(m, kept, 3)).first().backlog == 3
    assert om.backlog(m, m.select("seq")).first().backlog == 0   # after a purge
    assert sorted(r.seq for r in om.consumed_until(m, kept, None).collect()) == list(range(1, 9))
