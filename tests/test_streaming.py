import pytest
from pyspark.sql import functions as F

from postalspark import fixtures as fx
from postalspark.operators import lookup as ol
from postalspark.operators import messages as om
from postalspark.operators.pacing import Pauses, fold_ranges
from postalspark.session import scratch_dir
from postalspark.streaming import enrich as se
from postalspark.streaming import queue as sq
from postalspark.streaming import sources as ss
from postalspark.streaming import streaks as sk

NOW = "2024-01-01 00:00:00"


def enriched(spark, root, responses, place, ckpt, cap=0, **more):
    return se.stream_enrich(spark, sq.stream_queue(spark, root, cap), responses, place, ckpt, NOW, **more)


def places(spark):
    return scratch_dir(spark, "queue"), scratch_dir(spark, "table"), scratch_dir(spark, "ckpt")


def outcome(spark, table, m):
    return ({r.cep: r.logradouro for r in table.read().collect()}, sorted(r.cep for r in se.error_rows(table).collect()),
            sorted(r.seq for r in se.dead_rows(table, m).collect()))


def wanted(m, responses):
    kept = om.drop_bad_messages(m)
    return ({r.cep: r.logradouro for r in ol.process_codes(kept, responses, NOW).collect()}, sorted(r.seq for r in om.dead_letters(m).collect()))


def test_stream_enrich_equals_batch_and_survives_restart(spark, sf_small):
    m, responses = fx.view(spark, sf_small, "messages"), fx.view(spark, sf_small, "responses")
    root, place, ckpt = places(spark)
    lo, hi = m.agg(F.min("seq"), F.max("seq")).first()
    cut = (lo + hi) // 2
    sq.append_messages(m.where(F.col("seq") <= cut), root)
    enriched(spark, root, responses, place, ckpt, 300)
    sq.append_messages(m.where(F.col("seq") > cut), root)
    table = enriched(spark, root, responses, place, ckpt, 300)
    stored, dead = wanted(m, responses)
    got = outcome(spark, table, m)
    assert got[0] == stored and got[2] == dead
    assert set(got[1]) == {r.cep for r in ol.not_found_codes(om.drop_bad_messages(m), responses).collect()}
    assert table.progress(ckpt).handled == om.drop_bad_messages(m).count()
    # a replayed micro-batch changes nothing
    version, last = table.current_version(), table.progress(ckpt).batch
    se.enrich_handler(spark, se.answer_table(responses), table, NOW, ckpt)(m.limit(5), last)
    assert table.current_version() == version


def test_error_rows_equal_the_batch_ones(spark, sf_small):
    m, responses = fx.view(spark, sf_small, "messages"), fx.view(spark, sf_small, "responses")
    root, place, ckpt = places(spark)
    sq.append_messages(m, root)
    got = se.error_rows(enriched(spark, root, responses, place, ckpt))
    want = ol.not_found_codes(om.drop_bad_messages(m), responses)
    cols = ["cep", "error_type", "error_message", "context"]
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))
    assert {r.timestamp for r in got.collect()} <= {"2024-01-01T00:00:00"}


@pytest.mark.parametrize("limit", [1, 137, 400])
def test_limit_inside_a_batch_stops_exactly_and_the_next_run_goes_on(spark, sf_small, limit):
    m, responses = fx.view(spark, sf_small, "messages"), fx.view(spark, sf_small, "responses")
    order = [r.seq for r in om.drop_bad_messages(m).orderBy("seq").collect()]
    root, place, ckpt = places(spark)
    sq.append_messages(m, root)
    handled = []

    def note(kept, i):
        handled.append([r.seq for r in kept.collect()])

    for run in (1, 2):
        table = enriched(spark, root, responses, place, ckpt, 250, limit=limit, handler=note)
        assert table.progress(ckpt).handled == run * limit
        assert sorted(s for batch in handled for s in batch) == order[:run * limit]
        # dead letters up to the stop point went, the later ones wait
        stop = order[run * limit - 1]
        done = [r.seq for r in se.dead_rows(table, m).collect()]
        first = [r.seq for r in om.dead_letters(m).where(F.col("seq") < stop).collect()]
        assert set(first) <= set(done) and len(done) == len(set(done))
    table = enriched(spark, root, responses, place, ckpt, 250, handler=note)
    assert sorted(s for batch in handled for s in batch) == order
    stored, dead = wanted(m, responses)
    got = outcome(spark, table, m)
    assert got[0] == stored and got[2] == dead


def test_limit_of_nothing_or_more_than_there_is(spark, sf_small):
    m, responses = fx.view(spark, sf_small, "messages"), fx.view(spark, sf_small, "responses")
    n = om.drop_bad_messages(m).count()
    for limit in (0, None, n, n + 5):
        root, place, ckpt = places(spark)
        sq.append_messages(m, root)
        assert enriched(spark, root, responses, place, ckpt, 400, limit=limit).progress(ckpt).handled == n


@pytest.mark.parametrize("lost_at", ["first write", "second write", "merge", "commit", "after commit"])
def test_a_crash_shows_all_of_a_batch_or_none(spark, sf_small, monkeypatch, lost_at):
    from postalspark.sinks.table import AddressTable
    m, responses = fx.view(spark, sf_small, "messages"), fx.view(spark, sf_small, "responses")
    root, place, ckpt = places(spark)
    sq.append_messages(m, root)
    name = {"first write": "attach", "second write": "attach", "merge": "_merge", "commit": "_publish", "after commit": "_publish"}[lost_at]
    nth = {"first write": 3, "second write": 4}.get(lost_at, 2)      # in the second micro-batch
    real, calls = getattr(AddressTable, name), []

    def failing(self, *a, **k):
        calls.append(1)
        if len(calls) == nth:
            if lost_at == "after commit":
                real(self, *a, **k)
            raise OSError("lost")
        return real(self, *a, **k)

    monkeypatch.setattr(AddressTable, name, failing)
    with pytest.raises(Exception, match="lost"):
        enriched(spark, root, responses, place, ckpt, 400)
    monkeypatch.undo()
    # what a reader sees now: whole batches of the table, the errors and the dead letters
    table = AddressTable(spark, place)
    seen = table.progress(ckpt).batch
    assert seen == (1 if lost_at == "after commit" else 0)
    part = m.orderBy("seq").limit(400 * (seen + 1))
    stored, dead = wanted(part, responses)
    got = outcome(spark, table, m)
    assert got[0] == stored and got[2] == dead
    table = enriched(spark, root, responses, place, ckpt, 400)
    stored, dead = wanted(m, responses)
    got = outcome(spark, table, m)
    assert got[0] == stored and got[2] == dead


def test_rows_are_admitted_by_position_whatever_files_hold(spark, sf_small):
    m = fx.view(spark, sf_small, "messages")
    n = m.count()
    root, _, ckpt = places(spark)
    out = scratch_dir(spark, "cap_out")
    lo, hi = m.agg(F.min("seq"), F.max("seq")).first()
    first = m.where(F.col("seq") <= lo + (hi - lo) // 3)
    sq.append_messages(first, root)
    a = first.count()
    assert [r.rows for r in se.batch_sizes(spark, sq.stream_queue(spark, root, 97), out, ckpt).orderBy("batch_id").collect()] == [97] * (a // 97) + [a % 97] * (a % 97 > 0)
    before = -(-a // 97)
    for part in (m.where(F.col("seq").between(lo + (hi - lo) // 3 + 1, lo + (hi - lo) // 2)), m.where(F.col("seq") > lo + (hi - lo) // 2)):
        assert sq.append_messages(part, root) <= n
    # a restarted consumer goes on where it was, over the ends of files and arrivals
    got = se.batch_sizes(spark, sq.stream_queue(spark, root, 97), out, ckpt).orderBy("batch_id").collect()
    assert [r.rows for r in got[before:]] == [97] * ((n - a) // 97) + [(n - a) % 97] * ((n - a) % 97 > 0)
    assert all(x.last_seq < y.first_seq for x, y in zip(got, got[1:], strict=False)) and sum(r.rows for r in got) == n
    rows = spark.read.format("parquet").load(f"{root}/data/*").count()
    assert rows == n


def test_a_trigger_of_the_rate_cap_is_one_stage(spark, sf_small, monkeypatch):
    # what a trigger costs comes again for every `cap` rows of a backlog
    m, ran = fx.view(spark, sf_small, "messages"), []
    parts, tracker = [m.where(F.col("seq") % 2 == i) for i in (0, 1)], spark.sparkContext.statusTracker()

    def triggers(stream, handle, checkpoint):
        for i, part in enumerate(parts):
            spark.sparkContext.setJobGroup(f"cap-{i}", "a trigger")
            handle(part, i)
            ran.append(sum(len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(f"cap-{i}")))

    monkeypatch.setattr(se, "run_available", triggers)
    try:
        sizes = se.batch_sizes(spark, None, scratch_dir(spark, "cap_out"), scratch_dir(spark, "ckpt"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert ran == [1, 1]
    assert sorted(map(tuple, sizes.collect())) == [(i, *p.agg(F.count("*"), F.min("seq"), F.max("seq")).first()) for i, p in enumerate(parts)]


def test_a_trigger_of_the_rate_cap_stores_one_file_and_plain_logs(spark, sf_small):
    # a local file costs a process or two where Hadoop's native library is missing: more than a trigger's rows do
    import os
    m = fx.view(spark, sf_small, "messages")
    root, out, ckpt = (scratch_dir(spark, n) for n in ("queue", "cap_out", "ckpt"))
    n, key = sq.append_messages(m, root), se.PLAIN_LOGS[0]
    assert spark.conf.get(key, None) is None
    sizes = se.batch_sizes(spark, sq.stream_queue(spark, root, 400), out, ckpt)
    assert spark.conf.get(key, None) is None
    full = -(-n // 400)
    assert sorted(os.listdir(out)) == sorted(f"{i}.json" for i in range(full))
    for log in ("offsets", "commits"):
        assert sorted(os.listdir(f"{ckpt}/{log}")) == sorted(map(str, range(full)))
    want = sorted(r.seq for r in m.select("seq").collect())
    assert [(r.rows, r.first_seq, r.last_seq) for r in sizes.orderBy("batch_id").collect()] == [
        (len(w), w[0], w[-1]) for w in (want[i:i + 400] for i in range(0, n, 400))]


def test_a_replayed_trigger_of_the_rate_cap_replaces_its_sizes(spark, sf_small, monkeypatch):
    m = fx.view(spark, sf_small, "messages")

    def triggers(stream, handle, checkpoint):
        for batch in (m.where("seq < 50"), m.where("seq < 90").repartition(5), m.where("seq < 0")):
            handle(batch, 0)

    monkeypatch.setattr(se, "run_available", triggers)
    got = se.batch_sizes(spark, None, scratch_dir(spark, "cap_out"), scratch_dir(spark, "ckpt"))
    assert list(map(tuple, got.collect())) == [(0, *m.where("seq < 90").agg(F.count("*"), F.min("seq"), F.max("seq")).first())]


def test_rate_cap_of_an_empty_queue_has_no_batches(spark):
    root, out, ckpt = (scratch_dir(spark, n) for n in ("queue", "cap_out", "ckpt"))
    assert se.batch_sizes(spark, sq.stream_queue(spark, root, 400), out, ckpt).collect() == []


def test_a_reader_goes_to_its_tasks_in_more_than_one_segment(spark):
    # a shorter one stalls each micro-batch for 40 ms (delayed acknowledgement)
    from pyspark.cloudpickle import dumps
    assert len(dumps(sq.QueueReader("/none", 3_000, sq.MESSAGE_FILE))) > 65_536


def test_batches_of_a_backlog_grow_with_what_lies_before_them(spark):
    rows = lambda a, b: spark.range(a, b).select(F.col("id").alias("seq"), F.lit(None).cast("timestamp_ntz").alias("ts"), F.lit(1).cast("long").alias("consumer"),
                                                 F.lit(True).alias("ok"), F.lit("{}").alias("body"))
    root, out, ckpt = (scratch_dir(spark, n) for n in ("queue", "o", "c"))
    sizes = lambda: [(r.rows, r.first_seq) for r in
                     se.batch_sizes(spark, sq.stream_queue(spark, root, 50, growth=1.0), out, ckpt).orderBy("batch_id").collect()]
    sq.append_messages(rows(0, 1000), root)
    first = [(50, 0), (50, 50), (100, 100), (200, 200), (400, 400), (200, 800)]
    assert sizes() == first
    sq.append_messages(rows(1000, 2500), root)      # a restarted consumer grows on from its offset
    assert sizes() == [*first, (1000, 1000), (500, 2000)]


def test_a_slice_decodes_only_row_groups_near_it(spark):
    import pyarrow.parquet as pq
    root = scratch_dir(spark, "queue")
    m = spark.range(300_000).repartition(1).select(F.col("id").alias("seq"), F.lit(None).cast("timestamp_ntz").alias("ts"), F.col("id").alias("consumer"),
                                                   F.lit(True).alias("ok"), F.sha2(F.col("id").cast("string"), 256).alias("body"))
    sq.append_messages(m, root)
    reader = sq.QueueReader(root, 3_000, m.schema)
    (part,) = reader.partitions({"row": 150_000}, {"row": 153_000})
    with pq.ParquetFile(f"{root}/data/{part.path}") as file:
        assert max(file.metadata.row_group(g).num_rows for g in range(file.num_row_groups)) < 40_000
    assert [x for b in reader.read(part) for x in b.column(0).to_pylist()] == list(range(150_000, 153_000))


def test_an_empty_queue_and_an_empty_arrival(spark, sf_small):
    m = fx.view(spark, sf_small, "messages")
    root, place, ckpt = places(spark)
    responses = fx.view(spark, sf_small, "responses")
    assert enriched(spark, root, responses, place, ckpt).read().count() == 0
    assert sq.append_messages(m.limit(0), root) == 0
    assert enriched(spark, root, responses, place, ckpt).read().count() == 0


def test_two_arrivals_at_once_keep_all_rows(spark, monkeypatch):
    rows = lambda a, b: spark.range(a, b).select(F.col("id").alias("seq"), F.lit(None).cast("timestamp_ntz").alias("ts"), F.lit(1).cast("long").alias("consumer"),
                                                 F.lit(True).alias("ok"), F.lit("{}").alias("body"))
    root, put, raced = scratch_dir(spark, "queue"), sq.Folder.put, []

    def late(self, number, text):
        if not raced:
            raced.append(1)
            sq.append_messages(rows(0, 30), root)
        return put(self, number, text)

    monkeypatch.setattr(sq.Folder, "put", late)
    assert sq.append_messages(rows(30, 50), root) == 50
    monkeypatch.undo()
    got = se.batch_sizes(spark, sq.stream_queue(spark, root, 20), scratch_dir(spark, "o"), scratch_dir(spark, "c")).orderBy("batch_id").collect()
    assert [(r.rows, r.first_seq, r.last_seq) for r in got] == [(20, 0, 19), (20, 20, 39), (10, 40, 49)]


def streaked(spark, root, out, state, ckpt, cap):
    stream = om.drop_bad_messages(sq.stream_queue(spark, root, cap))
    return {r.seq: (r.k, r.pause, r.start) for r in sk.stream_streaks(stream, out, state, ckpt).collect()}


def test_stream_streaks_equal_batch_over_batches_restarts_and_replays(spark, sf_small):
    m = fx.view(spark, sf_small, "messages")
    kept = om.drop_bad_messages(m).select("seq", "consumer", "ok")
    want = {r.seq: (r.k, r.pause, r.start) for r in om.pacing_schedule(kept).collect()}
    root, state, ckpt = places(spark)
    out = scratch_dir(spark, "streaks")
    lo, hi = m.agg(F.min("seq"), F.max("seq")).first()
    sq.append_messages(m.where(F.col("seq") <= (lo + hi) // 2), root)
    streaked(spark, root, out, state, ckpt, 180)
    sq.append_messages(m.where(F.col("seq") > (lo + hi) // 2), root)
    assert streaked(spark, root, out, state, ckpt, 180) == want
    last = max(sk._states(spark, state))
    batch = spark.read.parquet(f"{out}/batch={last}").select("seq", "consumer", "ok")
    sk.streak_handler(spark, out, state)(batch, last)       # the last batch once more
    assert {r.seq: (r.k, r.pause, r.start) for r in spark.read.parquet(out).collect()} == want
    assert len(sk._states(spark, state)) <= 2


def test_a_batch_of_streaks_reads_its_messages_once_and_joins_no_states(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def usable(seq):
        read.add(1)
        return True

    out, state = scratch_dir(spark, "streaks"), scratch_dir(spark, "state")
    m = spark.range(4_000).select(F.col("id").alias("seq"), (F.col("id") % 700).alias("consumer"), (F.xxhash64("id") % 10 < 3).alias("ok"))
    handle = sk.streak_handler(spark, out, state)
    handle(m.where("seq < 2500").where(usable("seq")), 0)
    handle(m.where("seq >= 2500 AND consumer < 600").where(usable("seq")), 1)
    assert read.value == 2_500 + m.where("seq >= 2500 AND consumer < 600").count()
    assert spark.read.parquet(f"{state}/batch=1").agg(F.count("*"), F.count_distinct("consumer")).first()[:] == (700, 700)
    kept = m.where("seq < 2500 OR consumer < 600")
    assert {r.seq: (r.k, r.pause, r.start) for r in spark.read.parquet(out).collect()} == \
        {r.seq: (r.k, r.pause, r.start) for r in om.pacing_schedule(kept).collect()}


@pytest.mark.parametrize("batch,ranges", [(1, 5), (7, 11), (10_000, 3)])
def test_states_of_consumers_are_rows_of_the_fold(spark, batch, ranges):
    from postalspark.operators.pacing import carry, paced, settle
    rows = [(i, None if i % 11 == 0 else 1 if i % 3 else i % 40, i % 7 < 2 if i % 500 < 250 else i % 13 == 0) for i in range(1_500)]
    df = spark.createDataFrame(rows, "seq long, consumer long, ok boolean")
    want = {r.seq: (r.k, r.pause, r.start) for r in paced(df, 1.0).collect()}
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, pauses = spark.conf.get(size), Pauses(1.0)
    state, got = spark.createDataFrame([], "consumer long, k long, clock double"), {}
    spark.conf.set(size, str(batch))
    try:
        for lo, hi in ((0, 1), (1, 400), (400, 410), (410, 1_500)):
            folded = fold_ranges(df.where(F.col("seq").between(lo, hi - 1)), pauses, "seq", "consumer", "ok", ranges, state, scratch_dir(spark, "fold"))
            came, state = carry(folded, pauses, "consumer")
            out = settle(folded, came, pauses, "consumer", "ok")
            assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
            assert came.count() <= ranges and out.columns == ["seq", "consumer", "ok", "k", "pause", "start"]
            got |= {r.seq: (r.k, r.pause, r.start) for r in out.collect()}
    finally:
        spark.conf.set(size, before)
    assert got == want


@pytest.mark.parametrize("name", ["T1_stream_limit", "T4_stream_ack"])
def test_two_runs_of_a_job_parse_the_answers_once(spark, sf_small, monkeypatch, name):
    from postalspark.plans import stream_queries as q
    made, table = [], se.answer_table
    monkeypatch.setattr(se, "answer_table", lambda responses: made.append(1) or table(responses))
    assert {"T1_stream_limit": q.t1_limit, "T4_stream_ack": q.t4}[name](spark, sf_small).count() > 0
    assert len(made) == 1


def test_streaks_of_one_hot_consumer_are_spread_over_tasks(spark):
    body = F.concat(F.lit('{"cep":"'), F.lpad(F.col("id").cast("string"), 8, "0"), F.lit('"}'))
    consumer = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 40).cast("long")
    m = spark.range(12_000).select(F.col("id").alias("seq"), F.lit(None).cast("timestamp_ntz").alias("ts"), consumer.alias("consumer"),
                                   (F.xxhash64("id") % 10 < 3).alias("ok"), body.alias("body"))
    root, state, ckpt = places(spark)
    sq.append_messages(m, root)
    got = streaked(spark, root, scratch_dir(spark, "streaks"), state, ckpt, 5_000)
    kept = om.drop_bad_messages(m).select("seq", "consumer", "ok")
    assert got == {r.seq: (r.k, r.pause, r.start) for r in om.pacing_schedule(kept).collect()}
    folded = fold_ranges(kept, Pauses(1.0), "seq", "consumer", "ok", ranges=8)
    sizes = folded.groupBy("_b").agg(F.count("*").alias("n"), F.count_if(F.col("consumer") == 1).alias("hot")).collect()
    assert len(sizes) == 8 and max(r.n for r in sizes) < 3_000 and sum(r.hot > 0 for r in sizes) >= 3


def test_published_lines_stream_back(spark, sf_small):
    from postalspark.operators.codes import valid_codes
    from postalspark.sinks.files import write_messages
    valid = valid_codes(fx.view(spark, sf_small, "raw_codes"))
    queue = write_messages(om.publish_messages(valid), scratch_dir(spark, "queue"))
    out = scratch_dir(spark, "lines_out")
    stream = ss.stream_message_lines(spark, queue)
    se.run_available(stream, lambda b, i: se.write_batch(om.drop_bad_messages(b), out, i), scratch_dir(spark, "lines_ckpt"))
    got = sorted(r.cep for r in spark.read.parquet(out).collect())
    assert got == sorted(r.cep for r in valid.collect())


def test_intake_cap():
    assert [se.intake_cap(2.0, 60), se.intake_cap(0.5, 1), se.intake_cap(5, 0.5)] == [120, 1, 2]


def test_uploaded_csv_binds_columns_by_name(spark):
    def upload(text):
        path = scratch_dir(spark, "upload")
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
        out = scratch_dir(spark, "upload_out")
        se.run_available(ss.stream_uploaded_csv(spark, path), lambda b, i: se.write_batch(b, out, i), scratch_dir(spark, "upload_ckpt"))
        return [(r.cep, r.is_valid) for r in spark.read.parquet(out).orderBy("cep").collect()]

    assert upload("cep\n01310100\nx") == [("01310100", True), ("x", False)]
    assert upload("name,cep\n\"a, \"\"b\"\"\",01310-100") == [("01310-100", True)]
    with pytest.raises(ValueError):
        upload("code\n01310100")
