import numpy as np
import pytest
from pyspark.sql import functions as F

from postalspark.llm import mixing

from .plain import docs_frame, edge_rows


def soft_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, n_tokens long, p_clean double, p_junk double, p_toxic double")


def shares(df):
    total = df.agg(F.sum("n_tokens")).first()[0]
    return [df.agg(F.sum(F.col("n_tokens") * F.col("rate") * F.col(f"p_{d}"))).first()[0] / total for d in mixing.DOMAINS]


def test_rates_bring_expected_tokens_to_targets(spark):
    rows = [(i, 50 + i % 40, *p) for i, p in enumerate([(0.9, 0.05, 0.05), (0.1, 0.8, 0.1), (0.2, 0.1, 0.7), (0.98, 0.01, 0.01)] * 60)]
    soft = soft_frame(spark, rows)
    targets = {"clean": 0.5, "junk": 0.2, "toxic": 0.3}
    out = soft.withColumn("rate", mixing.fit_rates(soft, targets))
    assert shares(out) == pytest.approx([0.5, 0.2, 0.3], abs=2e-4)
    assert out.agg(F.min("rate")).first()[0] >= 0


GOAL = np.array(list(mixing.TARGETS.values()))


def loss(r, p, c):
    return float(((((c * r) @ p) / c.sum() - GOAL) ** 2 / GOAL).sum())


def plain_rates(p, c, steps=20_000):
    """Projected gradient in numpy, one array element a document, without acceleration."""
    start = p @ (GOAL / ((c @ p) / c.sum()))
    root = np.sqrt(1 / GOAL)
    length = np.linalg.eigvalsh((p * c[:, None]).T @ p / c.sum() * root[:, None] * root)[-1]
    r = start.copy()
    for _ in range(steps):
        r = np.clip(r - p @ ((((c * r) @ p) / c.sum() - GOAL) / GOAL) / length, mixing.LEAST * start, mixing.MOST * start)
    return r, start


@pytest.mark.parametrize("seed,spread", [(1, 20.0), (2, 3.0), (3, 0.5)])
def test_rates_come_to_the_least_squares_of_a_plain_solver(spark, seed, spread):
    rng = np.random.default_rng(seed)
    p = rng.dirichlet(np.array([0.8, 0.1, 0.1]) * spread, 400)
    c = rng.integers(1, 300, 400)
    soft = soft_frame(spark, [(i, int(c[i]), *map(float, p[i])) for i in range(400)])
    got = np.array([r.rate for r in soft.withColumn("rate", mixing.fit_rates(soft)).orderBy("doc_id").collect()])
    want, start = plain_rates(p, c)
    assert (got >= mixing.LEAST * start - 1e-9).all() and (got <= mixing.MOST * start + 1e-9).all()
    assert loss(got, p, c) <= loss(want, p, c) + 0.01 * (loss(start, p, c) - loss(want, p, c)) + 1e-6


def test_a_domain_that_is_nearly_gone_costs_no_clean_documents(spark):
    # what is left after filtering: hardly any junk, so its target is out of reach
    rng = np.random.default_rng(4)
    rows = [(i, int(rng.integers(50, 900)), *((1 - a - b, a, b) if i % 9 else (a, b, 1 - a - b))) for i, (a, b) in enumerate(rng.uniform(1e-5, 3e-3, (2000, 2)))]
    soft = soft_frame(spark, [(i, n, *map(float, p)) for i, n, *p in rows])
    out = soft.withColumn("rate", mixing.fit_rates(soft))
    rate = out.groupBy((F.col("p_clean") > 0.5).alias("clean")).agg(F.avg("rate").alias("rate"), F.min("rate").alias("least")).collect()
    assert next(r for r in rate if r.clean).least > 0.9
    told = {r.domain: r.reached for r in mixing.reached(out).collect()}
    assert told["clean"] == pytest.approx(0.95, abs=0.04) and told["toxic"] == pytest.approx(0.02, abs=0.01)


def test_production_defaults_reach_targets_far_from_the_shares(spark):
    rows = [(i, 50, *((0.998, 0.001, 0.001) if i % 500 else (0.001, 0.998, 0.001))) for i in range(1000)] + [(1000, 60, 0.001, 0.001, 0.998)]
    soft = soft_frame(spark, rows)
    out = soft.withColumn("rate", mixing.fit_rates(soft))
    told = {r.domain: (r.wanted, r.reached) for r in mixing.reached(out).collect()}
    assert set(told) == set(mixing.DOMAINS)
    assert all(wanted == pytest.approx(mixing.TARGETS[d]) and got == pytest.approx(wanted, rel=0.05) for d, (wanted, got) in told.items())
    ratio = max(t / (sum(n * p[j] for _, n, *p in rows) / sum(n for _, n, *_ in rows)) for j, t in enumerate(mixing.TARGETS.values()))
    assert out.agg(F.max("rate")).first()[0] <= mixing.MOST * ratio


def test_the_stage_mixes_scarce_domains_to_the_stated_targets(spark, tmp_path):
    import corpus_pipeline

    kinds = ["junk"] * 60 + ["toxic"] * 60 + ["clean"] * 6000
    rows = [(i, " ".join({"junk": f"w{(i * 31 + j * 17) % 500}%%%", "toxic": "grumbus" if j % 3 else f"w{j}"}.get(kind, f"w{(i * 31 + j * 17) % 500}") for j in range(40)))
            for i, kind in enumerate(kinds)]
    spark.createDataFrame([(i, int(k != "junk"), int(k == "toxic")) for i, k in enumerate(kinds)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.mix_sources(spark, docs_frame(spark, rows), str(tmp_path))
    n = {k: 0 for k in mixing.DOMAINS}
    for r in out.select("doc_id").collect():
        n[kinds[r.doc_id]] += 1
    assert [n[k] / sum(n.values()) for k in mixing.DOMAINS] == pytest.approx([0.95, 0.03, 0.02], abs=0.01)


def corpus():
    rows, labels = [], []
    for i in range(400):
        kind = ("clean", "junk", "toxic")[0 if i % 10 < 7 else 1 if i % 10 < 9 else 2]
        w = [f"w{(i * 31 + j * 17) % 500}" for j in range(40 + i % 30)]
        if kind == "junk":
            w = [x + "%%%" for x in w]
        if kind == "toxic":
            w[3::7] = ["grumbus"] * len(w[3::7])
        rows.append((i, " ".join(w)))
        if i % 2:
            labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    return rows, labels


def test_classifier_and_resampling(spark):
    rows, labels = corpus()
    docs, marks = docs_frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = mixing.rates(docs, marks)
    truth = {i: 0 if i % 10 < 7 else 1 if i % 10 < 9 else 2 for i, _ in rows}
    right = sum(max(range(3), key=lambda d: (r.p_clean, r.p_junk, r.p_toxic)[d]) == truth[r.doc_id] for r in got.collect())
    assert right >= 0.97 * len(rows)
    counted = {r.doc_id: r.n_tokens for r in got.collect()}
    assert all(counted[i] == len(t.split()) for i, t in rows)
    out = mixing.resample(docs, marks)
    assert out.columns == docs.columns and out.schema == docs.schema     # a column named __row among them
    copies = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    tokens = [sum(copies.get(i, 0) * counted[i] for i, d in truth.items() if d == k) for k in range(3)]
    assert [t / sum(tokens) for t in tokens] == pytest.approx([0.95, 0.03, 0.02], abs=0.03)
    assert all(copies.get(i, 0) >= 1 for i, d in truth.items() if d == 0)
    whole = {tuple(r) for r in docs.collect()}
    assert {tuple(r) for r in out.collect()} <= whole


@pytest.mark.parametrize("kept", [False, True])
def test_true_labels_on_the_given_documents(spark, kept):
    from postalspark.llm.common import table
    from postalspark.llm.quality import keep_good
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    docs = keep_good(docs, labels) if kept else docs
    got = mixing.rates(docs, labels).join(mixing.domains_of(labels), "doc_id").toPandas()
    assert got.rate.max() < 3 and got.p_toxic.nunique() > 0.8 * len(got)
    tokens = got.assign(t=got.copies * got.n_tokens).groupby("domain").t.sum()
    share = (tokens / tokens.sum()).tolist()
    assert share == pytest.approx([0.95, 0.03, 0.02], abs=0.02)
    clean = got[got.domain == 0]
    assert (clean.copies == 0).mean() < 0.02
    # no group of like posteriors that is mostly clean is dropped
    like = got.assign(g=got[["p_clean", "p_junk", "p_toxic"]].round(2).apply(tuple, axis=1)).groupby("g").agg(n=("domain", "size"), clean=("domain", lambda d: (d == 0).mean()), rate=("rate", "mean"))
    assert (like[(like.n >= 5) & (like.clean > 0.5)].rate > 0.3).all()


def test_a_megabyte_of_one_text(spark):
    import time
    rows = [(i, " ".join(f"w{(i * 31 + j) % 500}" for j in range(60))) for i in range(40)] + [(99, "word and more " * 80_000)]
    marks = spark.createDataFrame([(i, int(i % 4 > 0), int(i % 5 == 0)) for i in range(40)], "doc_id long, quality int, toxic int")
    t = time.time()
    assert {r.doc_id: r.n_tokens for r in mixing.rates(docs_frame(spark, rows), marks).collect()}[99] == 240_000
    assert time.time() - t < 90


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = mixing.rates(docs_frame(spark, edge_rows()), none).collect()
    assert len(got) == len(edge_rows()) and all(r.p_clean == pytest.approx(1 / 3) for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {0}
    assert mixing.rates(docs_frame(spark, []), none).count() == 0
