import random

from pyspark.sql import functions as F

from postalspark.llm import queries, toxicity

from .plain import docs_frame, edge_rows


def test_clause_grammar():
    r = toxicity.Reader(toxicity.Grammar())
    weight = lambda t: sum(r.clauses(t)[1])
    plain, aimed = weight("what an idiot."), weight("you idiot.")
    assert aimed > plain > 0
    assert weight("this is not trash.") < plain and weight("she said trash.") < aimed
    assert weight("i will kill you.") > 0 and weight("i will kill time.") == 0
    assert r.clauses("fine words. other fine words\nmore") == (3, [])
    assert r.clauses("") == r.clauses(None) == (0, [])
    assert r.score("you idiot, you moron. trash!") > 0.3 > r.score("a fine day")


def plain_weight(tags):
    """Weight of a clause by searching all its words for each match."""
    t, total = toxicity, 0.0
    for p, c, w in tags:
        aimed = any(k == t.TARGET and abs(p - q) <= t.TARGET_REACH for q, k, _ in tags)
        if c in (t.INSULT, t.LEARNED):
            w *= t.AIMED if aimed else 1
        elif c != t.THREAT or not aimed:
            continue
        w *= t.NEGATED if any(k == t.NEGATION and 0 < p - q <= t.NEGATION_REACH for q, k, _ in tags) else 1
        total += w * (t.REPORTED if any(k == t.REPORT and q < p for q, k, _ in tags) else 1)
    return total


def test_composed_transducers_against_a_plain_search():
    rng = random.Random(8)
    for _ in range(20_000):
        at, tags = 0, []
        for _ in range(rng.randrange(1, 9)):
            tags.append((at, rng.randrange(1, 7), rng.choice((1.0, 2.5, 3.0))))
            at += rng.choice((1, 1, 1, 2, 3, 4, 5, 6, 9))
        assert abs(toxicity.Reader.match(tags) - plain_weight(tags)) < 1e-9, tags
    # states of the product that a clause can reach: one word is not both target and negation, so of the 5 x 4 pairs of
    # countdowns the three that began at one word are never met; reported speech or not
    assert len(toxicity.CLAUSE.arcs) == (5 * 4 - 3) * 2
    assert [len(m.arcs) for m in (toxicity.INSULT_MACHINE, toxicity.THREAT_MACHINE, toxicity.TARGET_MACHINE, toxicity.NEGATION_MACHINE, toxicity.REPORT_MACHINE)] == [1, 1, 5, 4, 2]


def rows_with_insults(n=600, seed=3):
    rng = random.Random(seed)
    clean = [f"wort{i}" for i in range(800)]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(clean) for _ in range(60)]
        bad = i % 6 == 0
        if bad:
            for _ in range(3):
                w[rng.randrange(60)] = "zlumpf" + rng.choice(["er", "en", "a", ""])
        rows.append((i, " ".join(w) + "."))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_learned_words_and_stems_score_held_out_rows(spark):
    rows, labels = rows_with_insults()
    docs, marks = docs_frame(spark, rows), spark.createDataFrame(labels + [(5, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    sample = toxicity.labelled(docs, marks.where(~queries.held_out(F.col("doc_id"))))
    grammar = toxicity.learn(sample, F.pmod(F.col("doc_id"), F.lit(3)).cast("int"))
    assert any(w.startswith("zlum") for w in {**grammar.words, **grammar.prefixes})
    got = toxicity.score(docs, grammar).join(docs.select("doc_id", queries.held_out(F.col("doc_id")).alias("held")), "doc_id").where("held").collect()
    truth = dict((i, t) for i, _, t in labels)
    assert len(got) > 100 and sum(r.predicted == truth[r.doc_id] for r in got) / len(got) > 0.98


def test_held_out_recall_precision_and_order(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op5_toxicity(spark, sf)
    assert got.count() == 10_000
    marks = spark.read.parquet(f"{sf}/labels.parquet")
    rows = got.join(marks, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    hits = sum(r.predicted and r.toxic for r in rows)
    assert hits >= 0.85 * sum(r.toxic for r in rows) and hits >= 0.9 * sum(r.predicted for r in rows)
    yes, no = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    auc = sum((a > b) + (a == b) / 2 for a in yes for b in no) / len(yes) / len(no)
    assert auc > 0.9


def test_long_clauses_take_linear_time():
    import time
    reader, t = toxicity.Reader(toxicity.Grammar()), time.time()
    reader.score("you " * 100_000 + "idiot " * 100_000)
    reader.score("idiot you " * 100_000)
    assert time.time() - t < 10


def test_edges(spark):
    docs = docs_frame(spark, edge_rows())
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    grammar = toxicity.learn(toxicity.labelled(docs, none), F.lit(0))
    assert grammar == toxicity.Grammar()
    got = toxicity.score(docs, grammar).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r.score < 0.3 and r.predicted == 0 for r in got)
    assert toxicity.score(docs_frame(spark, []), grammar).count() == 0
