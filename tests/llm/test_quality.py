import math
import random

import pytest

from postalspark.llm import quality, queries

from .plain import docs_frame, edge_rows, quality_counts, quality_cutoffs, quality_features


def judged(spark, rows, labels, **k):
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return quality.judge(docs_frame(spark, rows), marks, **k).collect()


def test_counts_match_a_plain_version(spark):
    rows = edge_rows() + [(20, "a b c a b c a b"), (21, "x y x y x y x"), (22, "#a $$ <b>\n\n#a $$ <b>\n \nz"), (23, "a b c d a b c e a b c")]
    got = judged(spark, rows, [])
    want = sorted((str(i), quality_counts(t)) for i, t in rows)
    assert sorted((str(r.doc_id), (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in got) == want
    assert all(r.kept == (not r.base_failed) for r in got)  # without labels no cutoff is certified


def test_certified_cutoffs_reject_junk_and_keep_good(spark):
    clean = [(i, " ".join(f"w{(i * 7 + j * j) % 9973}" for j in range(60))) for i in range(1200)]
    junk = [(5000 + i, " ".join(f"w{(i * 5 + j * j) % 9973}%%%" for j in range(60))) for i in range(200)]
    labels = [(i, 1, 0) for i, _ in clean[:1000]] + [(i, 0, 0) for i, _ in junk[:150]] + [(3, 1, 0), (None, 0, 0)]
    got = {r.doc_id: r.kept for r in judged(spark, clean + junk, labels)}
    assert not any(got[i] for i, _ in junk)
    assert sum(got[i] for i, _ in clean) >= 0.98 * len(clean)


def test_too_few_labels_reject_nothing(spark):
    rows = [(i, " ".join(f"w{i}x{j}%%%" for j in range(60))) for i in range(60)]
    assert all(r.kept for r in judged(spark, rows, [(i, i % 2, 0) for i in range(60)]))


@pytest.mark.parametrize("n,k,p", [(10, 0, 0.1), (400, 3, 0.02), (400, 8, 0.02), (50, 49, 0.99), (100_000, 1900, 0.02), (1, 0, 0.5), (0, 0, 0.5)])
def test_binomial_tail_is_exact(spark, n, k, p):
    from pyspark.sql import functions as F
    got = spark.range(1).select(quality.binomial_tail(F.lit(k), F.lit(n), p).alias("x")).first().x
    if n == 0 or k >= n * p:
        assert got == 1.0
        return
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    assert got == pytest.approx(math.fsum(map(math.exp, logs)), rel=1e-8)


def test_empty_table_and_kept_columns(spark):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.judge(docs_frame(spark, []), marks).count() == 0
    d = docs_frame(spark, edge_rows())
    out = quality.keep_good(d, marks)
    assert out.columns == d.columns
    assert out.count() == sum(not quality_counts(t)[5] for _, t in edge_rows())


def noisy_corpus(seed, times):
    """Three languages (one without name) whose good and bad documents overlap in all features, with labels for most; some say both."""
    rng = random.Random(seed)
    rows, labels = [], []
    for s, (lang, n) in enumerate([("en", 1600), ("de", 1100), (None, 300)]):
        for j in range(n * times):
            i, bad = 10_000 * s + j, rng.random() < 0.25
            w = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(45, 90))]
            for _ in range(rng.choice([0, 0, 1, 2]) + (rng.randrange(9) if bad else 0)):
                k = rng.randrange(len(w))
                w[k] = rng.choice([w[k] + "%", w[k].upper(), w[k] + "!", "\nsame line\n", w[k] + "#$", "x y z x y z"])
            rows.append((i, " ".join(w), lang))
            if rng.random() < 0.9:
                labels.append((i, int(not bad), 0))
            if rng.random() < 0.02:
                labels.append((i, 0, 0))
    return rows + rows[:5] + [(None, "no id " * 60, "en")], labels + [(None, 1, 0), (7, None, 0)]


@pytest.mark.parametrize("seed,times,max_risk,error,levels", [(1, 3, 0.02, 0.05, quality.LEVELS), (2, 1, 0.05, 0.05, (0.0, 0.002, 0.005, 0.01, 0.02)), (3, 1, 0.3, 0.1, (0.0, 0.05, 0.1, 0.2))])
def test_cutoffs_and_verdicts_match_a_plain_selection(spark, seed, times, max_risk, error, levels):
    rows, labels = noisy_corpus(seed, times)
    control = {"max_risk": max_risk, "error": error, "levels": levels}
    want = quality_cutoffs(rows, [x[:2] for x in labels], **control)
    assert want
    got = judged(spark, rows, labels, **control)

    def verdict(t, lang):
        f, cut = quality_features(t), want[lang][3] if lang in want else {}
        return not quality_counts(t)[5] and not any(f[name] > c for name, c in cut.items())

    assert sorted((str(r.doc_id), r.kept) for r in got) == sorted((str(i), verdict(t, lang)) for i, t, lang in rows)
    assert any(not r.kept and not r.base_failed for r in got)


def test_whole_table_against_a_plain_selection(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    want = quality_cutoffs(rows, labels, quality.MAX_RISK, quality.ERROR, quality.LEVELS)
    got = {r.doc_id: r.kept for r in queries.op2_quality_rules(spark, sf).collect()}
    for i, t, lang in rows:
        cut = want[lang][3] if lang in want else {}
        assert got[i] == (not quality_counts(t)[5] and not any(quality_features(t)[name] > c for name, c in cut.items()))
