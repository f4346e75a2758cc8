import hashlib

import pytest

from postalspark.llm import fingerprints as fp

from .plain import docs_frame, edge_rows, words_of


def shingles(text):
    w = words_of(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_edited_texts_and_likeness(spark):
    rows = [(i, t) for i, t in edge_rows() if i not in (None, 2)] + [(2, "short one"), (40, " ".join(f"v{j}" for j in range(900)))]
    order = sorted(rows)
    texts = [t or "" for _, t in order]
    got = {r.doc_id: r for r in fp.compare_with_next(docs_frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for k, (i, _) in enumerate(order):
        t, nxt = texts[k], texts[(k + 1) % len(texts)]
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        r = got[i]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - jaccard(t, edited)) < 0.25 and abs(r.near_next - jaccard(t, nxt)) < 0.25
        assert r.fingerprint == fp.to_text(fp.sketch(t)) and r.edited_fingerprint == fp.to_text(fp.sketch(edited))


def test_sketches_estimate_and_merge():
    words = [f"w{i}" for i in range(3000)]
    a, b = " ".join(words[:2000]), " ".join(words[1000:])
    sa, sb = fp.sketch(a, 1024), fp.sketch(b, 1024)
    assert fp.resemblance(sa, sb, 1024) == pytest.approx(jaccard(a, b), abs=0.06)
    assert fp.containment(sa, sb, 1024) == pytest.approx(0.5, abs=0.08)
    assert fp.distinct_count(sa, 1024) == pytest.approx(1996, rel=0.12)
    both = fp.sketch(" ".join(words[:2000]) + " " + " ".join(words[1996:]), 1024)
    assert list(fp.merge(fp.sketch(" ".join(words[:2000]), 1024), fp.sketch(" ".join(words[1996:]), 1024), 1024)) == list(both)
    assert list(fp.from_text(fp.to_text(sa))) == list(sa)
    assert fp.resemblance(fp.sketch(""), fp.sketch(None)) == 1.0 and fp.resemblance(fp.sketch("a"), fp.sketch("")) == 0.0


def test_one_row_repeats_and_empty(spark):
    one = fp.compare_with_next(docs_frame(spark, [(7, "only one text here")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fp.compare_with_next(docs_frame(spark, edge_rows())).count() == len(edge_rows())
    assert fp.compare_with_next(docs_frame(spark, [])).count() == 0
    assert fp.sketch_documents(docs_frame(spark, edge_rows())).count() == len(edge_rows())


def test_ranges_follow_the_order_and_split_hot_ids():
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(4)
    ids = pd.Series([None] * 300 + [7] * 300 + list(range(100, 400)), dtype="Int64")
    hashes = pd.Series(rng.integers(-2**63, 2**63 - 1, 900))
    ranges = fp.Ranges([7] * 8 + [140, 180, 220, 260, 300, 340, 380], 8)
    at = ranges.of(ids, hashes)
    order = sorted(range(900), key=lambda i: (not pd.isna(ids[i]), 0 if pd.isna(ids[i]) else ids[i], hashes[i]))
    assert (np.diff(at[order]) >= 0).all() and at.min() >= 0 and at.max() < ranges.count
    assert np.bincount(at).max() < 120  # a third in one range would be 300
    assert list(fp.Ranges([], 0).of(ids[300:], hashes[300:])) == [0] * 600


def test_each_range_is_one_partition(spark):
    rows = [(i, f"text {i} " * 8) for i in range(400)] + [(None, f"null {i}") for i in range(100)]
    got, n = fp.with_next(docs_frame(spark, rows))
    from pyspark.sql import functions as F
    parts = got.repartitionById(n, F.col("bucket")).select("bucket", F.spark_partition_id().alias("p"))
    sizes = {r.p: (r.buckets, r["count"]) for r in parts.groupBy("p").agg(F.count_distinct("bucket").alias("buckets"), F.count("*").alias("count")).collect()}
    assert {b for b, _ in sizes.values()} == {1} and len(sizes) >= n - 1
    assert max(c for _, c in sizes.values()) <= 2 * sorted(c for _, c in sizes.values())[len(sizes) // 2] + 10


def test_hot_and_null_ids_are_compared_in_the_order_of_hashes(spark):
    from pyspark.sql import functions as F
    rows = [(None, f"null text {i} " * (i % 5 + 1)) for i in range(150)] + [(7, f"hot text {i % 140} " * (i % 7 + 1)) for i in range(150)] + [(100 + i, f"one {i} two") for i in range(150)]
    docs = docs_frame(spark, rows)
    order = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).orderBy(F.col("doc_id").asc_nulls_first(), "h").collect()
    want = []
    for k, r in enumerate(order):
        nxt, half = order[(k + 1) % len(order)].text, len(r.text) // 2
        want.append((r.doc_id, hashlib.sha256((r.text[: len(r.text) - half] + nxt[:half]).encode()).hexdigest()))
    got = [(r.doc_id, r.edited_sha256) for r in fp.compare_with_next(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
