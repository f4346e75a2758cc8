"""Texts of a megabyte and more: whole results, in a time that grows with their length."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from postalspark.llm import fingerprints as fp
from postalspark.llm import licenses, mixing, quality, url_filter

from .plain import docs_frame, quality_counts
from .test_url_filter import pages, plain

WORDS = " ".join(f"w{i * 7919 % 100_003}" for i in range(180_000))


def test_sketch_of_a_megabyte():
    assert len(WORDS) > 1_000_000
    start = time.time()
    whole = fp.sketch(WORDS)
    assert time.time() - start < 20
    w = WORDS.split(" ")
    parts = [" ".join(w[i:i + 60_004]) for i in range(0, len(w), 60_000)]      # neighbours share four words, so no shingle is lost
    merged = fp.sketch(parts[0])
    for part in parts[1:]:
        merged = fp.merge(merged, fp.sketch(part))
    assert list(merged) == list(whole)
    assert fp.distinct_count(whole) == pytest.approx(100_003, rel=0.4)


def test_fingerprints_of_long_neighbours(spark):
    rows = [(1, WORDS), (2, WORDS[:-3]), (3, "short"), (4, "x" * 1_000_000)]
    got = {r.doc_id: r for r in fp.compare_with_next(docs_frame(spark, rows)).collect()}
    assert [got[i].n_chars for i in (1, 2, 3, 4)] == [len(t) for _, t in rows]
    assert got[1].near_next > 0.9 and got[2].near_next == got[3].near_next == 0.0


def test_urls_of_a_megabyte(spark):
    urls = ["http://h.net/" + "free/" * 200_000, "http://h.net/" + "free/" * 200_000 + "casino", "http://h.net/" + "a%20" * 300_000, "x" * 1_000_000 + "://example.org/es/1"]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.n_strict, r.n_soft) for r in url_filter.filter_urls(pages(spark, urls)).collect()}
    assert got == {i: plain(u) for i, u in enumerate(urls)}


def test_posteriors_and_rates_of_a_megabyte(spark):
    texts = [(i, " ".join(f"v{(i * 31 + j * j) % 400}" for j in range(60))) for i in range(60)] + [(100, WORDS), (101, "y" * 1_000_000), (102, "# " * 500_000)]
    marks = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 2)] + [(i, 0, 0) for i in (1, 3, 5)] + [(i, 1, 1) for i in (7, 9)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in mixing.rates(docs_frame(spark, texts), marks).collect()}
    assert got[100].n_tokens == 180_000 and got[101].n_tokens == 1 and got[102].n_tokens == 500_000
    for r in got.values():
        assert np.isclose(sum(r[f"p_{d}"] for d in mixing.DOMAINS), 1.0) and np.isfinite(r.rate) and r.rate >= 0


def test_quality_counts_of_a_megabyte(spark):
    rows = [(1, WORDS), (2, "a b c d " * 125_000), (3, "one line\n" * 110_000), (4, "<" * 1_000_000)]
    got = quality.judge(docs_frame(spark, rows), spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    assert sorted((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in got) == [(i, quality_counts(t)) for i, t in rows]


def test_license_inside_a_megabyte(spark):
    name, notice = licenses.TEMPLATES[2]
    half = len(WORDS) // 2
    rows = [(1, WORDS[:half] + " " + notice + " " + WORDS[half:]), (2, WORDS)]
    got = licenses.scan(docs_frame(spark, rows)).where(F.col("license") == name).collect()
    assert [(r.doc_id, r.containment) for r in got] == [(1, 1.0)]
