import re

from postalspark.llm import licenses, queries

from .plain import docs_frame, edge_rows


def plain(text, least=licenses.LEAST):
    """license -> best containment over windows that share a shingle with it."""
    w = [x for x in re.split(r"[\x00-/:-@\[-`{-\x7f]+", (text or "").lower()) if x]
    gram = lambda v: [tuple(v[i:i + 5]) for i in range(len(v) - 4)] if len(v) >= 5 else [tuple(v)] if v else []
    doc, out = set(gram(w)), {}
    for name, t in licenses.TEMPLATES:
        known = set(gram([x for x in re.split(r"[\x00-/:-@\[-`{-\x7f]+", t.lower()) if x]))
        share = len(known & doc) / len(known)
        if share >= least:
            out[name] = max(share, out.get(name, 0))
    return out


def test_bands_guarantee():
    assert 1 - (1 - 1 / 12) ** licenses.BANDS >= 1 - licenses.MISS


def test_finds_exactly_the_contained_templates(spark):
    filler = " ".join(f"word{i}" for i in range(200))
    rows = edge_rows()
    for k, (_, t) in enumerate(licenses.TEMPLATES):
        rows += [(100 + k, t), (200 + k, filler[: 400 + k] + " " + t + " " + filler), (300 + k, t.upper().replace(" ", "  ")), (400 + k, " ".join(t.split()[: len(t.split()) // 2]))]
    long = licenses.TEMPLATES[2][1].split()
    rows += [(500, " ".join([*long[:-2], "changed", "words"])), (501, " ".join(long[::2]))]
    got = {}
    for r in licenses.scan(docs_frame(spark, rows)).collect():
        got.setdefault(r.doc_id, {})[r.license] = r.containment
    want = {i: plain(t) for i, t in rows if plain(t)}
    assert got == want and 500 in got and 501 not in got


def test_each_notice_is_taken_for_its_own_license_only():
    assert len(licenses.TEMPLATES) >= 30
    for name, t in licenses.TEMPLATES:
        assert plain("Some words before. " + t + " And some after it.").keys() == {name}, t


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = sorted((r.doc_id, r.license, r.containment) for r in queries.op1_license_scans(spark, sf).collect())
    assert got == sorted((i, n, c) for i, t in texts.items() for n, c in plain(t).items()) and got


def test_empty_table_and_templates(spark):
    assert licenses.scan(docs_frame(spark, [])).count() == 0
    assert licenses.scan(docs_frame(spark, edge_rows()), templates=(("x", "..."),)).count() == 0
