from collections import Counter, defaultdict

import corpus_pipeline
from postalspark.llm import mixing, pii
from postalspark.llm.common import table

from .plain import components, quality_counts, quality_cutoffs, quality_features, simhash
from .test_packing import check


def plain_quality(docs, labels):
    from postalspark.llm import quality
    cuts = quality_cutoffs([(r.doc_id, r.text, r.lang) for r in docs], [(r.doc_id, r.quality) for r in labels], quality.MAX_RISK, quality.ERROR, quality.LEVELS)

    def good(r):
        f = quality_features(r.text)
        return not quality_counts(r.text)[5] and not any(f[name] > c for name, c in (cuts[r.lang][3] if r.lang in cuts else {}).items())

    return sorted(r for r in docs if good(r))


def plain_dedup(docs):
    rows = [(r.doc_id, r.text) for r in docs]
    _, ids = components(rows, simhash)
    return sorted(r for r, least in zip(docs, ids) if r.doc_id == least)


def plain_mask(text):
    """Overlapping spans joined, each group replaced by the kind of its first and longest span."""
    groups = []
    for kind, a, b in sorted({s for found in pii.find_spans(text) for s in found}, key=lambda s: (s[1], -s[2])):
        if groups and a < groups[-1][2]:
            groups[-1][2] = max(b, groups[-1][2])
        else:
            groups.append([kind, a, b])
    for kind, a, b in reversed(groups):
        text = text[:a] + f"[{kind.upper()}]" + text[b:]
    return text


def test_every_stage_against_a_plain_version(spark, sf_small):
    """Each stage is judged on its own input: plain cutoffs, all pairs of fingerprints, spans, rates, and the tokenizer's ids."""
    docs, labels = table(spark, sf_small, "documents"), table(spark, sf_small, "labels")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "SimHash near-dedup", "PII", "mixing", "packing"]

    good = stages["quality rules"](spark, docs, sf_small)
    assert good.columns == columns and sorted(good.collect()) == plain_quality(docs.collect(), labels.collect())

    single = stages["SimHash near-dedup"](spark, good, sf_small)
    assert single.columns == columns and sorted(single.collect()) == plain_dedup(good.collect())
    assert single.count() < good.count()

    masked = stages["PII"](spark, single, sf_small)
    texts = {r.doc_id: plain_mask(r.text) for r in single.collect()}
    assert masked.columns == columns and {r.doc_id: (r.text, r.n_chars) for r in masked.collect()} == {i: (t, len(t)) for i, t in texts.items()}
    assert texts != {r.doc_id: r.text for r in single.collect()}

    mixed = stages["mixing"](spark, masked, sf_small)
    copies = {r.doc_id: r.copies for r in mixing.rates(masked, labels).collect()}
    whole = {r.doc_id: r for r in masked.collect()}
    assert mixed.columns == columns and all(r == whole[r.doc_id] for r in mixed.collect())
    assert Counter(r.doc_id for r in mixed.collect()) == {i: n for i, n in copies.items() if n}

    pieces, rows = stages["packing"](spark, mixed, sf_small).collect(), [(r.doc_id, r.text) for r in mixed.collect()]
    check(pieces, rows, 2048)
    lengths = defaultdict(int)
    for p in pieces:
        lengths[p.sequence_id] += p.length
    assert max(lengths.values()) <= 2048


def test_stages_in_order_and_their_effects(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    columns, seen = docs.columns, docs
    assert len(corpus_pipeline.STAGES) == 5
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, seen, sf_small)
        if k < 4:
            assert out.columns == columns, name
        rows = out.collect()
        if k == 0:
            assert {r.doc_id for r in rows} == {i for i, t in texts.items() if not quality_counts(t)[5]}
        if k == 1:
            assert len({r.doc_id for r in rows}) == len(rows) < len(kept)
        if k in (1, 2):
            assert {r.doc_id for r in rows} <= {r.doc_id for r in kept}
        if k == 4:
            assert {r.doc_id for r in rows} == {r.doc_id for r in kept}
        kept, seen = rows, out


def test_empty_documents(spark, sf_small, tmp_path):
    for name in ("documents", "labels"):
        table(spark, sf_small, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
