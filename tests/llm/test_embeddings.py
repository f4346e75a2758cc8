"""Hard negatives, whitening and exact top-k against brute force, and the bounds that prune them."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from postalspark.llm.negatives import _Walk, mine, spanning_tree
from postalspark.llm.topk import Postings, top_k
from postalspark.llm.vectors import highest
from postalspark.llm.whitening import jacobi_davidson, minres, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, row string, x string, cell string, block string, n string, `rank` int"


def frame(spark, rows):
    """Embeddings with clashing extra columns; ``rows``: (vec_id, vector[, label])."""
    return spark.createDataFrame([(i, v, *(rest or (1,)), "r", "x", "c", "b", "n", 7) for i, v, *rest in rows], SCHEMA)


def vectors(n, d=8, seed=3):
    """Vectors around a few centres, with copies and ties."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, d))
    out = centres[rng.integers(0, 5, n)] * 0.3 + rng.normal(size=(n, d)) * 0.1
    out[n // 2: n // 2 + n // 4] = out[n // 2]
    return out.astype(np.float32)


def edges(n=260):
    """Rows with nulls, odd numbers, short and empty vectors, repeated ids, negative ids and many copies."""
    v = vectors(n)
    rows = [(i, v[i].tolist(), i % 10) for i in range(n)]
    rows += [(300, None, 1), (400, [1.0, None] + [0.0] * 6, 2), (500, [math.nan] + [0.0] * 7, 3), (600, [math.inf] + [0.1] * 7, 4),
             (700, [0.5, 0.25], 5), (800, [], 6), (None, v[3].tolist(), 7), (100, v[9].tolist(), 0), (100, v[9].tolist(), 0),
             (-100, v[5].tolist(), 3), (900, v[7].tolist(), None), (11, v[11].tolist(), 1)]
    return rows


def usable(rows):
    width = max((len(v) for _, v, _ in rows if v is not None), default=0)
    return [(i, [*map(float, map(np.float32, v)), *[0.0] * (width - len(v))], lab) for i, v, lab in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def scaled(rows, scale):
    return [(i, [math.floor(scale * c) for c in v], lab) for i, v, lab in rows]


def last(i):
    return math.inf if i is None else i


def plain_top_k(rows, scale, k):
    got, rows = [], scaled(usable(rows), scale)
    for a, (i, x, _) in enumerate(rows):
        if i is not None and i % 100 == 0:
            scores = sorted(((-sum(p * q for p, q in zip(x, y)), last(j)) for b, (j, y, _) in enumerate(rows) if b != a))
            got += [(i, r, None if j == math.inf else j, -s) for r, (s, j) in enumerate(scores[:k], 1)]
    return sorted(got, key=str)


def plain_negatives(rows, scale):
    got, rows = [], scaled(usable([r for r in rows if r[2] is not None]), scale)
    rows = [(i, x, (lab + 1) % 10 if i is not None and i % 7 == 0 else lab) for i, x, lab in rows]
    for a, (i, x, own) in enumerate(rows):
        if i is None or i % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), last(j), lab) for b, (j, y, lab) in enumerate(rows) if b != a)
        for p, pos, _ in [s for s in scored if s[2] == own][:5]:
            fits = [s for s in scored if s[2] != own and 30 * -p <= 100 * -s[0] <= 90 * -p][:10]
            got += [(i, *(None if j == math.inf else j for j in (pos,)), r, None if j == math.inf else j, -p, -s) for r, (s, j, _) in enumerate(fits, 1)]
    return sorted(got, key=str)


def found_top_k(spark, rows, k=10):
    got = top_k(frame(spark, rows), F.col("vec_id") % 100 == 0, k, 1024)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


def found_negatives(spark, rows):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, mine(frame(spark, rows), F.col("vec_id") % 100 == 0, label, 256).collect()), key=str)


def test_top_k_edges(spark):
    rows = edges()
    assert found_top_k(spark, rows) == plain_top_k(rows, 1024, 10)


def test_negatives_edges(spark):
    rows = edges()
    got = found_negatives(spark, rows)
    assert got == plain_negatives(rows, 256) and len(got) > 50


def test_negatives_more_anchors_than_a_tree(spark, monkeypatch):
    import postalspark.llm.negatives as negatives
    import postalspark.llm.vectors as vectors_module
    monkeypatch.setattr(negatives, "TREE", 4)
    monkeypatch.setattr(negatives, "BLOCK_QUERIES", 8)
    monkeypatch.setattr(vectors_module, "BLOCK_QUERIES", 8)
    monkeypatch.setattr(vectors_module, "SHARD_ROWS", 700)
    v = vectors(2100)
    rows = [(i, v[i].tolist(), i % 10) for i in range(2100)]
    assert found_negatives(spark, rows) == plain_negatives(rows, 256)


def test_top_k_many_shards_and_blocks(spark, monkeypatch):
    import postalspark.llm.vectors as vectors_module
    monkeypatch.setattr(vectors_module, "BLOCK_QUERIES", 6)
    monkeypatch.setattr(vectors_module, "SHARD_ROWS", 600)
    v = vectors(2000)
    rows = [(i, v[i].tolist(), 1) for i in range(2000)]
    assert found_top_k(spark, rows) == plain_top_k(rows, 1024, 10)


@pytest.mark.parametrize("rows", [[], [(0, None, 1)], [(0, [0.5], 1)], [(0, [0.5], 1), (1, [0.25], 1)], [(0, [], 1), (1, [], 2), (100, [], 1)]])
def test_small_tables(spark, rows):
    assert found_top_k(spark, rows) == plain_top_k(rows, 1024, 10)
    assert found_negatives(spark, rows) == plain_negatives(rows, 256)
    assert whiten(frame(spark, rows)).count() in (0, 2)


def test_scores_beyond_doubles_are_exact_and_beyond_longs_refused(spark):
    rows = [(100 * i, [1e5 + i, 2e5 - i, 7.0 * i], 1) for i in range(30)]
    assert found_top_k(spark, rows) == plain_top_k(rows, 1024, 10)
    with pytest.raises(ValueError, match="do not fit a long"):
        found_top_k(spark, [(0, [1e15], 1), (1, [1e15], 1)])


def test_possible_rows_hold_the_best_and_are_few():
    x = (vectors(3000, 24, 5) * 1024).astype(np.int64)
    index, ids, sizes = Postings(x), np.arange(3000), []
    for own in range(0, 3000, 150):
        at = index.possible(x[own], 10, own)
        scores = x @ x[own]
        scores[own] = np.iinfo(np.int64).min
        assert set(highest(scores, ids, 10)) <= set(at) and own not in at
        sizes.append(len(at))
    assert np.median(sizes) <= 3000 / 8


def test_processing_stops_before_all_postings(monkeypatch):
    import postalspark.llm.topk as topk
    x = (np.random.default_rng(8).normal(size=(4000, 24)) * 200).astype(np.int64)    # no copies
    seen = []
    count = np.bincount
    monkeypatch.setattr(topk.np, "bincount", lambda at, *a, **k: seen.append(len(at)) or count(at, *a, **k))
    Postings(x).possible(x[0], 10, 0)
    assert 0 < sum(seen) < 0.9 * x.size


def test_spanning_tree_is_minimal():
    x = (vectors(60, 6) * 256).astype(np.int64)
    order, parent, edge = spanning_tree(x)
    assert sorted(order) == list(range(60)) and parent[0] == -1 and (parent[1:] < np.arange(1, 60)).all()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1).astype(float))
    for i in range(1, 60):
        assert edge[i] == pytest.approx(d[order[i], order[parent[i]]])
    pairs, root, total = sorted((d[a, b], a, b) for a in range(60) for b in range(a)), list(range(60)), 0.0   # Kruskal
    for w, a, b in pairs:
        if root[a] != root[b]:
            total, old = total + w, root[a]
            root = [root[b] if r == old else r for r in root]
    assert edge.sum() == pytest.approx(total)


def test_intervals_hold_the_scores_and_close_anchors_are_not_rescored(spark):
    import pyarrow as pa
    rng = np.random.default_rng(2)
    x = rng.integers(-200, 200, (500, 12))
    anchors = np.repeat(x[:5], 8, axis=0) + rng.integers(-1, 2, (40, 12))
    order, parent, edge = spanning_tree(anchors)
    tree = pa.table({"parent": parent, "edge": edge})
    walk, narrow = _Walk(x, np.float64), 0
    for i, low, high in walk.visit(tree, anchors[order]):
        true = x @ anchors[order[i]]
        assert (low <= true).all() and (true <= high).all()
        narrow += float(np.median(high - low)) < 0.1 * np.abs(true).max()
        if i % 8 == 0:
            walk.rescore(anchors[order[i]], np.arange(0, 500, 2), low, high)
    assert narrow > 20


def test_minres_solves():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(12, 12))
    a = a + a.T
    shift = np.array([0.3, -2.0, 5.0])
    b = rng.normal(size=(12, 3))
    x = minres(lambda t: a @ t - t * shift, b, 14)
    assert np.allclose(a @ x - x * shift, b, atol=1e-6)


@pytest.mark.parametrize("values,k", [(np.arange(200.0, 0, -1), 12), (np.r_[np.ones(3) * 9, 0.5 ** np.arange(120)], 8), (np.zeros(6), 3),
                                      (np.r_[5.0, 5.0, 1.0, np.zeros(40)], 10)])
def test_jacobi_davidson_against_dense(values, k):
    q, _ = np.linalg.qr(np.random.default_rng(4).normal(size=(len(values), len(values))))
    v = (q * values) @ q.T
    jobs = []
    got = jacobi_davidson(lambda b: jobs.append(1) or v @ b, len(values), k)
    assert np.allclose(got.values, np.sort(values)[::-1][:k], atol=1e-11 * max(1, values.max()))
    assert np.abs(v @ got.vectors - got.vectors * got.values).max() < 1e-10 * max(1, values.max())
    assert np.allclose(got.vectors.T @ got.vectors, np.eye(k), atol=1e-10) and len(jobs) < 200


def test_whitening_against_dense(spark):
    rows = edges()
    some = [r for r in usable(rows) if r[1]]
    some = [r for r, (i, v, lab) in zip(some, [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])], strict=True) if v]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v, _ in some])
    n, s = len(x), x.sum(axis=0)
    y = (n * x - s) / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    got = whiten(frame(spark, rows)).toPandas()
    assert len(got) == n * 8 and set(got.component) == set(range(1, 9)) and (got.n == n).all()
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-10
    assert np.allclose(got.sort_values("component").explained.to_numpy().reshape(8, n)[:, 0], e / e.sum(), rtol=1e-10)
    deviation = sorted(((n * x - s) ** 2).sum(axis=1).tolist())
    assert sorted(got[got.component == 1].deviation) == deviation
    for c in range(8):
        mine_, true = np.sort(got[got.component == c + 1].whitened), (y @ u[:, c]) / math.sqrt(e[c])
        assert min(np.abs(mine_ - np.sort(true)).max(), np.abs(mine_ - np.sort(-true)).max()) < 1e-8


def test_whitening_leaves_out_components_without_variance(spark):
    rows = [(i, [0.5, float(i), float(2 * i)], 1) for i in range(20)]
    got = whiten(frame(spark, rows)).toPandas()
    assert set(got.component) == {1} and len(got) == 20 and got.explained.iloc[0] == pytest.approx(1.0)


def test_deviation_beyond_a_long_is_null(spark):
    got = whiten(frame(spark, [(i, [1e6 * i], 1) for i in range(200)])).toPandas().sort_values("vec_id")
    x = [math.floor(64e6 * i) + 1_000_000 for i in range(200)]
    true = [(200 * a - sum(x)) ** 2 for a in x]
    assert [None if d != d else int(d) for d in got.deviation] == [t if t < 1 << 53 else int(float(t)) if t < 1 << 63 else None for t in true]
