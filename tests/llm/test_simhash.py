import random

import numpy as np
import pytest

from postalspark.llm import simhash

from .plain import components, docs_frame, edge_rows
from .plain import simhash as plain_simhash


def test_matches_brute_force(spark):
    rng = random.Random(3)
    base = [[f"w{rng.randrange(3000)}" for _ in range(rng.randrange(20, 120))] for _ in range(12)]
    rows = edge_rows()
    for i in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(0, 2)):
            w[rng.randrange(len(w))] = "Changed"
        rows.append((100 + i, " ".join(w)))
    fps, comp = components(rows, plain_simhash)
    got = simhash.near_duplicates(docs_frame(spark, rows)).collect()
    key = lambda x: tuple((v is not None, v or 0) for v in x)
    assert sorted([(r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in got], key=key) == sorted(
        [(i, f, c) for (i, _), f, c in zip(rows, fps, comp)], key=key)


@pytest.mark.parametrize("leaf", [16, 192])
def test_tree_search_finds_every_link(leaf):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2**63, 1500, dtype=np.uint64)
    ball = np.repeat(x[:1], 900)
    for _ in range(3):
        ball = ball ^ (np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64))
    near = x[:500] ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64))
    x = np.unique(np.concatenate([x, ball, near]))
    u, v = simhash.search(x, np.full(len(x), -1, np.int8), leaf=leaf)
    at = {int(a): i for i, a in enumerate(x)}
    got = simhash._components(len(x), np.array([at[int(a)] for a in u]), np.array([at[int(a)] for a in v]))
    p, q = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 2)
    assert (got == simhash._components(len(x), p, q)).all()
    assert len(u) < len(x)


def test_shards_of_a_sampled_tree_lose_no_link(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 2**62, 400, dtype=np.int64)
    x = np.unique(np.concatenate([x, x[:300] ^ 5, x[:200] ^ (1 << 40)]))
    fps = spark.createDataFrame([(int(a),) for a in x], "fp long")
    got = {r.node: r.root for r in simhash.connected(simhash.forest(fps, sample_rows=100, shard_rows=40)).collect()}
    p, q = np.nonzero(np.bitwise_count(x.view(np.uint64)[:, None] ^ x.view(np.uint64)[None, :]) <= 2)
    label = simhash._components(len(x), p, q)
    groups, want = {}, {}
    for i, a in enumerate(x):
        groups.setdefault(got.get(int(a), int(a)), set()).add(int(a))
        want.setdefault(int(label[i]), set()).add(int(a))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_shards_of_a_top_tree_lose_no_link_of_dense_balls():
    rng = np.random.default_rng(11)
    bit = lambda n: np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    centers = rng.integers(0, 2**63, 40, dtype=np.uint64)
    ball = np.repeat(centers, 250)
    for _ in range(6):
        ball = ball ^ bit(len(ball))
    x = np.unique(np.concatenate([ball, ball[::5] ^ bit(len(ball[::5])) ^ bit(len(ball[::5])), rng.integers(0, 2**63, 2000, dtype=np.uint64)]))
    top = simhash.Tree(x[:: 4], 300)
    assert top.leaves > 4
    shards = {}
    for leaf, idx, rest in top.route(x, np.full(len(x), -1, np.int8)):
        shards.setdefault(leaf, []).append((idx, rest))
    assert sum(sum((r < 0).sum() for _, r in s) > 2 * simhash.LEAF for s in shards.values()) > 4
    at, a, b = {int(v): i for i, v in enumerate(x)}, [], []
    for s in shards.values():
        u, v = simhash.search(x[np.concatenate([i for i, _ in s])], np.concatenate([r for _, r in s]))
        a += [at[int(p)] for p in u]
        b += [at[int(p)] for p in v]
    p, q = [], []
    for i in range(0, len(x), 1000):
        r, c = np.nonzero(np.bitwise_count(x[i: i + 1000, None] ^ x[None, :]) <= 2)
        p.append(r + i)
        q.append(c)
    want = simhash._components(len(x), np.concatenate(p), np.concatenate(q))
    assert (simhash._components(len(x), np.array(a), np.array(b)) == want).all()


def test_one_of_each_keeps_the_smallest_id_and_all_columns(spark):
    rows = edge_rows()
    d = docs_frame(spark, rows)
    out = simhash.one_of_each(d)
    assert out.columns == d.columns
    fps, comp = components(rows, plain_simhash)
    known = {c for c in comp if c is not None}
    got = out.collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(known)
    assert len(got) == len(known) + sum(1 for c in comp if c is None)


def test_empty_table(spark):
    assert simhash.near_duplicates(docs_frame(spark, [])).count() == 0


def ball(n, seed=7):
    """Fingerprints three bits from one centre, and a few far ones."""
    import itertools
    rng = np.random.default_rng(seed)
    centre = np.uint64(0x0F0F123456789ABC)
    three = np.array(list(itertools.combinations(range(64), 3)))[rng.permutation(41664)[:n]]
    flips = np.bitwise_or.reduce(np.uint64(1) << three.astype(np.uint64), axis=1)
    return np.unique(np.concatenate([centre ^ flips, rng.integers(0, 2 ** 63, 50).astype(np.uint64)]))


def roots_of(x, u, v):
    place = {int(f): i for i, f in enumerate(x)}
    return simhash._components(len(x), np.array([place[int(a)] for a in u], int), np.array([place[int(b)] for b in v], int))


def test_linked_fingerprints_agree_under_a_mask():
    rng = np.random.default_rng(1)
    masks = simhash.block_masks(2)
    assert len(masks) == 10
    for _ in range(500):
        a = np.uint64(rng.integers(0, 2 ** 63))
        b = a
        for bit in rng.integers(0, 64, 2):
            b = b ^ (np.uint64(1) << np.uint64(bit))
        assert any(a & m == b & m for m in masks)


def test_a_dense_ball_in_one_shard_is_exact_and_quick():
    import time
    x = ball(4_000)
    u, v = simhash.search(x, np.full(len(x), -1, np.int8))
    p, q = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 2)
    assert (roots_of(x, u, v) == simhash._components(len(x), p, q)).all()
    big = ball(30_000)
    t = time.time()
    simhash.search(big, np.full(len(big), -1, np.int8))
    assert time.time() - t < 20


def test_large_shards_are_dealt_to_several_tasks(spark):
    x = ball(5_000)
    df = spark.createDataFrame([(int(f),) for f in x.view(np.int64)], "fp long")
    got = simhash.forest(df, sample_rows=64, shard_rows=200)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapGroupsInPandas") == 2
    links = got.toPandas()
    p, q = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 2)
    mine = roots_of(x, links.u.to_numpy(np.int64).view(np.uint64), links.v.to_numpy(np.int64).view(np.uint64))
    assert (mine == simhash._components(len(x), p, q)).all()


def test_rows_per_fingerprint_do_not_grow_with_the_number_of_shards(spark):
    """A tree of many shards sends a fingerprint to ever more of them; masks give ten rows, whatever the table's size."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2 ** 63, 6000, dtype=np.uint64)
    x = np.unique(np.concatenate([x, x[:900] ^ np.uint64(9), x[:300] ^ np.uint64(1 << 50)]))
    tree = simhash.Tree(x, 16)
    assert simhash._met(tree, x, set())[1] > 10 * len(x)
    df = spark.createDataFrame([(int(f),) for f in x.view(np.int64)], "fp long")
    got = simhash.forest(df, sample_rows=len(x), shard_rows=16)
    assert "MapInPandas" not in got._jdf.queryExecution().executedPlan().toString()
    links = got.toPandas()
    p, q = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 2)
    mine = roots_of(x, links.u.to_numpy(np.int64).view(np.uint64), links.v.to_numpy(np.int64).view(np.uint64))
    assert (mine == simhash._components(len(x), p, q)).all()


def test_many_that_agree_under_a_mask_are_looked_up():
    rng = np.random.default_rng(6)
    mask = simhash.block_masks(2)[0]
    free = [b for b in range(64) if not (int(mask) >> b) & 1]
    low = rng.integers(0, 2 ** len(free), 4_000)
    low = np.concatenate([low, low[:800] ^ 3, low[:200] ^ 5])
    x = np.bitwise_or.reduce([((low >> i) & 1).astype(np.uint64) << np.uint64(b) for i, b in enumerate(free)], axis=0)
    x = np.unique(np.concatenate([x, x[:50] ^ mask, rng.integers(0, 2 ** 63, 300, dtype=np.uint64)]))
    pairs = list(simhash._alike_pairs(x, mask, 2))
    assert len(pairs) < 800
    near = [(int(a), int(b)) for p, q in pairs for a, b in zip(p, q)]
    p, q = np.nonzero((np.bitwise_count(x[:, None] ^ x[None, :]) <= 2) & ((x & mask)[:, None] == (x & mask)[None, :]))
    assert {(min(e), max(e)) for e in near} == {(a, b) for a, b in zip(p.tolist(), q.tolist()) if a < b}
