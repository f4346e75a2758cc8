"""SimHash near-dedup: 64-bit fingerprints, exact pairs within a Hamming bound by vantage-point trees.

Fingerprints. Words are runs without blank or ASCII control 9 to 13, A-Z lower-cased; every 3-word shingle (repeats
included) gives its XXH64, and a bit is set if more than half of the hashes have it.

Search. Equal fingerprints are grouped first, so only different ones are searched. A vantage-point tree splits
them: a node has a block of bits, a vantage pattern on that block and a radius; fingerprints whose block lies within
the radius of the vantage go left, others right. Blocks on a path are disjoint, and the Hamming distance is the
sum of the blocks' distances, so the triangle bounds of a path add up: crossing a node's boundary costs how
far a fingerprint lies on the other side of it, and a branch is pruned once the costs exceed the bound.
Of two fingerprints that a node parts, the right one visits the left side (or the other way round, whichever is cheaper), so
every pair meets in exactly the shard where one of them is at home.

The top of the tree is fitted on a bounded sample (`SAMPLE` fingerprints) and routes every fingerprint to its
home shard and to the shards its ball overlaps; each shard goes on with a tree of its own down to small leaves, which
are compared bit by bit. That tree may use any bit again, also one of a block on the shard's path, so costs of the two trees
don't add up: in it a visitor has the whole bound again. Where the tree leaves a shard large (more fingerprints than the
sample can part, or a ball that no block parts), all that come to one are dealt to several tasks by the bits that two linked
fingerprints must share: of bound + 3 blocks some three are alike, so linked ones meet under one of the masks at least, and are compared there.
A ball overlaps the more shards the more there are, so the tree's visits outgrow the fingerprints; masks give a fixed
number of rows each. Where by the sample the tree would give more, all fingerprints are dealt by masks. Either way a fingerprint
makes some twenty rows at most, whatever the table's size. A shard or part gives a spanning forest of its links, never all pairs; forests are joined
into components by large-star/small-star rounds whose state is written below the shared checkpoint folder.

Defined cases: a text without words (null too) has fingerprint zero, linked like any other; rows with one
``doc_id`` are fingerprinted each; null ids get a component as well (null if it has no other id); an
empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, fresh, stash

SHINGLE_WORDS, SEED, MAX_BITS = 3, 42, 2
#: fingerprints the top of the tree is fitted on; fingerprints a shard should have at home; size of a leaf
SAMPLE, SHARD_ROWS, LEAF = 1 << 15, 4_096, 192
#: shards with more than this many times `SHARD_ROWS` fingerprints at home are dealt again; leaves beyond `DENSE` are compared by agreeing blocks
LARGE, DENSE = 4, 2_048
#: among more fingerprints than this that agree under a mask, changes of the other bits may be looked up
MANY = 512
#: not a shard: fingerprints that are dealt by masks
DEALT = -1
BLOCK_BITS = (5, 3, 1)


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """SimHash of one text, as an unsigned 64-bit number."""
    toks = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not toks:
        return 0
    h, line = xxhash.xxh64_intdigest, b" ".join(toks)
    if len(toks) <= words:
        return h(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, toks), np.int64, len(toks)) + 1) - 1
    begins = [0, *(ends[:-words] + 1).tolist()]
    hashes = np.array([h(line[a:b], SEED) for a, b in zip(begins, ends[words - 1:].tolist(), strict=True)], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i: i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = (), words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp`` (signed 64 bit) and the integer columns ``keep`` for every row."""
    def rows(c: dict[str, list]) -> dict[str, list]:
        fps = np.array([fingerprint(t, words) for t in c["text"]], np.uint64).view(np.int64)
        return {k: c[k] for k in ("doc_id", *keep)} | {"fp": fps}

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep, "text")
    return arrow_map(d, rows, ", ".join(["doc_id long", *(f"{k} long" for k in keep), "fp long"]))


class Tree:
    """A vantage-point tree over fingerprints: nodes are tuples, leaves numbers."""

    def __init__(self, sample: np.ndarray, leaf: int, bound: int = MAX_BITS):
        self.bound, self.leaves = bound, 0
        self.sizes: list[int] = []      # of the sample, by leaf
        # nodes: (mask, vantage, radius, right visits left?, left child, right child)
        self.root = self._grow(sample, leaf, np.ones(64, bool))

    def _grow(self, x: np.ndarray, leaf: int, free: np.ndarray):
        split = self._split(x, free) if len(x) > leaf else None
        if split is None:
            self.leaves += 1
            self.sizes.append(len(x))
            return self.leaves - 1
        mask, vantage, radius, rightward = split
        left = np.bitwise_count((x ^ vantage) & mask) <= radius
        rest = free & ~_bits(mask)
        return mask, vantage, radius, rightward, self._grow(x[left], leaf, rest), self._grow(x[~left], leaf, rest)

    def _split(self, x: np.ndarray, free: np.ndarray):
        """The block, vantage and radius that leave the least to the larger side, visitors counted."""
        probe = x[:: max(1, len(x) // 4096)]
        ones = np.array([np.count_nonzero((probe >> np.uint64(b)) & np.uint64(1)) for b in range(64)]) / len(probe)
        spread = np.where(free, np.minimum(ones, 1 - ones), -1.0)
        order = np.argsort(-spread, kind="stable")
        best, found = 0.97 * len(probe), None
        for size in BLOCK_BITS:
            block = order[:size]
            if spread[block[-1]] <= 0:
                continue
            mask = np.uint64(sum(1 << int(b) for b in block))
            for at in range(3):
                vantage = probe[(at * len(probe)) // 3] & mask
                d = np.bitwise_count((probe ^ vantage) & mask)
                have = np.bincount(d, minlength=size + 1)
                for radius in range(size):
                    left, right = have[: radius + 1], have[radius + 1:]
                    if not left.sum() or not right.sum():
                        continue
                    into_left, into_right = right[: self.bound].sum(), left[::-1][: self.bound].sum()
                    for rightward, cost in ((True, max(left.sum() + into_left, right.sum())), (False, max(left.sum(), right.sum() + into_right))):
                        if cost < best:
                            best, found = cost, (mask, vantage, np.uint8(radius), rightward)
        return found

    def route(self, x: np.ndarray, budget: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(leaf, indexes, remaining budgets) of the points at home (``budget`` negative) and visiting."""
        out: list[tuple[int, np.ndarray, np.ndarray]] = []
        todo = [(self.root, np.arange(len(x)), budget)]
        while todo:
            node, idx, left_over = todo.pop()
            if not len(idx):
                continue
            if not isinstance(node, tuple):
                out.append((node, idx, left_over))
                continue
            mask, vantage, radius, rightward, left, right = node
            d = np.bitwise_count((x[idx] ^ vantage) & mask).astype(np.int8)
            past = d - np.int8(radius)  # > 0: on the right
            home = left_over < 0
            for child, cost, crosses in ((left, np.maximum(past, 0), rightward), (right, np.maximum(1 - past, 0), not rightward)):
                rest = np.where(home, np.where(cost == 0, -1, self.bound - cost), left_over - cost)
                go = (cost == 0) | (rest >= 0) & (~home | crosses)
                todo.append((child, idx[go], rest[go].astype(np.int8)))
        return out


def _bits(mask) -> np.ndarray:
    return np.array([(int(mask) >> b) & 1 for b in range(64)], bool)


def _components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable of each of ``n`` points over the links a-b."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            break
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label = label[label]
    return label


def block_masks(bound: int) -> list[np.uint64]:
    """Masks of which any two fingerprints within ``bound`` bits agree on at least one: of bound + 3 blocks of bits some 3 are alike."""
    blocks = np.array_split(np.arange(64), bound + 3)
    return [np.uint64(sum(1 << int(b) for part in three for b in part)) for three in itertools.combinations(blocks, 3)]


def _flips(mask: np.uint64, bound: int) -> list[np.uint64]:
    """All changes of at most ``bound`` bits outside ``mask``, none included."""
    free = [1 << int(b) for b in np.flatnonzero(~_bits(mask))]
    return [np.uint64(sum(some)) for n in range(bound + 1) for some in itertools.combinations(free, n)]


def _alike_pairs(x: np.ndarray, mask: np.uint64, bound: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (index pairs) within ``bound`` bits that connect fingerprints agreeing under ``mask``: neighbours 1, 2, ... places on in sorted order.

    Where more fingerprints agree than there are changes of their other bits, the changed ones are looked up instead: work per
    fingerprint is bounded by the number of changes, not by how many agree.
    """
    key = x & mask
    order = np.lexsort((x, key))
    key, whole = key[order], x[order]
    begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(x) else np.zeros(0, int)
    sizes = np.diff(np.r_[begins, len(x)])
    flips = _flips(mask, bound) if len(sizes) and sizes.max() > MANY else []
    many = sizes > max(MANY, 2 * len(flips))
    for a, n in zip(begins[many].tolist(), sizes[many].tolist(), strict=True):
        group = whole[a: a + n]
        for flip in flips:
            other = group ^ flip
            at = np.minimum(np.searchsorted(group, other), n - 1)
            hit = np.flatnonzero((group[at] == other) & (at < np.arange(n)))
            if len(hit):
                yield order[a + at[hit]], order[a + hit]
    at = np.flatnonzero(~np.repeat(many, sizes))
    for step in itertools.count(1):
        at = at[at + step < len(x)]
        at = at[key[at] == key[at + step]]
        if not len(at):
            return
        near = at[np.bitwise_count(whole[at] ^ whole[at + step]) <= bound]
        if len(near):
            yield order[near], order[near + step]


def _leaf_pairs(x: np.ndarray, own: np.ndarray, idx: np.ndarray, bound: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of a leaf with an end in ``own``; large leaves, which no block of bits parts, by agreeing blocks."""
    if len(own) * len(idx) > DENSE ** 2:
        for mask in block_masks(bound):
            for p, q in _alike_pairs(x[idx], mask, bound):
                yield idx[p], idx[q]
        return
    for i in range(0, len(own), 256):
        row = own[i: i + 256]
        for j in range(0, len(idx), 16_384):
            col = idx[j: j + 16_384]
            p, q = np.nonzero(np.bitwise_count(x[row][:, None] ^ x[col][None, :]) <= bound)
            p, q = row[p], col[q]
            real = p != q
            yield p[real], q[real]


def alike(x: np.ndarray, mask: np.uint64, bound: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links among fingerprints that agree under ``mask``."""
    label = np.arange(len(x))
    for p, q in _alike_pairs(x, mask, bound):
        label = label[_components(len(x), label[p], label[q])] if len(p) else label
    at = np.flatnonzero(label != np.arange(len(x)))
    return x[label[at]], x[at]


def search(x: np.ndarray, budget: np.ndarray, bound: int = MAX_BITS, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (pairs of fingerprints) of all links with at least one end at home (``budget`` negative; others visit)."""
    home = x[budget < 0]
    tree = Tree(home, leaf, bound)
    budget = np.where(budget < 0, -1, bound).astype(np.int8)  # what the top tree left over is spent on bits that this one may use again
    left, right, kept = [], [], 0
    for _, idx, rest in tree.route(x, budget):
        for p, q in _leaf_pairs(x, idx[rest < 0], idx, bound):
            left.append(p)
            right.append(q)
            kept += len(p)
            if kept > 2_000_000:  # many links in a dense ball: a forest says as much
                label = _components(len(x), np.concatenate(left), np.concatenate(right))
                at = np.flatnonzero(label != np.arange(len(x)))
                left, right, kept = [label[at]], [at], 0
    if not left:
        return x[:0], x[:0]
    label = _components(len(x), np.concatenate(left), np.concatenate(right))
    at = np.flatnonzero(label != np.arange(len(x)))
    return x[label[at]], x[at]


def forest(fps: DataFrame, bound: int = MAX_BITS, sample_rows: int = SAMPLE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links ``u, v`` that connect exactly the different fingerprints of ``fps`` (column ``fp``) within ``bound`` bits."""
    total = fps.count()
    sample = fps.orderBy(F.xxhash64("fp"), "fp").limit(sample_rows).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    tree = Tree(sample, max(16, int(len(sample) * shard_rows / max(1, total))), bound)
    masks = block_masks(bound)
    # shards that by the sample have very many fingerprints at home (more than it can part, or a ball that no block parts)
    likely = {leaf: round(n * total / max(1, len(sample))) for leaf, n in enumerate(tree.sizes)}
    large = {leaf for leaf, n in likely.items() if n > LARGE * shard_rows}
    dealt, visits = _met(tree, sample, large)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = b["fp"].to_numpy(np.int64).view(np.uint64)
            met = np.zeros(len(x), bool)
            for leaf, idx, rest in tree.route(x, np.full(len(x), -1, np.int8)):
                if leaf in large:
                    met[idx] = True
                else:
                    yield pd.DataFrame({"shard": np.int32(leaf), "fp": x[idx].view(np.int64), "budget": rest.astype(np.int32)})
            if met.any():
                yield pd.DataFrame({"shard": np.int32(DEALT), "fp": x[met].view(np.int64), "budget": np.int32(-1)})

    def links(shard: pd.DataFrame) -> pd.DataFrame:
        u, v = search(shard["fp"].to_numpy(np.int64).view(np.uint64), shard["budget"].to_numpy(np.int8), bound)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    def agreeing(part: pd.DataFrame) -> pd.DataFrame:
        u, v = alike(part["fp"].to_numpy(np.int64).view(np.uint64), masks[int(part["block"].iloc[0])], bound)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    def deal(some: DataFrame, rows: int) -> DataFrame:
        # a row per mask, in parts by the bits under the mask: linked ones meet in one part at least
        under = F.array(*[F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(int(m.astype(np.int64)))).alias("key")) for i, m in enumerate(masks)])
        each = some.select("fp", F.explode(under).alias("u"))
        each = each.select("fp", "u.block", F.pmod(F.xxhash64("u.key"), F.lit(max(1, -(-rows // shard_rows)))).alias("part"))
        return each.groupBy("block", "part").applyInPandas(agreeing, "u long, v long")

    if visits > len(masks) * len(sample):
        return deal(fps.select("fp"), total)
    routed = fps.select("fp").mapInPandas(route, "shard int, fp long, budget int")
    if not large:
        return routed.groupBy("shard").applyInPandas(links, "u long, v long")
    routed = stash(routed, "routed")    # read by both ways
    return (routed.where(F.col("shard") != DEALT).groupBy("shard").applyInPandas(links, "u long, v long")
            .union(deal(routed.where(F.col("shard") == DEALT), round(dealt * total / len(sample)))))


def _met(tree: Tree, x: np.ndarray, large: set[int]) -> tuple[int, int]:
    """How many of ``x`` come to a shard in ``large``, and how many rows of them all come to the others."""
    met, visits = np.zeros(len(x), bool), 0
    for leaf, idx, _ in tree.route(x, np.full(len(x), -1, np.int8)):
        if leaf in large:
            met[idx] = True
        else:
            visits += len(idx)
    return int(met.sum()), visits


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` of every linked node: large-star and small-star rounds until nothing changes."""
    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now = stash(edges.select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")).where("u <> v").distinct(), "links")
    seen = state(now)
    while seen[0]:
        both = now.union(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("v"), F.col("v").alias("u")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                              F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = stash(small.select("e.v", "e.u").where("u <> v").distinct(), "links")
        got = state(now)
        if got == seen:
            break
        seen = got
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def components(prints: DataFrame, bound: int = MAX_BITS) -> DataFrame:
    """``prints`` (``doc_id, fp`` and more) with ``root`` (a fingerprint that names the component) and ``component_id``: the smallest ``doc_id`` reachable over links."""
    each = stash(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = connected(forest(each, bound))
    named = each.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(named.join(ids, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, bound: int = MAX_BITS, words: int = SHINGLE_WORDS, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, fp, root, component_id`` (and the integer columns ``keep``) of every row."""
    return components(stash(fingerprints(docs, keep, words), "prints"), bound)


def one_of_each(docs: DataFrame, bound: int = MAX_BITS, words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` without all but one row of each component: the one with the smallest id (first read among equals)."""
    row = fresh("row", docs.columns)
    d = stash(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")    # numbered once, for the verdict and for what is kept
    got = near_duplicates(d, bound, words, (row,))
    first = got.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row)).alias("m"))
    return d.join(first.select(F.col(f"m.{row}").alias(row)), row, "left_semi").drop(row)
