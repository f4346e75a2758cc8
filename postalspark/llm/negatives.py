"""Hard-negative mining by bounds along spanning trees of the anchors.

Anchors are ordered by their nearest pivot, cut into blocks of at most `TREE` and joined within a block by a minimum
spanning tree (Prim, Euclidean edges). Against a shard of rows, the root's scores are computed; a child's score
lies within edge length times the row's norm of its parent's score (Cauchy-Schwarz), and such intervals add up along
the tree where the parent itself was not rescored. A child whose edge is as long as the child itself is scored like a root. Only rows whose interval overlaps a window are rescored by
integer products: for positives the window above the lowest score that is sure of a place, for negatives each
positive's own score window, above the scores that are sure of a place in it. Edges pay where anchors lie close
together; anchors spread evenly in many dimensions are scored against most rows or all.

Defined cases: rows whose label or vector is null, or that hold a null, NaN or infinite component, take no part;
shorter vectors are padded by zeros; a null id is no anchor, keeps its label and comes last among ties; rows that
repeat an id are rows of their own; an anchor with no other row of its label, or with no row in a window, gives no
rows there; an empty table gives none. Other columns are ignored. Scores beyond a long raise an error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ranked, stash
from .vectors import BLOCK_QUERIES, Vectors, grid, highest, integers, matrix, sort_ids

#: most anchors in a tree
TREE = 256
#: most pivots by which anchors are ordered; they are the only vectors that reach the driver
PIVOTS = 256


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge) of the minimum spanning tree of the rows of ``x`` from row 0.

    ``order`` lists rows with parents before children; ``parent`` (in terms of that order, -1 for the root) and
    ``edge`` (Euclidean length, rounded up) run along it.
    """
    norm = (x.astype(np.float64) ** 2).sum(axis=1)
    y = x.astype(np.float64)
    near, via = np.full(len(x), np.inf), np.full(len(x), -1)
    left = np.ones(len(x), bool)
    order, parent, edge, place, at = [], [], [], {}, 0
    for _ in range(len(x)):
        place[at] = len(order)
        order.append(at)
        parent.append(-1 if via[at] < 0 else place[int(via[at])])
        edge.append(0.0 if via[at] < 0 else math.sqrt(float(((x[at] - x[via[at]]).astype(np.float64) ** 2).sum())) * (1 + 1e-9))
        left[at] = False
        distance = norm + norm[at] - 2.0 * (y @ y[at])
        closer = left & (distance < near)
        near[closer], via[closer] = distance[closer], at
        at = int(np.where(left, near, np.inf).argmin())
    return np.array(order), np.array(parent), np.array(edge)


def _trees(v: Vectors, anchors: DataFrame) -> DataFrame:
    """Anchors with `block` (number of the tree), `place` (parents before children), `parent` (place) and `edge`."""
    number, width = v.number, v.width
    pivots = np.array([r["x"] + [0] * (width - len(r["x"])) for r in anchors.orderBy(F.xxhash64("row")).limit(PIVOTS).collect()], np.int64)

    def nearest(batches):
        p = pivots.astype(np.float64).reshape(len(pivots), width)
        half = (p ** 2).sum(axis=1) / 2
        for batch in filter(len, batches):
            gap = half - matrix(batch.column("x"), width).astype(np.float64) @ p.T
            at = gap.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64()), pa.array(gap[np.arange(len(at)), at])],
                                             names=[*batch.schema.names, "pivot", "gap"])

    schema = "row long, vec_id long, label int, x array<long>"
    ordered = ranked(anchors.select("row", "vec_id", "label", "x").mapInArrow(nearest, schema + ", pivot long, gap double"),
                     ["pivot", "gap", "row"], "rank")

    def grow(group: pa.Table) -> pa.Table:
        order, parent, edge = spanning_tree(matrix(group["x"], width))
        group = group.take(pa.array(order))
        return group.append_column("place", pa.array(np.arange(len(order)), pa.int64())).append_column(
            "parent", pa.array(parent, pa.int64())).append_column("edge", pa.array(edge))

    blocks = ordered.select("row", "vec_id", "label", "x", F.floor(F.col("rank") / TREE).cast("long").alias("block"))
    return stash(blocks.groupBy("block").applyInArrow(grow, schema + ", block long, place long, parent long, edge double"), "trees")


class _Walk:
    """Scores of a tree's anchors against one shard, known by intervals until rescored."""

    def __init__(self, x: np.ndarray, number: type):
        self.exact = x.astype(number)
        self.number = number
        self.norm = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)

    def visit(self, tree: pa.Table, xs: np.ndarray):
        """Yield (index in tree, low, high) in tree order; the visitor narrows low and high in place by `rescore`."""
        parents, edges = tree["parent"].to_numpy(), tree["edge"].to_numpy()
        sizes = np.sqrt((xs.astype(np.float64) ** 2).sum(axis=1))
        children = np.bincount(parents[parents >= 0], minlength=len(parents))
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for i, (parent, edge) in enumerate(zip(parents, edges, strict=True)):
            if parent < 0 or edge >= sizes[i]:      # over such an edge the parent's intervals say less than the norms alone
                low = (self.exact @ xs[i].astype(self.number)).astype(np.float64)
                high = low.copy()
            else:
                slack = edge * self.norm
                low, high = known[parent][0] - slack, known[parent][1] + slack
            if parent >= 0:
                children[parent] -= 1
                if not children[parent]:
                    del known[parent]
            if self.number is np.int64:     # scores that a double rounds
                blur = self.norm * (sizes[i] * 2.0 ** -48)
                low, high = low - blur, high + blur
            yield i, low, high
            if children[i]:
                known[i] = (low, high)

    def rescore(self, q: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Integer scores of the rows at ``at``; their intervals shrink to them."""
        q = q.astype(self.number)
        scores = ((self.exact @ q)[at] if 2 * len(at) > len(low) else self.exact[at] @ q).astype(np.int64)
        low[at] = high[at] = scores
        return scores


def _sure(low: np.ndarray, k: int) -> float:
    """The k-th highest of ``low``; nothing is sure where there are fewer."""
    return np.partition(low, len(low) - k)[len(low) - k] if len(low) >= k else -np.inf


def _positives(k: int, width: int, number: type):
    def answer(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list] = {n: [] for n in ("anchor", "anchor_id", "positive_id", "positive_score")}
        if rows.num_rows and queries.num_rows:
            walk, ids, order = _Walk(matrix(rows["x"], width), number), rows["vec_id"], sort_ids(rows["vec_id"])
            label, row = rows["label"].to_numpy(), rows["row"].to_numpy()
            for tree, xs in _by_tree(queries, width):
                anchor, own, anchor_id = tree["row"].to_numpy(), tree["label"].to_numpy(), tree["vec_id"].to_pylist()
                for i, low, high in walk.visit(tree, xs):
                    same = np.flatnonzero((label == own[i]) & (row != anchor[i]))
                    at = same[high[same] >= _sure(low[same], k)]
                    scores = walk.rescore(xs[i], at, low, high)
                    best = highest(scores, order[at], k)
                    out["anchor"] += [int(anchor[i])] * len(best)
                    out["anchor_id"] += [anchor_id[i]] * len(best)
                    out["positive_id"] += ids.take(pa.array(at[best])).to_pylist()
                    out["positive_score"] += scores[best].tolist()
        return pa.table({n: pa.array(c, pa.int64()) for n, c in out.items()})
    return answer


def _negatives(k: int, least: int, most: int, width: int, number: type):
    def answer(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list] = {n: [] for n in ("anchor", "slot", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")}
        if rows.num_rows and queries.num_rows:
            walk, ids, order = _Walk(matrix(rows["x"], width), number), rows["vec_id"], sort_ids(rows["vec_id"])
            label = rows["label"].to_numpy()
            for tree, xs in _by_tree(queries, width):
                anchor, own = tree["row"].to_pylist(), tree["label"].to_numpy()
                anchor_id, positives = tree["vec_id"].to_pylist(), tree["positives"].to_pylist()
                for i, low, high in walk.visit(tree, xs):
                    other = label != own[i]
                    # windows in whole scores: least% to most% of the positive's score
                    windows = {p["positive_score"]: (-(-least * p["positive_score"] // 100), most * p["positive_score"] // 100) for p in positives[i] or []}
                    need = np.zeros(len(low), bool)
                    for a, b in windows.values():
                        if a <= b:
                            bar = max(a, _sure(low[other & (low >= a) & (high <= b)], k))
                            need |= other & (high >= bar) & (low <= b)
                    at = np.flatnonzero(need)
                    scores = walk.rescore(xs[i], at, low, high)
                    found = {}
                    for score, (a, b) in windows.items():
                        inside = np.flatnonzero((scores >= a) & (scores <= b))
                        found[score] = inside[highest(scores[inside], order[at[inside]], k)]
                    for p in positives[i] or []:
                        best = found[p["positive_score"]]
                        for name, value in (("anchor", anchor[i]), ("slot", p["slot"]), ("anchor_id", anchor_id[i]),
                                            ("positive_id", p["positive_id"]), ("positive_score", p["positive_score"])):
                            out[name] += [value] * len(best)
                        out["negative_id"] += ids.take(pa.array(at[best])).to_pylist()
                        out["negative_score"] += scores[best].tolist()
        return pa.table({n: pa.array(c, pa.int64()) for n, c in out.items()})
    return answer


def _by_tree(queries: pa.Table, width: int):
    """(rows of one tree in tree order, their vectors) for each tree of the block of queries."""
    queries = queries.sort_by([("block", "ascending"), ("place", "ascending")])
    cut = np.flatnonzero(np.diff(queries["block"].to_numpy())) + 1
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), queries.num_rows], strict=True):
        tree = queries.slice(a, b - a)
        yield tree, matrix(tree["x"], width)


def mine(df: DataFrame, is_anchor: Column, label: Column, scale: int, n_positives: int = 5, n_negatives: int = 10,
         least: int = 30, most: int = 90, vector: str = "embedding") -> DataFrame:
    """Hard negatives of each anchor and positive.

    ``df``: vec_id and ``vector`` (components become floor(scale * x)); ``label``: a row's label (null: no part). Positives are the ``n_positives`` other
    rows of the same label with the highest integer inner products; negatives the first ``n_negatives`` rows of other labels
    with ``least`` * positive_score <= 100 * negative_score <= ``most`` * positive_score; ties to the smaller id. Returns anchor_id,
    positive_id, rank (int, from 1), negative_id, positive_score, negative_score.
    """
    v = integers(df.where(label.isNotNull()), lambda c: F.floor(c * scale),
                 {"vec_id": F.col("vec_id").cast("long"), "label": label.cast("int"), "is_anchor": F.coalesce(is_anchor, F.lit(False))}, vector)
    rows = v.rows.select("row", "vec_id", "label", "x")
    trees = _trees(v, v.rows.where("is_anchor"))
    n = trees.count()
    # whole trees go to a block of queries
    block = F.floor(F.col("block") / max(1, BLOCK_QUERIES // TREE))

    close = grid(rows, v.n, trees, n, _positives(n_positives, v.width, v.number),
                 "anchor long, anchor_id long, positive_id long, positive_score long", block)
    by_score = Window.partitionBy("anchor").orderBy(F.col("positive_score").desc(), F.col("positive_id").asc_nulls_last())
    close = close.withColumn("slot", F.row_number().over(by_score).cast("long")).where(F.col("slot") <= n_positives)
    positives = close.groupBy("anchor").agg(F.collect_list(F.struct("slot", "positive_id", "positive_score")).alias("positives"))
    asked = stash(trees.join(positives, trees["row"] == positives["anchor"], "left").drop("anchor"), "positives")

    far = grid(rows, v.n, asked, n, _negatives(n_negatives, least, most, v.width, v.number),
               "anchor long, slot long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long", block)
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last())
    best = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_negatives)
    return best.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score")
