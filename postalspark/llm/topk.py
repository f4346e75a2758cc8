"""Exact top-k search over an impact-ordered, score-at-a-time index.

Per shard and dimension, rows are posted in segments of equal quantised component (at most `LEVELS` levels). For a
query, the impact of a segment is the query's absolute component times the level, counted from the end that scores
low for the query's sign, so every impact is nonnegative. Segments are processed by descending impact, class after
class, into one accumulator per row. After a class, a row's score lies between what it has gathered and that plus
the highest impact left in each dimension in which its segment is still to come, plus the quantisation error.
Processing ends only when the rows that these bounds leave possible for the k places are few; all of them are
rescored by exact integer products. If the bounds never narrow, all segments are processed and the proof is of quantisation alone.

Defined cases: vectors that are null or hold a null, NaN or infinite component take no part, as queries or rows;
shorter vectors are padded by zeros; a null id is no query and comes last among ties; rows that repeat an id
are rows of their own (each of them a query, if the id is one, which leaves out only itself); an empty table gives no rows;
fewer rows than k give all. Other columns are ignored. Scores beyond a long raise an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .vectors import grid, highest, integers, matrix, sort_ids

#: quantised impacts per dimension
LEVELS = 256
#: impact classes as parts of the query's highest impact, processed in this order; the last takes all that is left
CLASSES = (0.2, 0.12, 0.06, 0.0)
#: rescoring starts once this part of the shard's rows, or four times k, is still possible
FEW = 1 / 8


class Postings:
    """The segments of one shard: line ``d`` for queries positive in dimension ``d``, line ``width + d`` for negative ones."""

    def __init__(self, x: np.ndarray, levels: int = LEVELS):
        self.n, self.width = x.shape
        low = x.min(axis=0)
        span = x.max(axis=0) - low
        self.shift = np.array([max(0, int(s).bit_length() - (levels - 1).bit_length()) for s in span], np.int64)
        level = ((x - low) >> self.shift).T
        top = level.max(axis=1, initial=0)
        self.top = np.concatenate([top, top])
        self.level = np.concatenate([level, top[:, None] - level]).astype(np.int16)
        self.order = np.argsort(self.level, axis=1, kind="stable")
        self.sorted = np.take_along_axis(self.level, self.order, axis=1)
        # starts[line, l]: where level l begins in the line; one more column for the end
        self.starts = np.stack([np.searchsorted(line, np.arange(levels + 1, dtype=np.int16)) for line in self.sorted]
                               ) if self.width else np.zeros((0, levels + 1), np.int64)

    def possible(self, q: np.ndarray, k: int, own: int | None) -> np.ndarray:
        """Positions of all rows that can be among the ``k`` highest for ``q``, the row at ``own`` left out."""
        few = max(4 * k, int(self.n * FEW))
        if self.n - (own is not None) <= few:
            return np.delete(np.arange(self.n), own) if own is not None else np.arange(self.n)
        used = np.flatnonzero(q)
        size = np.abs(q[used])
        line = used + self.width * (q[used] < 0)
        weight = (size << self.shift[used]).astype(np.float64)
        error = float((size * ((1 << self.shift[used]) - 1)).sum())
        impact = float((weight * self.top[line]).max(initial=0.0))
        done, gathered, level = np.full(len(line), self.n), np.zeros(self.n), self.level[line]
        for part in CLASSES:
            least = np.minimum(np.ceil(part * impact / weight), self.top[line] + 1).astype(np.int64)  # lowest level of this class
            begin = self.starts[line, least]
            at = np.concatenate([self.order[i, a:b] for i, a, b in zip(line, begin, done, strict=True)] or [np.zeros(0, np.int64)])
            levels = np.concatenate([self.sorted[i, a:b] for i, a, b in zip(line, begin, done, strict=True)] or [np.zeros(0, np.int16)])
            gathered += np.bincount(at, levels * np.repeat(weight, done - begin), minlength=self.n)
            done = begin
            # a segment still to come gives at most the level below this class
            ahead = np.einsum("d,dn->n", np.maximum(least - 1, 0) * weight, level < least[:, None].astype(np.int16))
            lower = gathered if own is None else np.where(np.arange(self.n) == own, -np.inf, gathered)
            bar = np.partition(lower, self.n - k)[self.n - k]
            keep = lower + ahead + error >= bar
            if keep.sum() <= few:
                break
        return np.flatnonzero(keep)


def _search(k: int, width: int, number: type):
    def answer(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query": [], "query_id": [], "vec_id": [], "score": []}
        if rows.num_rows and queries.num_rows:
            x, qs = matrix(rows["x"], width), matrix(queries["x"], width)
            exact = x.astype(number)
            ids, order = rows["vec_id"], sort_ids(rows["vec_id"])
            place = {r: p for p, r in enumerate(rows["row"].to_pylist())}
            index = Postings(x)
            for q, row, query_id in zip(qs, queries["row"].to_pylist(), queries["vec_id"].to_pylist(), strict=True):
                at = index.possible(q, k, place.get(row))
                scores = (exact[at] @ q.astype(number)).astype(np.int64)
                best = highest(scores, order[at], k)
                out["query"] += [row] * len(best)
                out["query_id"] += [query_id] * len(best)
                out["vec_id"] += ids.take(pa.array(at[best])).to_pylist()
                out["score"] += scores[best].tolist()
        return pa.table({name: pa.array(v, pa.int64()) for name, v in out.items()})
    return answer


def top_k(df: DataFrame, is_query: Column, k: int, scale: int, vector: str = "embedding") -> DataFrame:
    """The ``k`` rows of highest integer inner product for each row of ``df`` for which ``is_query`` holds.

    ``df``: vec_id and ``vector``; components become floor(scale * x). Returns query_id, rank (int, from 1), vec_id, score.
    """
    v = integers(df, lambda c: F.floor(c * scale), {"vec_id": F.col("vec_id").cast("long"), "is_query": F.coalesce(is_query, F.lit(False))}, vector)
    queries = v.rows.where("is_query").select("row", "vec_id", "x")
    found = grid(v.rows.select("row", "vec_id", "x"), v.n, queries, queries.count(), _search(k, v.width, v.number),
                 "query long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
