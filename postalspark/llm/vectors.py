"""Integer vectors of an embedding table, and the grid on which a stated set of rows meets all rows.

A vector takes part if it is not null and holds no null, NaN or infinite component. Vectors shorter than the
longest count as padded by zeros (an empty vector is the zero vector). Rows that share an id stay rows of their
own: each gets a ``row`` number that is written once, so no later step depends on how a scan was split.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash

#: most rows of a shard and most queries of a block: what one task holds at a time
SHARD_ROWS, BLOCK_QUERIES = 8_192, 8_192
#: shards are not cut smaller than this to occupy idle cores
LEAST_ROWS = 4_096


@dataclass(frozen=True)
class Vectors:
    """Stored rows (`row`, the kept columns, `x` array<long>), their number, longest length and largest component."""

    rows: DataFrame
    n: int
    width: int
    largest: int

    @property
    def number(self) -> type:
        """A type in which every inner product of two rows is exact."""
        top = self.width * self.largest * self.largest
        if top >= 1 << 63:
            raise ValueError(f"inner products of components up to {self.largest} do not fit a long")
        return np.float64 if top < 1 << 53 else np.int64


def finite(vector: Column) -> Column:
    """Whether a vector takes part: not null, and every component a finite number."""
    def odd(c: Column) -> Column:
        d = c.cast("double")
        return d.isNull() | F.isnan(d) | (F.abs(d) == F.lit(math.inf))
    return vector.isNotNull() & F.coalesce(~F.exists(vector, odd), F.lit(False))


def integers(df: DataFrame, component: Callable[[Column], Column], keep: dict[str, Column], vector: str = "embedding") -> Vectors:
    """The rows of ``df`` that take part, with ``component`` (of a double) applied to each component, stored once."""
    x = F.transform(F.col(vector), lambda c: component(c.cast("double")).cast("long"))
    chosen = df.where(finite(F.col(vector))).select(*[c.alias(k) for k, c in keep.items()], x.alias("x"))
    rows = stash(chosen.select(F.monotonically_increasing_id().alias("row"), "*"), "vectors")
    size = rows.agg(F.count("*"), F.max(F.size("x")), F.max(F.array_max("x")), F.min(F.array_min("x"))).first()
    return Vectors(rows, size[0], size[1] or 0, max(abs(size[2] or 0), abs(size[3] or 0)))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """A list column as an int64 matrix, short rows padded by zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy()[offsets[0]:offsets[-1]] if len(column) else np.zeros(0, np.int64)
    lengths = np.diff(offsets)
    if (lengths == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def highest(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores (all, if fewer), in order, ties to the smaller id."""
    at = np.arange(len(scores))
    if len(at) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def sort_ids(ids: pa.ChunkedArray) -> np.ndarray:
    """Ids for comparing ties; null ids come last."""
    return ids.fill_null(np.iinfo(np.int64).max).to_numpy()


def grid(rows: DataFrame, n_rows: int, queries: DataFrame, n_queries: int,
         answer: Callable[[pa.Table, pa.Table], pa.Table], schema: str, block: Column | None = None) -> DataFrame:
    """``answer(rows of a shard, queries of a block)`` for every shard and block.

    Rows are dealt to shards by a hash of their unique ``row``, so neither a hot id nor a hot vector makes a shard
    large. Each cell is one group of bounded size; a row is sent once per `BLOCK_QUERIES` queries, a query once
    per shard. ``block`` may deal queries itself (blocks below ceil(n_queries / `BLOCK_QUERIES`)).
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    shards = max(1, math.ceil(n_rows / SHARD_ROWS), min(n_rows // LEAST_ROWS, 4 * cores))
    blocks = max(1, math.ceil(n_queries / BLOCK_QUERIES))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)) if block is None else block
    shard = F.pmod(F.xxhash64("row"), F.lit(shards))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = rows.select("*", every(blocks).alias("__b")).select(*rows.columns, (shard * blocks + F.col("__b")).alias("cell"))
    right = queries.select("*", block.alias("__b"), every(shards).alias("__s"))
    right = right.select(*queries.columns, (F.col("__s") * blocks + F.col("__b")).cast("long").alias("cell"))
    return left.groupBy("cell").cogroup(right.groupBy("cell")).applyInArrow(answer, schema)
