"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postalspark.session import scratch_dir

#: word separators of every operator here: blank and the ASCII controls 9 to 13
WORD_SEPARATORS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read lazily (Spark's own reader, any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores in front until no column has it (names are compared as Spark does, without case)."""
    have = {c.lower() for c in taken}
    while name.lower() in have:
        name = "_" + name
    return name


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: lineage ends at files every executor sees."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_map(df: DataFrame, rows: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """Apply ``rows`` (columns as lists in, columns as lists out) to each Arrow batch of ``df``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = rows({k: v.to_pylist() for k, v in zip(batch.schema.names, batch.columns, strict=True)})
            yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def has_repeats(df: DataFrame, key: str) -> bool:
    """Whether ``key`` is null or repeated in any row (one column read, partial counts before the shuffle)."""
    return bool(df.groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull()).take(1))


def ranked(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """``df`` with ``out``: 0-based rank by ``order`` (nulls first), without a one-task window.

    Rows are range partitioned and sorted, numbered within their partition, stored, and shifted by
    the row counts of the partitions before (one number per partition goes to the driver).
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in order])
    ordered = ordered.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
    # partition id in the high bits, position in the low 33 bits
    at = stash(ordered.withColumn("__at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__at", 33)
    sizes = {r["p"]: r["n"] for r in at.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    shifts, before = [], 0
    for p in range(max(sizes, default=-1) + 1):
        shifts.append(before - (p << 33))
        before += sizes.get(p, 0)
    shift = F.lit(0) if not shifts else F.element_at(F.array(*[F.lit(x).cast("long") for x in shifts]),
                                                     (part + 1).cast("int"))
    return at.withColumn(out, F.col("__at") + shift).drop("__at")
