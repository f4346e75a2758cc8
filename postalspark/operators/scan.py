"""Skew-safe ordered scans (running totals, global numbering).

A window with no PARTITION BY (or partitioned by one hot key) sends every row
of that key to one task. Here rows are range partitioned by the whole order
(group, lead, key) at cut points that Spark samples from the data, so ranges
hold about equally many rows whatever the keys look like, and a hot group
spans many ranges. The total of each (group, range) is a small aggregate, the
prefix over a group's ranges is a window over at most as many rows as there are
ranges, and the running value inside a range is a window whose size is one
range. Rows never move to one task. The number of ranges is the session's
shuffle partition count, which is sized to the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postalspark.session import ensure_checkpoint_dir


def running_total(df: DataFrame, key: str, value: Column, out: str, lead: list[str] | None = None,
                  partition_by: list[str] | None = None, ranges: int | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` over rows ordered by (*lead, key) within ``partition_by``.

    ``key`` may have any orderable type; ties in (*lead, key) are summed in no particular order.
    The ranged rows are checkpointed once, as the totals and the rows both read them.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    lead, part = list(lead or []), list(partition_by or [])
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.withColumn("_v", value).repartitionByRange(n, *part, *lead, key)
              .withColumn("_b", F.spark_partition_id()).checkpoint())
    totals = ranged.groupBy(*part, "_b").agg(F.sum("_v").alias("_t"))
    # ranges ascend in (group, lead, key), so their numbers order a group's ranges
    before = Window.partitionBy(*part).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate([*part, "_b"])],
                            F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    inside = (Window.partitionBy(*part, "_b").orderBy(*lead, key)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = ranged.withColumn("_in", F.sum("_v").over(inside))
    cond = [rows[c].eqNullSafe(offsets[f"_o{i}"]) for i, c in enumerate([*part, "_b"])]
    return (rows.join(offsets, cond, "inner").withColumn(out, F.col("_off") + F.col("_in"))
                .drop("_v", "_b", "_off", "_in", *[f"_o{i}" for i in range(len(part) + 1)]))


def global_row_number(df: DataFrame, key: str, out: str = "rn", lead: list[str] | None = None,
                      partition_by: list[str] | None = None, ranges: int | None = None) -> DataFrame:
    """1-based row number by (*lead, key) within ``partition_by`` (unique keys give a dense 1..n)."""
    return running_total(df, key, F.lit(1).cast("long"), out, lead, partition_by, ranges)
