"""Operators over code tables: validate, filter, count, sort, cap, number in batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postalspark.functions.codes import clean_code, is_valid_code
from postalspark.operators.scan import global_row_number
from postalspark.sources.codes import read_codes_csv


def mark_valid(codes: DataFrame) -> DataFrame:
    """C4: add ``is_valid`` (BooleanType, never NULL); other columns kept."""
    return codes.withColumn("is_valid", is_valid_code("cep"))


def _marked(codes: DataFrame) -> DataFrame:
    return codes if "is_valid" in codes.columns else mark_valid(codes)


def valid_codes(codes: DataFrame) -> DataFrame:
    """valid rows only, code cleaned to eight digits (marks first if unmarked)."""
    keep = [c for c in codes.columns if c not in ("cep", "is_valid")]
    return _marked(codes).where("is_valid").select(*keep, clean_code("cep").alias("cep"))


def invalid_codes(codes: DataFrame) -> DataFrame:
    """invalid rows only, code cleaned the same way (NULL stays NULL)."""
    keep = [c for c in codes.columns if c not in ("cep", "is_valid")]
    return _marked(codes).where(~F.col("is_valid")).select(*keep, clean_code("cep").alias("cep"))


def load_and_validate(spark: SparkSession, path: str) -> DataFrame:
    """S1 then C4."""
    return mark_valid(read_codes_csv(spark, path))


def code_stats(codes: DataFrame) -> DataFrame:
    """A1: one row: total, valid, invalid (a single map-side-combined aggregate)."""
    m = _marked(codes)
    return m.agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(F.col("is_valid")).alias("valid"),
                 F.count_if(~F.col("is_valid")).alias("invalid"))


def sample_invalid(codes: DataFrame, n: int = 5, order: str = "row_id") -> DataFrame:
    """The first ``n`` invalid values in input order, each with the invalid total.

    The top-n is a per-partition top-n plus one merge; the total is a one-row
    aggregate joined on a constant key (its size is 1 by construction).
    """
    bad = _marked(codes).where(~F.col("is_valid"))
    first = bad.orderBy(order).limit(n).select(order, "cep", F.lit(1).alias("_k"))
    total = bad.agg(F.count(F.lit(1)).alias("invalid_count")).withColumn("_k", F.lit(1))
    return first.join(F.broadcast(total), "_k").drop("_k")


def distinct_codes(codes: DataFrame, col: str = "cep") -> DataFrame:
    """Set semantics of a code column."""
    return codes.select(col).dropDuplicates([col])


def sort_codes(codes: DataFrame, col: str = "cep") -> DataFrame:
    """L2: distinct codes in ascending order (range-partitioned sort)."""
    return distinct_codes(codes, col).orderBy(col)


def cap_codes(codes: DataFrame, max_codes: int, col: str = "cep") -> DataFrame:
    """L1: keep the ``max_codes`` smallest distinct codes (TakeOrderedAndProject)."""
    return distinct_codes(codes, col).orderBy(col).limit(int(max_codes))


def number_batches(codes: DataFrame, batch_size: int, key: str = "row_id") -> DataFrame:
    """Consecutive batches of ``batch_size`` rows in ``key`` order.

    The global row number comes from bucketed running counts, not from a
    single-partition ``row_number`` window.
    """
    numbered = global_row_number(codes, key, "_rn")
    return numbered.withColumn("batch", F.floor((F.col("_rn") - 1) / F.lit(int(batch_size))).cast("long")).drop("_rn")


def batch_size_for(rate_per_second: float) -> int:
    """Batch size of the batch job: one minute of lookups at the given rate."""
    return int(rate_per_second * 60)
