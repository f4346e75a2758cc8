"""Error-log operators: build typed log rows, count, summarise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalspark.functions.errors import classify_error, error_context
from postalspark.functions.text import iso_timestamp


def error_log(failures: DataFrame) -> DataFrame:
    """C17 + C18 + C15: failed lookups -> (cep, error_type, error_message, timestamp, context).

    ``failures`` carries cep, ts, error_message and optionally status_code and attempt.
    """
    cols = failures.columns
    ctx = error_context(
        status_code=F.col("status_code") if "status_code" in cols else F.lit(None),
        retry_attempt=F.col("attempt") if "attempt" in cols else F.lit(None))
    keep = [c for c in ("seq",) if c in cols]
    return failures.select(*keep, "cep", classify_error("error_message").alias("error_type"),
                           "error_message", iso_timestamp("ts").alias("timestamp"), ctx.alias("context"))


def database_errors(failures: DataFrame, operation: str | None = None) -> DataFrame:
    """Failed table operations (cep, error_message) as ``database_error`` rows, the operation in the context."""
    return _typed(failures, "database_error", operation=operation)


def validation_errors(failures: DataFrame, validation_rule: str | None = None) -> DataFrame:
    """Rejected codes (cep, error_message) as ``validation_error`` rows, the broken rule in the context."""
    return _typed(failures, "validation_error", validation_rule=validation_rule)


def _typed(failures: DataFrame, error_type: str, **context) -> DataFrame:
    keep = [c for c in failures.columns if c not in ("cep", "error_message")]
    return failures.select(*keep, "cep", F.lit(error_type).alias("error_type"), "error_message",
                           error_context(**{k: F.lit(v) for k, v in context.items()}).alias("context"))


def count_errors(log: DataFrame, cep: str | None = None, error_type: str | None = None) -> DataFrame:
    """A3: number of log rows under the optional code and type filters."""
    from postalspark.sources.store import filter_errors
    return filter_errors(log, cep, error_type).agg(F.count(F.lit(1)).alias("error_count"))


def error_summary(log: DataFrame) -> DataFrame:
    """A4: totals by type, by code, and overall (with the distinct code count).

    One aggregation with grouping sets ((error_type), (cep), ()); ``level`` names
    the set. Partial aggregation runs before the shuffle.
    """
    g = log.groupingSets([["error_type"], ["cep"], []], "error_type", "cep").agg(
        F.count(F.lit(1)).alias("errors"),
        F.count_distinct("cep").alias("distinct_ceps"),
        F.grouping("error_type").alias("_gt"), F.grouping("cep").alias("_gc"))
    level = (F.when((F.col("_gt") == 0), F.lit("by_type"))
             .when(F.col("_gc") == 0, F.lit("by_cep")).otherwise(F.lit("total")))
    return g.select(level.alias("level"), "error_type", "cep", "errors", "distinct_ceps")


def error_summary_maps(log: DataFrame) -> DataFrame:
    """A4 as one row: total, errors by type as a map, and the distinct code count.

    The type map is built from at most seven aggregated rows; the per-code counts
    stay in long form (``error_summary``), since a map over every code is unbounded.
    """
    by_type = log.groupBy("error_type").agg(F.count(F.lit(1)).alias("n"))
    type_map = by_type.agg(F.map_from_entries(F.collect_list(F.struct("error_type", "n"))).alias("by_type"),
                           F.sum("n").alias("total_errors"))
    codes = log.agg(F.count_distinct("cep").alias("unique_ceps_with_errors")).withColumn("_k", F.lit(1))
    # both sides are one-row aggregates; the constant key joins them (size 1 by construction)
    return (type_map.select("total_errors", "by_type").withColumn("_k", F.lit(1))
            .join(F.broadcast(codes), "_k").drop("_k"))
