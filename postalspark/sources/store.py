"""Reads of the address table (S5) and of the error log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postalspark.operators.scan import global_row_number
from postalspark.schemas import ERROR_LOG
from postalspark.sources.codes import path_exists


def scan_addresses(addresses: DataFrame, limit: int | None = None, offset: int = 0) -> DataFrame:
    """All stored rows ordered by code; 0 or None means no limit.

    Ordered by the key first, so a page repeats from run to run. A limit alone is a per-partition
    top-n with one merge of ``limit`` rows. With an offset rows are numbered over sampled ranges of the
    code and the page is filtered by number, so the rows before it are never gathered in a task.
    """
    if offset:
        numbered = global_row_number(addresses, "cep", "_rn").where(F.col("_rn") > int(offset))
        if limit:
            numbered = numbered.where(F.col("_rn") <= int(offset) + int(limit))
        return numbered.drop("_rn").orderBy("cep")
    out = addresses.orderBy("cep")
    return out.limit(int(limit)) if limit else out


def read_address_table_jdbc(spark: SparkSession, url: str, table: str = "ceps", properties: dict | None = None,
                            num_partitions: int = 8) -> DataFrame:
    """S5 from an existing relational table: a parallel JDBC read split on the code
    (eight-digit text, so the split bounds are numeric casts of it)."""
    query = f"(SELECT *, CAST(cep AS BIGINT) AS cep_num FROM {table}) t"
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", query)
              .option("partitionColumn", "cep_num").option("lowerBound", 0).option("upperBound", 99999999)
              .option("numPartitions", num_partitions))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load().drop("cep_num")


def read_error_log(spark: SparkSession, path: str) -> DataFrame:
    """The error CSV with its fixed header; a missing file reads as empty.

    Fields are text as in the file: an empty field reads as '' (never NULL).
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], ERROR_LOG)
    return (spark.read.schema(ERROR_LOG).option("header", True).option("multiLine", True)
            .option("escape", '"').csv(path).na.fill(""))


def filter_errors(errors: DataFrame, cep: str | None = None, error_type: str | None = None) -> DataFrame:
    """optional code AND optional type filters (pushed into the scan)."""
    if cep:
        errors = errors.where(F.col("cep") == F.lit(cep))
    if error_type:
        errors = errors.where(F.col("error_type") == F.lit(error_type))
    return errors
