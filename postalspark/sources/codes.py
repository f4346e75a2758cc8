"""Code sources: the header CSV of codes (S1) and the unvalidated batch scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if the path exists on its file system (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def read_codes_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Header CSV, every column a string (no inference: leading zeros stay).

    Quotes inside a quoted value are doubled; ``multi_line`` allows line ends in one (files are not split then).

    Raises FileNotFoundError for a missing path and ValueError when the file has no
    ``cep`` column or no rows.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"CSV file not found: {path}")
    df = (spark.read.option("header", True).option("inferSchema", False)
          .option("mode", "PERMISSIVE").option("escape", '"').option("multiLine", multi_line).csv(path))
    if "cep" not in df.columns:
        raise ValueError("CSV file must contain 'cep' column")
    if df.isEmpty():
        raise ValueError("CSV file is empty")
    return df


def scan_codes_unvalidated(codes: DataFrame) -> DataFrame:
    """Keep non-null, non-empty codes, hyphens removed; no validation."""
    keep = [c for c in codes.columns if c != "cep"]
    return (codes.where(F.col("cep").isNotNull() & (F.col("cep") != ""))
                 .select(*keep, F.replace(F.col("cep"), F.lit("-"), F.lit("")).alias("cep")))
