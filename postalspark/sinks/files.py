"""File sinks: code CSV, JSON Lines and XML exports, Parquet result set, error log.

Every writer is a distributed ``DataFrameWriter`` call: no rows pass through
the driver. Exports are JSON Lines / XML row files plus a one-row metadata
file beside them; a single in-memory document is the ``documents`` module's
job (per row or per group value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postalspark.functions.codes import dehyphenate
from postalspark.functions.text import iso_timestamp
from postalspark.schemas import ADDRESS_FIELDS, ERROR_LOG, ERROR_LOG_FIELDS, PARQUET_FIELDS
from postalspark.session import remove_path, scratch_dir
from postalspark.sources.store import scan_addresses


def _spark(df: DataFrame) -> SparkSession:
    return df.sparkSession


def write_csv(df: DataFrame, name: str, path: str | None = None) -> str:
    """Header CSV with values written verbatim (no trimming); returns the path."""
    path = path or scratch_dir(_spark(df), name)
    (df.write.mode("overwrite").option("header", True)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))
    return path


def write_codes_csv(codes: DataFrame, path: str | None = None, single_file: bool = False) -> str:
    """K1: distinct codes, sorted, hyphen removed, header ``cep``.

    Files hold ascending, non-overlapping code ranges (range partitioning), so
    reading the part files in name order gives the sorted list; one file only
    when asked.
    """
    out = codes.select(dehyphenate("cep").alias("cep")).dropDuplicates(["cep"]).orderBy("cep")
    if single_file:
        out = out.coalesce(1)
    return write_csv(out, "codes_csv", path)


def export_rows(addresses: DataFrame) -> DataFrame:
    """C15 rows in export order, times as ISO text."""
    return addresses.select(*ADDRESS_FIELDS, iso_timestamp("created_at").alias("created_at"),
                            iso_timestamp("updated_at").alias("updated_at"))


def _observed(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows while they are written (no second pass over the data)."""
    obs = Observation()
    return rows.observe(obs, F.count(F.lit(1)).alias("n")), obs


def _page(addresses: DataFrame, limit: int | None, offset: int) -> DataFrame:
    """A page in code order; the whole table as it lies (a full export has no order)."""
    return scan_addresses(addresses, limit, offset) if limit or offset else addresses


def _nothing(counted: DataFrame, obs: Observation, path: str) -> bool:
    """Whether the write held no row; its empty folder goes."""
    if obs.get["n"]:
        return False
    remove_path(_spark(counted), path)
    return True


def _metadata(spark: SparkSession, total: int, export_date: str, limit, offset, with_paging: bool) -> DataFrame:
    md = spark.range(1).select(F.lit(export_date).alias("export_date"), F.lit(total).cast("long").alias("total_ceps"))
    if with_paging:
        md = md.withColumn("limit", F.lit(limit).cast("int")).withColumn("offset", F.lit(int(offset)).cast("int"))
    return md


def export_json(addresses: DataFrame, path: str, export_date: str, limit: int | None = None, offset: int = 0,
                include_metadata: bool = True, with_paging: bool = True) -> bool:
    """K2: table -> JSON Lines under ``path/ceps`` (+ ``path/metadata``); False when empty.

    NULL fields are written (``ignoreNullFields=false``) and non-ASCII text is kept.
    """
    counted, obs = _observed(export_rows(_page(addresses, limit, offset)))
    counted.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/ceps")
    if _nothing(counted, obs, f"{path}/ceps"):
        return False
    if include_metadata:
        (_metadata(_spark(addresses), obs.get["n"], export_date, limit, offset, with_paging)
         .write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/metadata"))
    return True


def export_json_rows(rows: DataFrame, path: str, export_date: str, include_metadata: bool = True) -> bool:
    """K3: the same writer for any row set; metadata without limit/offset."""
    return export_json(rows, path, export_date, None, 0, include_metadata, with_paging=False)


def export_xml(addresses: DataFrame, path: str, export_date: str, limit: int | None = None, offset: int = 0,
               include_metadata: bool = True, root_element_name: str = "ceps", with_paging: bool = True) -> bool:
    """K5: table -> XML files (root ``root_element_name``, one ``<cep>`` per row); False when empty.

    NULL fields are left out; the metadata (limit only if set, offset only if > 0)
    goes to ``path/metadata``.
    """
    counted, obs = _observed(export_rows(_page(addresses, limit, offset)))
    (counted.write.mode("overwrite").format("xml").option("rootTag", root_element_name)
     .option("rowTag", "cep").save(f"{path}/ceps"))
    if _nothing(counted, obs, f"{path}/ceps"):
        return False
    if include_metadata:
        md = _spark(addresses).range(1).select(F.lit(export_date).alias("export_date"),
                                          F.lit(obs.get["n"]).cast("long").alias("total_ceps"))
        if with_paging and limit is not None:
            md = md.withColumn("limit", F.lit(int(limit)))
        if with_paging and offset > 0:
            md = md.withColumn("offset", F.lit(int(offset)))
        (md.write.mode("overwrite").format("xml").option("rootTag", root_element_name)
         .option("rowTag", "metadata").save(f"{path}/metadata"))
    return True


def export_xml_rows(rows: DataFrame, path: str, export_date: str, include_metadata: bool = True,
                    root_element_name: str = "ceps") -> bool:
    """K6: the same XML writer for any row set."""
    return export_xml(rows, path, export_date, None, 0, include_metadata, root_element_name, with_paging=False)


def read_xml_export(spark: SparkSession, path: str) -> DataFrame:
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(f, T.StringType(), True)
                           for f in ADDRESS_FIELDS + ["created_at", "updated_at"]])
    return spark.read.format("xml").option("rowTag", "cep").schema(schema).load(f"{path}/ceps")


def write_messages(published: DataFrame, path: str) -> str:
    """K13 batch publish: one message body per line (a file queue; ``format("kafka")``
    with a ``value`` column publishes the same frame to a topic)."""
    published.select("value").write.mode("append").text(path)
    return path


def write_parquet(addresses: DataFrame, path: str) -> str:
    """K8: overwrite the result set as Parquet with the eight job columns."""
    addresses.select(*PARQUET_FIELDS).write.mode("overwrite").parquet(path)
    return path


def append_errors(errors: DataFrame, path: str | None, recorded_at=None, mode: str = "append") -> str:
    """Append typed error rows (header on every part file, as one CSV table).

    ``errors`` has cep, error_type, error_message and optionally timestamp/context;
    a missing timestamp is the UTC time of the write.
    """
    cols = errors.columns
    utc_now = F.to_utc_timestamp(F.current_timestamp(), _spark(errors).conf.get("spark.sql.session.timeZone"))
    ts = F.col("timestamp") if "timestamp" in cols else iso_timestamp(
        recorded_at if recorded_at is not None else utc_now)
    ctx = F.col("context") if "context" in cols else F.lit("")
    rows = errors.select("cep", "error_type", "error_message", ts.alias("timestamp"), ctx.alias("context"))
    path = path or scratch_dir(_spark(errors), "errors_csv")
    rows.select(*ERROR_LOG_FIELDS).write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path


def clear_errors(spark: SparkSession, path: str) -> bool:
    """Empty the log and keep its header."""
    spark.createDataFrame([], ERROR_LOG).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return True
