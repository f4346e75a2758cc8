"""Streaming sources: queue messages (S7) and uploaded code files.

Structured Streaming file sources, and a Kafka topic through ``readStream.format("kafka")``; files per
micro-batch are capped with ``maxFilesPerTrigger``, rows by the stored queue (``streaming.queue``, T2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postalspark.operators.codes import mark_valid
from postalspark.sources.codes import path_exists

# Microsecond text form of timestamps in message files (the default keeps milliseconds).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

MESSAGE_FILE = T.StructType([
    T.StructField("seq", T.LongType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("consumer", T.LongType(), True),
    T.StructField("ok", T.BooleanType(), True),
    T.StructField("body", T.StringType(), True),
])


def stream_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                    schema: T.StructType = MESSAGE_FILE) -> DataFrame:
    """Unbounded source of JSON message records (one JSON object per line)."""
    r = spark.readStream.schema(schema).option("timestampNTZFormat", TS_FORMAT)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.json(path)


def stream_message_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S7 on plain text: one message body per line (what ``sinks.files.write_messages``
    publishes); the body column is ``body``."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.text(path).select(F.col("value").alias("body"))


def stream_messages_kafka(spark: SparkSession, bootstrap_servers: str, topic: str,
                          max_offsets_per_trigger: int | None = None) -> DataFrame:
    """S7 on a Kafka topic: one row per record with its offset as ``seq`` and the
    message text as ``body`` (the Kafka connector must be on the classpath)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topic).option("startingOffsets", "earliest"))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
    return r.load().select(F.col("offset").alias("seq"), F.col("timestamp").alias("ts"),
                           F.col("partition").cast("long").alias("consumer"),
                           F.col("value").cast("string").alias("body"))


def stream_uploaded_csv(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                        columns: list[str] | None = None) -> DataFrame:
    """Each newly arrived code CSV, validated (C4); other columns kept as text.

    Columns are bound by name: ``columns`` or, without it, the header of what has arrived already (only
    ``cep`` when nothing has). A header without ``cep`` raises ValueError, as S1 does; a later file with
    another header stops the stream instead of shifting its columns (``enforceSchema=false``).
    """
    if columns is None:
        have = path_exists(spark, path)
        columns = spark.read.option("header", True).csv(path).columns if have else ["cep"]
    if "cep" not in columns:
        raise ValueError("CSV file must contain 'cep' column")
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    r = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False).option("escape", '"')
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return mark_valid(r.csv(path))


def _write_files(df: DataFrame, path: str, fmt: str) -> None:
    w = df.write.mode("append")
    if fmt == "csv":
        w.option("header", True).option("ignoreLeadingWhiteSpace", False) \
         .option("ignoreTrailingWhiteSpace", False).csv(path)
    else:
        w.option("timestampNTZFormat", TS_FORMAT).json(path)


def write_arrivals(df: DataFrame, path: str, order: str, files: int, fmt: str = "json") -> str:
    """Lay a table out as ``files`` files of consecutive ``order`` ranges: one job, a task per file.

    The ranges come from sampled cut points. For consumers to which the order of arrival doesn't matter.
    """
    _write_files(df.repartitionByRange(files, order).sortWithinPartitions(order), path, fmt)
    return path
