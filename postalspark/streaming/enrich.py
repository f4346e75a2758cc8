"""Stream processing of code messages.

Messages -> drop unusable ones (F8) -> look up against the parsed answers (one join inside each
micro-batch) -> found addresses, error rows and malformed messages. All three outcomes of a
micro-batch are written first and named in one commit of the address table, so a reader
sees all of a batch or none of it, and a replayed batch that the table has seen is skipped: checkpointed offsets plus
one commit per batch give effectively-once results.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import StreamingQueryException

from postalspark.functions.responses import OK, address_columns
from postalspark.functions.text import iso_timestamp
from postalspark.operators.joins import broadcast_if_small
from postalspark.operators.lookup import ABSENT, failure_rows, last_answer, lookup_table
from postalspark.operators.messages import dead_letters, drop_bad_messages, process_limit
from postalspark.schemas import ADDRESS_FIELDS, ERROR_LOG_FIELDS
from postalspark.session import scratch_dir
from postalspark.sinks.table import AddressTable, Progress
from postalspark.streaming.queue import _store

Handler = Callable[[DataFrame, int], None]

ERRORS, DEAD = "errors", "dead"
ERROR_ROWS = ", ".join(f"{f} string" for f in ERROR_LOG_FIELDS)

#: a local checkpoint folder without checksum files (other file systems are not concerned)
PLAIN_LOGS = ("fs.AbstractFileSystem.file.impl", "org.apache.hadoop.fs.local.RawLocalFs")


class LimitReached(Exception):
    """The limit fell into this micro-batch: it stays open in the checkpoint and goes on with the next run."""


def run_available(stream: DataFrame, handler: Handler, checkpoint: str, processing_time: str | None = None):
    """Run ``handler`` per micro-batch until the input that has arrived is drained.

    Batches follow one another at once. With ``processing_time`` (e.g. ``"60 seconds"``) the query is paced, never ends,
    and is returned running (T2).
    """
    w = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    if processing_time:
        return w.trigger(processingTime=processing_time).start()
    q = w.trigger(processingTime="0 seconds").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return None


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Idempotent per-batch output: the batch's own folder is replaced on replay."""
    df.write.mode("overwrite").format(fmt).save(f"{path}/batch={batch_id}")


def answer_table(responses: DataFrame) -> DataFrame:
    """The last answer of each code, parsed once and stored for all micro-batches of a run."""
    answers = lookup_table(responses).withColumnRenamed("cep", "resp_cep")
    path = scratch_dir(responses.sparkSession, "answers")
    last_answer(answers, "code").write.parquet(path)
    return responses.sparkSession.read.parquet(path)


def enrich_handler(spark: SparkSession, answers: DataFrame, table: AddressTable, now: str, stream: str = "",
                   handler: Handler | None = None, limit: int | None = None, handled_before: int = 0) -> Handler:
    """The per-micro-batch work of the consumer. ``answers``: see `answer_table`.

    ``stream`` names the stream in the table's commits; ``handler`` is called with the usable messages
    of each batch before they are acknowledged (what raises there leaves the batch to be replayed). With a
    ``limit`` the batch in which the usable messages handled since ``handled_before`` reach it is cut after that message;
    the commit records the cut, and `LimitReached` leaves the rest of the batch to the next run.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        done = table.progress(stream)
        if done.covers(batch_id):
            return
        if batch_id == done.batch:          # the rest of a batch that a limit cut
            batch = batch.where(F.col("seq") > done.upto)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        kept = drop_bad_messages(batch).persist(StorageLevel.MEMORY_AND_DISK)
        looked = None
        try:
            usable, cut, last = kept.count(), None, False
            if limit:
                left = limit - (done.handled - handled_before)
                if left <= 0:
                    raise LimitReached(f"{limit} messages handled")
                if usable > left:
                    cut = process_limit(kept, left).agg(F.max("seq")).first()[0]
                    usable = left
                last = usable == left
            taken = batch.where(F.col("seq") <= cut) if cut is not None else batch
            work = kept.where(F.col("seq") <= cut) if cut is not None else kept
            if handler is not None:
                handler(work, batch_id)
            codes = work.select("cep").dropDuplicates(["cep"])
            looked = (codes.join(broadcast_if_small(answers), F.col("cep") == F.col("code"), "left")
                      .withColumn("status", F.coalesce("status", F.lit(ABSENT))).persist(StorageLevel.MEMORY_AND_DISK))
            found = looked.where(F.col("status") == OK).select(
                *address_columns(F.struct(F.col("resp_cep").alias("cep"), *[F.col(f) for f in ADDRESS_FIELDS[1:]])))
            stamp = iso_timestamp(F.lit(now).cast("timestamp_ntz"))
            errors = failure_rows(looked.where(F.col("status") != OK)).withColumn("timestamp", stamp).select(*ERROR_LOG_FIELDS)
            attached = {ERRORS: table.attach(errors), DEAD: table.attach(dead_letters(taken))}
            table.upsert(found, now, batch_id, stream, Progress(batch_id, cut, done.handled + usable), attached)
            if last:
                raise LimitReached(f"{limit} messages handled")
        finally:
            for df in (looked, kept, batch):
                if df is not None:
                    df.unpersist()

    return handle


def stream_enrich(spark: SparkSession, messages: DataFrame, responses: DataFrame, table_root: str, checkpoint: str, now: str,
                  handler: Handler | None = None, limit: int | None = None, answers: DataFrame | None = None) -> AddressTable:
    """Consume -> look up -> store, until the arrived messages are drained or ``limit`` usable ones are handled.

    ``answers``: the `answer_table` of ``responses`` where there is one, so that the runs of a job parse the bodies once. Dropped and dead-lettered messages do not count (L4). A run that its limit ended leaves the rest of the messages
    unacknowledged; the next run on the same checkpoint goes on with the very next message.
    """
    table = AddressTable(spark, table_root)
    before = table.progress(checkpoint).handled
    answers = answer_table(responses) if answers is None else answers
    work = enrich_handler(spark, answers, table, now, checkpoint, handler, limit, before)
    try:
        run_available(messages, work, checkpoint)
    except StreamingQueryException as error:
        if not limit or LimitReached.__name__ not in str(error) or table.progress(checkpoint).handled - before != limit:
            raise
    return table


def error_rows(table: AddressTable) -> DataFrame:
    """The error rows of all committed batches."""
    return table.attached(ERRORS, ERROR_ROWS)


def dead_rows(table: AddressTable, messages: DataFrame) -> DataFrame:
    """T5: the dead letters of all committed batches, with the columns of ``messages`` and the reason."""
    from pyspark.sql.types import StringType, StructField, StructType
    return table.attached(DEAD, StructType([*messages.schema.fields, StructField("reason", StringType())]))


def intake_cap(rate_per_second: float, interval_seconds: float) -> int:
    """Messages a consumer may take per trigger: rate times interval, at least one."""
    return max(1, int(rate_per_second * interval_seconds))


@contextmanager
def plain_logs(spark: SparkSession) -> Iterator[None]:
    """Streams run here keep their logs as single files where the checkpoint is a local folder.

    Without its native library Hadoop starts a process to set the rights of each local file and again for its checksum: a
    trigger's two logs cost more than its rows. They are still written aside and renamed.
    """
    key, plain = PLAIN_LOGS
    before = spark.conf.get(key, None)
    spark.conf.set(key, plain)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def batch_sizes(spark: SparkSession, stream: DataFrame, out_path: str, checkpoint: str) -> DataFrame:
    """Rows admitted per micro-batch and their least and greatest sequence (one row per batch id).

    A trigger reads its rows in one stage, which counts them on the way, and stores the sizes as one small file; a replay
    replaces it.
    """
    store, place = _store(out_path)
    store.create_dir(place)

    def handle(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        batch.select("seq").observe(seen, F.count(F.lit(1)).alias("rows"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq")) \
            .write.format("noop").mode("overwrite").save()
        if seen.get["rows"]:
            with store.open_output_stream(f"{place}/{batch_id}.json") as file:
                file.write(json.dumps({"batch_id": batch_id, **seen.get}).encode())

    with plain_logs(spark):
        run_available(stream, handle, checkpoint)
    return spark.read.schema("batch_id long, rows long, first_seq long, last_seq long").json(out_path)
