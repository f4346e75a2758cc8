"""Failure streaks and pacing carried over micro-batches, per consumer.

A micro-batch is folded as in ``operators.pacing``: its rows are range partitioned by (consumer, seq), each range folds
its own rows, and the state that comes in per consumer (failures in the current run, start of its next message) is one
more row in front of the consumer's. No group is gathered: a consumer's messages spread over as many
tasks as they fill. The batch is read from its source once and its three columns are stored, as the range partitioning reads them twice. State is a
table of one row per consumer, written per batch beside the batch's output and read by the next one,
so a replayed batch starts from the same state and replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postalspark.operators.messages import base_delay
from postalspark.operators.pacing import Pauses, carry, fold_ranges, settle
from postalspark.session import remove_path, scratch_dir
from postalspark.sinks.commits import Folder
from postalspark.streaming.enrich import Handler, run_available, write_batch

_STATE = "consumer long, k long, clock double"


def _states(spark: SparkSession, root: str) -> list[int]:
    """Batches whose state is written whole."""
    folder = Folder(spark, root)
    if not folder.fs.exists(folder.path(root)):
        return []
    names = [f.getPath().getName() for f in folder.fs.listStatus(folder.path(root))]
    ids = [int(n[6:]) for n in names if n.startswith("batch=") and n[6:].isdigit()]
    return sorted(i for i in ids if folder.fs.exists(folder.path(f"{root}/batch={i}/_SUCCESS")))


def streak_handler(spark: SparkSession, out: str, state_root: str, rate_per_second: float = 1.0) -> Handler:
    """Per micro-batch: k, pause and start of each message to ``out/batch=N``, the consumers' next state to ``state_root``."""
    pauses = Pauses(base_delay(rate_per_second))

    def handle(batch: DataFrame, batch_id: int) -> None:
        known = [i for i in _states(spark, state_root) if i < batch_id]
        before = spark.read.schema(_STATE).parquet(f"{state_root}/batch={known[-1]}") if known else spark.createDataFrame([], _STATE)
        rows, work = batch.select("seq", "consumer", "ok"), scratch_dir(spark, "streak_batch")
        try:
            rows.write.parquet(f"{work}/rows")
            rows = spark.read.schema(rows.schema).parquet(f"{work}/rows")
            folded = fold_ranges(rows, pauses, "seq", "consumer", "ok", state=before, store=f"{work}/folded")
            came, went = carry(folded, pauses, "consumer")
            write_batch(settle(folded, came, pauses, "consumer", "ok"), out, batch_id)
            write_batch(went, state_root, batch_id)      # silent consumers too: their state is a row of the fold
        finally:
            remove_path(spark, work)
        for old in known[:-1]:
            remove_path(spark, f"{state_root}/batch={old}")

    return handle


def stream_streaks(kept: DataFrame, out: str, state_root: str, checkpoint: str, rate_per_second: float = 1.0) -> DataFrame:
    """A (seq, consumer, ok) stream in sequence order -> k, pause and start per message (equals W5), until drained."""
    spark = kept.sparkSession
    run_available(kept, streak_handler(spark, out, state_root, rate_per_second), checkpoint)
    return spark.read.parquet(out).select("seq", "consumer", "ok", "k", "pause", "start")
