"""Failure runs and pacing as an ordered fold of an associative summary.

What a consumer's messages do to its state (``k``: failures in the current run, ``clock``: start of its next
message) depends on earlier messages only through the run they continue. A stretch of messages therefore folds to
four values, whatever came before:

* ``lead``: failures before its first success, ``any_ok``: whether there is a success,
* ``tail``: failures after the last success (``lead`` if there is none),
* ``after``: the clock of the stretch when it starts from a fresh state.

A failure that is the k-th of its run pauses ``pause(k)``; the pauses of a run have the closed sum ``paused(k)``. Carried
into a stretch, a state (k, clock) only shifts it: the first ``a`` failures come ``paused(k + a) - paused(k) - paused(a)``
later than from a fresh state, and everything after them by that much. So rows are range partitioned by (consumer, seq) once and stored
once; each range folds its own rows (numpy on Arrow batches, in constant memory); a consumer's last row in a range holds all four values, so one
window over a row per (consumer, range) carries the states. Only the first consumer of a range may come from an earlier one: its rows take their
shift by a join with at most a row per range. A state from before all rows is a row in front of its consumer's, so it is sorted to them and joined with nothing.
No group is ever gathered, however many messages one consumer has.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postalspark.schemas import FAILURE_PAUSE_FACTOR, MAX_BACKOFF_MULTIPLIER, MAX_CONSECUTIVE_ERRORS
from postalspark.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class Pauses:
    """Pauses of a run of failures at a base delay, as numbers and as columns."""

    delay: float
    every: int = MAX_CONSECUTIVE_ERRORS
    factor: float = FAILURE_PAUSE_FACTOR
    most: float = MAX_BACKOFF_MULTIPLIER

    def _levels(self) -> list[float]:
        """Pause at floor(k / every) = 0, 1, ... up to where the multiplier stays at its bound."""
        last = max(0, math.ceil(math.log2(self.most)))
        return [max(self.factor, min(2.0 ** g, self.most)) * self.delay for g in range(last + 1)]

    def pause(self, k: np.ndarray) -> np.ndarray:
        """Pause after the k-th failure of a run."""
        levels = np.array(self._levels())
        return levels[np.minimum(k // self.every, len(levels) - 1)]

    def pause_of(self, k: Column) -> Column:
        levels = self._levels()
        at = F.least(F.floor(k / self.every), F.lit(len(levels) - 1)).cast("int")
        return F.element_at(F.array(*map(F.lit, levels)), at + 1)

    def paused(self, k: Column) -> Column:
        """Sum of the pauses of the first ``k`` failures of a run."""
        levels, total = self._levels(), F.lit(0.0)
        for g, pause in enumerate(levels):
            # failures j = 1..k with floor(j / every) = g (the last level takes all beyond)
            n = F.greatest(k - max(0, g * self.every - 1), F.lit(0))
            if g < len(levels) - 1:
                n = F.least(n, F.lit(self.every if g else self.every - 1))
            total = total + n * pause
        return total


def _fold(pauses: Pauses, consumer: str, ok: str, stated: bool):
    """Fold rows sorted by (consumer, seq) from a fresh state per consumer and range, batch by batch.

    ``stated``: a consumer's first row may hold its state from before all rows (`_old`, `_k0`, `_t0`); its other rows in the range get that state's values.
    """

    def run(batches):
        who, k0, seen0, a0, clock0 = None, 0, False, 0, 0.0     # state after the last row so far
        came_k, came_t = 0, 0.0
        first, held = True, None
        for batch in filter(len, batches):
            n, idx = len(batch), np.arange(len(batch))
            names = batch.column(consumer)
            code = names.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            good = batch.column(ok).fill_null(False).to_numpy(zero_copy_only=False)
            old = batch.column("_old").to_numpy(zero_copy_only=False) if stated else np.zeros(n, bool)
            begins = np.r_[first or names[0].as_py() != who, code[1:] != code[:-1]]
            goes_on = not begins[0]
            # failures since the last success or since the consumer's first row here
            reset = np.where(good | old, idx, np.where(begins, idx - 1, -n - 2 ** 40))
            if goes_on and not good[0]:
                reset[0] = -1 - k0
            k = idx - np.maximum.accumulate(reset)
            start = np.maximum.accumulate(np.where(begins, idx, -1))
            last_ok = np.maximum.accumulate(np.where(good, idx, -1))
            seen = np.where(start >= 0, last_ok >= start, (last_ok >= 0) | seen0)
            # failures before the first success of the consumer in this range, strictly before the row
            before = np.where(begins, 0, np.r_[0, k[:-1]])
            if goes_on:
                before[0] = k0
            turn = seen & ~np.where(begins, False, np.r_[seen0, seen[:-1]])      # first success
            at = np.maximum.accumulate(np.where(turn, idx, -1))
            carried = np.where((at >= 0) & (at >= start), before[np.maximum(at, 0)], a0)
            a = np.where(seen, carried, before)
            wait = np.where(old, 0.0, np.where(good, pauses.delay, pauses.pause(k)))
            until = np.cumsum(wait)
            since = until - wait
            clock = since - np.where(start >= 0, since[np.maximum(start, 0)], -clock0)
            if held is not None:
                yield _closed(*held, bool(begins[0]))
            data = {name: batch.column(name) for name in batch.schema.names}
            if stated:
                came = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("_k0", "_t0")]
                came = [np.where(start >= 0, v[np.maximum(start, 0)], v0) for v, v0 in zip(came, (came_k, came_t), strict=True)]
                came_k, came_t = int(came[0][-1]), float(came[1][-1])
                data |= {"_k0": pa.array(came[0]), "_t0": pa.array(came[1])}
            data |= {"_k": pa.array(k), "_leads": pa.array(~seen), "_a": pa.array(a), "_clock": pa.array(clock), "_wait": pa.array(wait)}
            held = data, np.r_[code[1:] != code[:-1], False]
            who, k0, seen0, a0, clock0, first = names[n - 1].as_py(), int(k[-1]), bool(seen[-1]), int(a[-1]), float(clock[-1] + wait[-1]), False
        if held is not None:
            yield _closed(*held, True)

    return run


def _closed(data: dict, last: np.ndarray, ends: bool) -> pa.RecordBatch:
    """A folded batch, once it is known whether its last row is its consumer's last."""
    last[-1] = ends
    return pa.RecordBatch.from_pydict(data | {"_last": pa.array(last)})


def fold_ranges(kept: DataFrame, pauses: Pauses, seq: str, consumer: str, ok: str, ranges: int | None = None, state: DataFrame | None = None,
                store: str | None = None) -> DataFrame:
    """Rows with what their own range knows (`_k, _leads, _a, _clock, _wait, _last`) and its number `_b`; stored once.

    ``state``: (consumer, k, clock) before the first row; a row of it becomes one in front of its consumer's (`_old`). With
    ``store`` the rows are Parquet files there and, without ``ranges``, fall into as many ranges as they fill.
    """
    spark = kept.sparkSession
    ensure_checkpoint_dir(spark)
    order = [F.col(consumer), F.col(seq)]
    if state is not None:
        kept = kept.withColumns({"_old": F.lit(False), "_k0": F.lit(0).cast("long"), "_t0": F.lit(0.0)})
        kept = kept.unionByName(state.select(consumer, F.lit(True).alias("_old"), F.col("k").alias("_k0"), F.col("clock").alias("_t0")), allowMissingColumns=True)
        order.insert(1, F.col("_old").desc())
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = kept.repartitionByRange(*order) if store and not ranges else kept.repartitionByRange(n, *order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    folded = ranged.sortWithinPartitions(*order).mapInArrow(
        _fold(pauses, consumer, ok, state is not None), schema + ", _k long, _leads boolean, _a long, _clock double, _wait double, _last boolean")
    folded = folded.withColumn("_b", F.spark_partition_id())
    if not store:
        return folded.checkpoint()
    folded.write.parquet(store)
    return spark.read.schema(folded.schema).parquet(store)


def carry(folded: DataFrame, pauses: Pauses, consumer: str) -> tuple[DataFrame, DataFrame]:
    """(state before each (consumer, range) that goes on from an earlier range, state after each consumer's last range).

    The first has at most a row per range, the second one per consumer.
    """
    stated = "_k0" in folded.columns
    part = folded.where("_last").select(
        consumer, "_b", F.when(F.col("_leads"), F.col("_k")).otherwise(F.col("_a")).alias("lead"), (~F.col("_leads")).alias("any_ok"),
        F.col("_k").alias("tail"), (F.col("_clock") + F.col("_wait")).alias("after"),
        (F.col("_k0") if stated else F.lit(0).cast("long")).alias("_k0"), (F.col("_t0") if stated else F.lit(0.0)).alias("_t0"))
    order = Window.partitionBy(consumer).orderBy("_b")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    # a state from before all rows lies in the consumer's first range; k after a range: its tail where it has a success, else what came in plus its failures
    part = part.withColumns({"_k0": F.first("_k0").over(upto), "_t0": F.first("_t0").over(upto), "_turn": F.sum(F.col("any_ok").cast("long")).over(upto)})
    within = Window.partitionBy(consumer, "_turn").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    part = part.withColumn("_out", F.sum(F.when(F.col("any_ok"), F.col("tail")).otherwise(F.col("lead"))).over(within)
                           + F.when(F.col("_turn") == 0, F.col("_k0")).otherwise(F.lit(0)))
    part = part.withColumns({"k_in": F.coalesce(F.lag("_out").over(order), "_k0"), "_goes_on": F.lag("_b").over(order).isNotNull()})
    shift = pauses.paused(F.col("k_in") + F.col("lead")) - pauses.paused(F.col("k_in")) - pauses.paused(F.col("lead"))
    part = part.withColumn("_span", F.col("after") + shift)
    part = part.withColumn("clock_in", F.col("_t0") + F.coalesce(F.sum("_span").over(earlier), F.lit(0.0)))
    ends = part.groupBy(consumer).agg(F.max_by(F.struct(F.col("_out").alias("k"), (F.col("clock_in") + F.col("_span")).alias("clock")), "_b").alias("e"))
    return part.where("_goes_on").select(consumer, "_b", "k_in", "clock_in"), ends.select(consumer, "e.k", "e.clock")


def settle(folded: DataFrame, before: DataFrame, pauses: Pauses, consumer: str, ok: str) -> DataFrame:
    """Rows with `k`, `pause` and `start` from their range's fold and the state before it (at most a row per range, so it is broadcast)."""
    stated = "_k0" in folded.columns
    moved = before.select(F.col(consumer).alias("_c"), F.col("_b").alias("_r"), "k_in", "clock_in")
    rows = folded.where(~F.col("_old")) if stated else folded
    j = rows.join(F.broadcast(moved), F.col(consumer).eqNullSafe(F.col("_c")) & (F.col("_b") == F.col("_r")), "left")
    k0, a = F.coalesce("k_in", F.col("_k0") if stated else F.lit(0).cast("long")), F.col("_a")
    k = F.col("_k") + F.when(F.col("_leads"), k0).otherwise(F.lit(0))
    came = F.coalesce("clock_in", F.col("_t0") if stated else F.lit(0.0))
    start = came + F.col("_clock") + (pauses.paused(k0 + a) - pauses.paused(k0) - pauses.paused(a))
    pause = F.when(F.coalesce(F.col(ok), F.lit(False)), F.lit(pauses.delay)).otherwise(pauses.pause_of(k))
    out = j.withColumn("k", k).withColumn("pause", pause.cast("double")).withColumn("start", start)
    return out.drop("_k", "_leads", "_a", "_clock", "_wait", "_last", "_b", "_c", "_r", "k_in", "clock_in", "_old", "_k0", "_t0")


def paced(kept: DataFrame, delay: float, seq: str = "seq", consumer: str = "consumer", ok: str = "ok", ranges: int | None = None) -> DataFrame:
    """Each message's ``k`` (failures in its run, 0 on success), ``pause`` after it and earliest ``start``, per consumer."""
    pauses = Pauses(delay)
    folded = fold_ranges(kept, pauses, seq, consumer, ok, ranges)
    before, _ = carry(folded, pauses, consumer)
    return settle(folded, before, pauses, consumer, ok)
