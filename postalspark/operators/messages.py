"""Queue-message operators in batch form: intake, limits, streaks, pacing, counts.

Consumer state (failure streaks, pause multiplier, start times) is a function
of the ordered messages of one consumer, so it is computed as an ordered fold
over ranges (``operators.pacing``) rather than a per-consumer window: a
consumer that owns a third of all messages is still split over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalspark.functions.responses import is_json, is_json_object
from postalspark.operators.pacing import paced
from postalspark.schemas import MAX_CONSECUTIVE_ERRORS, RATE_LIMIT_PER_SECOND

# JSON values of ``cep`` that count as "no code".
_EMPTY_CODE = ["", "0", "false", "[]", "{}"]


def message_code(body) -> F.Column:
    b = F.col(body) if isinstance(body, str) else body
    return F.get_json_object(b, "$.cep")


def drop_bad_messages(messages: DataFrame, body: str = "body") -> DataFrame:
    """F8: messages with a code; malformed ones and ones without a code are left out."""
    cep = message_code(body)
    keep = [c for c in messages.columns if c != body]
    ok = is_json_object(body) & cep.isNotNull() & ~cep.isin(*_EMPTY_CODE)
    return messages.where(ok).select(*keep, cep.alias("cep"))


def dead_letters(messages: DataFrame, body: str = "body") -> DataFrame:
    """T5/F8 second branch: messages that are not JSON objects, with the reason."""
    b = F.col(body)
    reason = F.when(~is_json(b), F.lit("malformed")).otherwise(F.lit("not_an_object"))
    return messages.where(~is_json_object(b)).withColumn("reason", reason)


def dropped_messages(messages: DataFrame, body: str = "body") -> DataFrame:
    """Messages acknowledged without work: JSON objects without a usable code."""
    cep = message_code(body)
    no_code = cep.isNull() | cep.isin(*_EMPTY_CODE)
    return messages.where(is_json_object(body) & no_code)


def process_limit(kept: DataFrame, limit: int | None, seq: str = "seq") -> DataFrame:
    """L4: the first ``limit`` usable messages by sequence (0 or None = all)."""
    return kept.orderBy(seq).limit(int(limit)) if limit else kept


def failure_streaks(kept: DataFrame, seq: str = "seq", consumer: str = "consumer", ok: str = "ok") -> DataFrame:
    """Failures in a row since the last success, per consumer, reset after 3.

    Adds ``k`` (failures in the current run, 0 on success), ``streak`` (the counter
    after this message: 1, 2, 3, 1, ...) and ``paused`` (this failure completed a
    run of three).
    """
    return _streaks(paced(kept, base_delay(), seq, consumer, ok), ok).drop("pause", "start")


def _streaks(rows: DataFrame, ok: str) -> DataFrame:
    n = MAX_CONSECUTIVE_ERRORS
    streak = F.when(F.col("k") == 0, F.lit(0)).otherwise(((F.col("k") - 1) % n) + 1)
    return rows.withColumn("streak", streak.cast("int")).withColumn("paused", (F.col("k") > 0) & (F.col("k") % n == 0))


def base_delay(rate_per_second: float = RATE_LIMIT_PER_SECOND) -> float:
    """Delay between lookups: ``1/rate``, never below one second."""
    return max(1.0 / rate_per_second, 1.0) if rate_per_second > 0 else 1.0


def pacing_schedule(kept: DataFrame, rate_per_second: float = RATE_LIMIT_PER_SECOND,
                    seq: str = "seq", consumer: str = "consumer", ok: str = "ok") -> DataFrame:
    """Pause after each message and each message's earliest start (s from the first).

    success -> d; failure -> max(1.5, m)*d where m = min(2^floor(k/3), 10) is the
    pause multiplier that lasts until the next success (it is applied to the rate
    gate before the next request, so a plain failure waits the larger of the two).
    A message without an outcome counts as failed.
    """
    return _streaks(paced(kept, base_delay(rate_per_second), seq, consumer, ok), ok)


def publish_messages(valid: DataFrame) -> DataFrame:
    """One JSON message per valid code, ``{"cep": "NNNNNNNN"}``."""
    keep = [c for c in valid.columns if c != "cep"]
    return valid.select(*keep, "cep", F.concat(F.lit('{"cep": "'), F.col("cep"), F.lit('"}')).alias("value"))


def backlog(published: DataFrame, handled: DataFrame, seq: str = "seq") -> DataFrame:
    """Messages published and not handled yet (left anti join), counted."""
    return published.join(handled.select(seq), seq, "left_anti").agg(F.count(F.lit(1)).alias("backlog"))


def consumed_until(messages: DataFrame, kept: DataFrame, limit: int | None, seq: str = "seq") -> DataFrame:
    """Messages a consumer took off the queue when it stopped after ``limit`` processed ones.

    Dropped and dead-lettered messages before the stop point were taken too.
    """
    if not limit:
        return messages.select(seq)
    stop = process_limit(kept, limit, seq).agg(F.max(seq).alias("_stop"))
    return messages.select(seq).join(F.broadcast(stop), F.col(seq) <= F.col("_stop")).select(seq)


def batch_stats(results: DataFrame) -> DataFrame:
    """A5: per batch processed / errors / total, plus the job total (batch NULL) via rollup."""
    return (results.rollup("batch").agg(F.count_if(F.col("found")).alias("processed"),
                                        F.count_if(~F.col("found")).alias("errors"),
                                        F.count(F.lit(1)).alias("total")))


def run_summary(results: DataFrame) -> DataFrame:
    """Handler result: status 200, message, processed and error counts."""
    return results.agg(F.lit(200).alias("status_code"), F.lit("Processing completed").alias("message"),
                       F.count_if(F.col("found")).alias("processed"),
                       F.count_if(~F.col("found")).alias("errors"))


def workflow_summary(results: DataFrame) -> DataFrame:
    """Attempted, succeeded, failed and codes stored, from per-message results."""
    return results.agg(F.count(F.lit(1)).alias("attempted"),
                       F.count_if(F.col("found")).alias("succeeded"),
                       F.count_if(~F.col("found")).alias("failed"),
                       F.count_distinct(F.when(F.col("found"), F.col("cep"))).alias("total_stored"))


def publish_reconcile(valid: DataFrame, published: DataFrame) -> DataFrame:
    """Valid codes vs messages on the queue (one row); the step succeeds only when they are equal.

    ``published`` is what the queue holds after the write, not the frame that was written.
    """
    one = F.lit(1).alias("_k")
    counts = valid.agg(F.count(F.lit(1)).alias("valid"), one).join(published.agg(F.count("value").alias("published"), one), "_k").drop("_k")
    return (counts.withColumn("complete", F.col("valid") == F.col("published"))
            .withColumn("missing", F.col("valid") - F.col("published")))


def code_results(results: DataFrame) -> DataFrame:
    """One row per handled code: whether it was found, and the error text if not."""
    return results.select("cep", F.col("found").alias("success"),
                          F.when(~F.col("found"), F.lit("CEP not found")).alias("error"))
