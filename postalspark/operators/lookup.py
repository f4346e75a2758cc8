"""Lookups as joins: enrich codes, store found ones, log the rest, resolve retries.

The lookup service is modelled by its answers: a table of (code, body). A code
with no row is answered "404" by the service. Every lookup is one equi-join on
the code; the optimizer (with AQE's runtime sizes) picks broadcast or
sort-merge, so the directory is broadcast only when it is measured small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalspark.functions.errors import classify_error, error_context, is_connection_error, retry_backoff
from postalspark.functions.responses import MALFORMED, NOT_FOUND, NOT_OBJECT, OK, address_columns
from postalspark.operators.joins import broadcast_if_small
from postalspark.schemas import (ADDRESS_FIELDS, DEFAULT_SERVICE_URL, MSG_HTTP_404, MSG_MALFORMED, MSG_NOT_FOUND,
                                 MSG_NOT_OBJECT, RETRY_ATTEMPTS)
from postalspark.session import scratch_dir
from postalspark.sources.responses import parse_responses

ABSENT = "absent"


def _message(template: str, cep, **fixed) -> F.Column:
    """A fixed message text with the code put in place of ``{cep}``."""
    head, tail = template.format(cep="\0", **fixed).split("\0")
    return F.concat(F.lit(head), cep, F.lit(tail))


def lookup_table(responses: DataFrame) -> DataFrame:
    """Parsed answers keyed by ``code``: status plus the response fields, and ``seq`` (0 where there is none).

    A code may have several answers; the users of this table keep the last by ``seq``, and among
    equals the greatest by (status, fields), so results never depend on row order. A table that has been parsed
    already is taken as it is (see `parsed_answers`).
    """
    if "status" in responses.columns and "body" not in responses.columns:
        return responses
    parsed = parse_responses(responses.select("code", "body", *(["seq"] if "seq" in responses.columns else [])))
    return parsed if "seq" in responses.columns else parsed.withColumn("seq", F.lit(0).cast("long"))


def parsed_answers(responses: DataFrame) -> DataFrame:
    """`lookup_table`, stored: for jobs that look up more than once, which would read and parse every body each time."""
    path = scratch_dir(responses.sparkSession, "parsed")
    lookup_table(responses).write.parquet(path)
    return responses.sparkSession.read.parquet(path)


def last_answer(rows: DataFrame, key: str) -> DataFrame:
    """One row per ``key``: the greatest by (seq, status, fields); partial aggregation, so hot keys are safe."""
    order = ["seq"] + [c for c in rows.columns if c not in (key, "seq")]
    picked = rows.groupBy(key).agg(F.max(F.struct(*order)).alias("_r"))
    return picked.select(key, *[F.col(f"_r.{c}").alias(c) for c in order if c != "seq"])


def enrich_codes(codes: DataFrame, responses: DataFrame, distinct: bool = True) -> DataFrame:
    """Each code with its address, or ``found = false`` and the reason in ``status``.

    With ``distinct`` (many-code lookup returns a map) each code appears once.
    """
    c = codes.select("cep").where(F.col("cep").isNotNull())
    if distinct:
        c = c.dropDuplicates(["cep"])
    answers = lookup_table(responses).withColumnRenamed("cep", "resp_cep")
    if not distinct:
        answers = last_answer(answers, "code")
    j = c.join(broadcast_if_small(answers), c["cep"] == answers["code"], "left")
    status = F.coalesce(F.col("status"), F.lit(ABSENT))
    out = j.select("cep", F.col("seq") if distinct else F.lit(0).alias("seq"), status.alias("status"), *ADDRESS_FIELDS[1:])
    if distinct:  # rows already lie by code, so this moves none
        out = last_answer(out, "cep")
    ok = F.col("status") == OK
    return out.select("cep", ok.alias("found"), "status", *[F.when(ok, F.col(f)).alias(f) for f in ADDRESS_FIELDS[1:]])


def process_codes(codes: DataFrame, responses: DataFrame, now: str) -> DataFrame:
    """Look up, keep found answers, map each to a stored row (C14), one per code.

    ``now`` is the load time (a TIMESTAMP_NTZ literal text) for created_at/updated_at.
    """
    c = codes.select("cep").where(F.col("cep").isNotNull()).dropDuplicates(["cep"])
    answers = lookup_table(responses).where(F.col("status") == OK)
    found = answers.join(c.withColumnRenamed("cep", "code"), "code", "left_semi")
    stored = found.select("seq", *address_columns(F.struct(*[F.col(f) for f in ADDRESS_FIELDS])))
    ts = F.lit(now).cast("timestamp_ntz")
    return last_answer(stored, "cep").withColumn("created_at", ts).withColumn("updated_at", ts)


def failure_rows(failed: DataFrame, service_url: str = DEFAULT_SERVICE_URL, attempts: int = RETRY_ATTEMPTS) -> DataFrame:
    """Error rows of lookups that gave no address (``cep``, ``status``).

    not found (``erro``) -> cep_not_found, status 200; not an object -> api_error;
    malformed JSON -> retried, then api_error; no answer (HTTP 404) -> retried, then
    cep_not_found with status 404.
    """
    s, cep = F.col("status"), F.col("cep")
    message = (F.when(s == NOT_FOUND, _message(MSG_NOT_FOUND, cep))
               .when(s == NOT_OBJECT, _message(MSG_NOT_OBJECT, cep))
               .when(s == MALFORMED, _message(MSG_MALFORMED, cep))
               .otherwise(_message(MSG_HTTP_404, cep, url=service_url.rstrip("/"))))
    status_code = F.when(s == NOT_FOUND, F.lit(200)).when(s == ABSENT, F.lit(404))
    retry = F.when(s.isin(MALFORMED, ABSENT), F.lit(attempts))
    return failed.select("cep", classify_error(message).alias("error_type"), message.alias("error_message"),
                         error_context(status_code=status_code, retry_attempt=retry).alias("context"))


def not_found_codes(codes: DataFrame, responses: DataFrame,
                    service_url: str = DEFAULT_SERVICE_URL, attempts: int = RETRY_ATTEMPTS) -> DataFrame:
    """One error row per distinct code whose lookup gives no address (see `failure_rows`)."""
    return failure_rows(enrich_codes(codes, responses).where(~F.col("found")), service_url, attempts)


def latest_per_code(rows: DataFrame, key: str = "code", seq: str = "seq") -> DataFrame:
    """The row with the highest ``seq`` per key (partial aggregation; hot keys are safe)."""
    others = [c for c in rows.columns if c != key]
    picked = rows.groupBy(key).agg(F.max_by(F.struct(*others), F.col(seq)).alias("_r"))
    return picked.select(key, *[F.col(f"_r.{c}").alias(c) for c in others])


def attempt_outcome(message) -> F.Column:
    """Outcome of one lookup attempt from its logged text (NULL text = success)."""
    m = F.col(message) if isinstance(message, str) else message
    low = F.lower(m)
    return (F.when(m.isNull(), F.lit("success"))
            .when(low.contains("timeout"), F.lit("timeout"))
            .when(m.startswith("CEP ") & low.contains("not found"), F.lit("not_found"))
            .when(m.startswith("Invalid response format"), F.lit("not_object"))
            .when(is_connection_error(m), F.lit("connection_error"))
            .otherwise(F.lit("http_error")))


_TERMINAL = ["success", "not_found", "not_object"]


def resolve_attempts(attempts: DataFrame, max_attempts: int = RETRY_ATTEMPTS, delay: float = 1.0) -> DataFrame:
    """Attempt log (cep, attempt, error_message) -> one outcome per code.

    The first success or terminal answer within ``max_attempts`` wins; otherwise the
    last attempt's error stands. ``waited`` sums the retry waits (C19) before it.
    """
    a = (attempts.where(F.col("attempt") <= max_attempts)
         .withColumn("outcome", attempt_outcome("error_message")))
    terminal = F.col("outcome").isin(*_TERMINAL)
    final = (a.groupBy("cep").agg(
        F.min(F.when(terminal, F.col("attempt"))).alias("_t"),
        F.max("attempt").alias("_m"))
        .select("cep", F.coalesce("_t", "_m").alias("final_attempt")))
    j = a.join(final, "cep")
    wait = F.when((F.col("attempt") < F.col("final_attempt")) & ~terminal,
                  retry_backoff(F.col("attempt"), F.col("error_message"), delay))
    row = F.struct("outcome", "error_message")
    res = j.groupBy("cep", "final_attempt").agg(
        F.max_by(row, F.when(F.col("attempt") == F.col("final_attempt"), F.col("attempt"))).alias("_f"),
        F.coalesce(F.sum(wait), F.lit(0.0)).alias("waited"))
    outcome = F.when(F.col("_f.outcome").isin(*_TERMINAL), F.col("_f.outcome")).otherwise(F.lit("failed"))
    msg = F.col("_f.error_message")
    return res.select("cep", F.col("final_attempt").alias("attempts"), outcome.alias("outcome"),
                      msg.alias("error_message"),
                      F.when(msg.isNotNull(), classify_error(msg)).alias("error_type"), "waited")


def request_status(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Request rows -> 400 bad code / 404 not found / 200 with the answer body."""
    from postalspark.functions.codes import is_code_length, request_code
    from postalspark.functions.responses import response_status
    seq = F.col("seq") if "seq" in responses.columns else F.lit(0)
    answers = last_answer(responses.select("code", seq.alias("seq"), response_status("body").alias("status"), "body"), "code")
    answers = broadcast_if_small(answers)
    r = requests.withColumn("code", request_code("cep"))
    j = r.join(answers, "code", "left")
    bad = ~is_code_length(F.col("cep"))
    status_code = (F.when(bad, F.lit(400)).when(F.col("status") == OK, F.lit(200)).otherwise(F.lit(404)))
    body = (F.when(bad, F.lit('{"error": "Invalid CEP format. Must be 8 digits."}'))
            .when(F.col("status") == OK, F.col("body"))
            .otherwise(F.lit('{"error": "CEP not found"}')))
    keep = [c for c in requests.columns if c != "cep"]
    return j.select(*keep, "cep", status_code.alias("status_code"), body.alias("body"))
