"""Error-log expressions: classification, context, retry waits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postalspark.schemas import CONNECTION_ERROR_PHRASES, RETRY_DELAY


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def classify_error(message) -> Column:
    """C17: timeout first, then not-found / 404, else a generic API error."""
    m = _c(message)
    low = F.lower(m)
    return (F.when(low.contains("timeout"), F.lit("api_timeout"))
            .when(low.contains("not found") | m.contains("404"), F.lit("cep_not_found"))
            .otherwise(F.lit("api_error")))


def error_context(**entries) -> Column:
    """JSON object of the given entries; NULL, empty and 0 values are left out.

    An empty context renders as ''. Keys keep the order they are given in.
    """
    kv = []
    for k, v in entries.items():
        kv += [F.lit(k), _c(v).cast("string")]
    m = F.map_filter(F.create_map(*kv), lambda k, v: v.isNotNull() & (v != "") & (v != "0"))
    return F.regexp_replace(F.to_json(m), r"^\{\}$", "")


def is_connection_error(message) -> Column:
    """C20: the text names a connection-level failure."""
    low = F.lower(_c(message))
    hit = F.lit(False)
    for p in CONNECTION_ERROR_PHRASES:
        hit = hit | low.contains(p)
    return F.coalesce(hit, F.lit(False))


def retry_backoff(attempt, message, delay: float = RETRY_DELAY) -> Column:
    """Wait (s) after failed attempt ``attempt`` before the next one.

    ``min(max(d*2^a, 1), 30)``; connection errors ``min(max(d*2^a*2, 2), 60)``.
    """
    base = F.lit(float(delay)) * F.pow(F.lit(2.0), _c(attempt).cast("double"))
    return (F.when(is_connection_error(message), F.least(F.greatest(base * 2.0, F.lit(2.0)), F.lit(60.0)))
            .otherwise(F.least(F.greatest(base, F.lit(1.0)), F.lit(30.0))))
