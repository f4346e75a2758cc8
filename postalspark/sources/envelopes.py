"""Handler event envelopes: queue batches (S9) and event routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalspark.functions.codes import is_code_length, request_code
from postalspark.functions.responses import is_json_object
from postalspark.schemas import ENVELOPE, MESSAGE


def explode_envelope(envelopes: DataFrame, col: str = "envelope") -> DataFrame:
    """``Records[].body`` JSON -> one row per code with hyphens/blanks removed.

    Records whose body has no usable code (missing, wrong length) are skipped, as
    the handler skips them; bodies that are not JSON objects carry no code either.
    """
    keep = [c for c in envelopes.columns if c != col]
    whole = F.when(is_json_object(col), F.from_json(F.col(col), ENVELOPE))
    recs = envelopes.select(*keep, F.explode(whole["Records"]).alias("r"))
    msg = F.when(is_json_object("r.body"), F.from_json(F.col("r.body"), MESSAGE))
    codes = recs.select(*keep, request_code(msg["cep"]).alias("cep"))
    return codes.where(is_code_length("cep"))


def route_events(events: DataFrame, col: str = "event") -> DataFrame:
    """Object-store upload (s3) / queue batch (sqs) / http / scheduled.

    ``Records`` of another kind match no branch (``unrouted``); an empty ``Records``
    list is ``invalid``; text that is not a JSON object is ``malformed``.
    """
    e = F.col(col)
    keys = F.when(is_json_object(e), F.json_object_keys(e))
    rec0_keys = F.json_object_keys(F.get_json_object(e, "$.Records[0]"))
    source = F.get_json_object(e, "$.Records[0].eventSource")
    route = (F.when(keys.isNull(), F.lit("malformed"))
             .when(F.array_contains(keys, "Records"),
                   F.when(rec0_keys.isNull(), F.lit("invalid"))
                   .when(F.array_contains(rec0_keys, "s3"), F.lit("s3"))
                   .when(F.array_contains(rec0_keys, "eventSource") & (source == "aws:sqs"), F.lit("sqs"))
                   .otherwise(F.lit("unrouted")))
             .when(F.array_contains(keys, "httpMethod") | F.array_contains(keys, "requestContext"),
                   F.lit("http"))
             .otherwise(F.lit("scheduled")))
    keep = [c for c in events.columns if c != col]
    return events.select(*keep, route.alias("route"))
