"""Lookup responses (S4): JSON bodies to typed columns plus a status tag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalspark.functions.responses import parsed_fields, response_status
from postalspark.schemas import ADDRESS_FIELDS


def parse_responses(responses: DataFrame, body: str = "body") -> DataFrame:
    """One row per response with ``status`` and the ten response fields.

    Fields are filled only for JSON objects; malformed and non-object bodies keep
    NULL fields and their own status, so nothing is dropped here.
    """
    keep = [c for c in responses.columns if c != body]
    s = parsed_fields(body)
    return responses.select(*keep, response_status(body).alias("status"),
                            *[s[f].alias(f) for f in ADDRESS_FIELDS])
