"""Lookup-response expressions: parse, classify, check, map to a stored row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postalspark.schemas import ADDRESS_FIELDS, REQUIRED_RESPONSE_KEYS, RESPONSE

# Response status values.
OK, NOT_FOUND, NOT_OBJECT, MALFORMED = "ok", "not_found", "not_object", "malformed"
# JSON scalars that are false in a truthiness test.
_FALSY_TEXT = ["false", "", "[]", "{}"]
_ZERO_NUMBER = r"^-?0*\.?0*([eE][-+]?[0-9]+)?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_one_value(body) -> Column:
    """One complete JSON value with nothing after it.

    Spark's JSON functions stop at the end of the first value. Put between brackets the text
    must hold exactly one element, and put into an object it must end where the object does;
    no text with something after its value passes both.
    """
    body = _c(body)
    alone = F.json_array_length(F.concat(F.lit("["), body, F.lit("]"))) == 1
    member = F.json_object_keys(F.concat(F.lit('{"v":'), body, F.lit("}")))
    return F.coalesce(alone & (member == F.array(F.lit("v"))), F.lit(False))


def is_json_object(body) -> Column:
    """The text is exactly one JSON object; never NULL."""
    body = _c(body)
    return F.coalesce(F.json_object_keys(body).isNotNull() & is_one_value(body), F.lit(False))


def is_json(body) -> Column:
    """Valid JSON text of any kind (object, array or scalar)."""
    return is_one_value(body)


def erro_flag(body) -> Column:
    """Truthiness of the ``erro`` member: true, any non-empty string, a non-zero number, a non-empty list or object."""
    body = _c(body)
    raw = F.get_json_object(body, "$.erro")
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(body), "$.erro", "variant"))
    truthy = F.when(kind == "STRING", raw != "").otherwise(~raw.isin(*_FALSY_TEXT) & ~raw.rlike(_ZERO_NUMBER))
    return F.coalesce(F.when(raw.isNotNull(), truthy), F.lit(False))


def response_status(body) -> Column:
    """S4 tag: ok / not_found (``erro``) / not_object / malformed.

    The object test is evaluated once; its result selects the branch.
    """
    body = _c(body)
    obj = F.when(is_json_object(body), F.when(erro_flag(body), F.lit(NOT_FOUND)).otherwise(F.lit(OK)))
    return F.coalesce(obj, F.when(is_json(body), F.lit(NOT_OBJECT)).otherwise(F.lit(MALFORMED)))


def parsed_fields(body) -> Column:
    """The response as a typed struct; NULL unless the body is a JSON object."""
    body = _c(body)
    return F.when(is_json_object(body), F.from_json(body, RESPONSE))


def is_valid_response(body) -> Column:
    """An object, ``erro`` not truthy, and keys cep, localidade and uf present."""
    body = _c(body)
    keys = F.when(is_json_object(body), F.json_object_keys(body))
    has_keys = F.lit(True)
    for k in REQUIRED_RESPONSE_KEYS:
        has_keys = has_keys & F.array_contains(keys, k)
    return F.coalesce(keys.isNotNull() & ~erro_flag(body) & has_keys, F.lit(False))


def address_columns(struct_col) -> list[Column]:
    """C14: response struct -> the ten stored columns; code cleaned, '' -> NULL."""
    s = _c(struct_col)
    cep = F.replace(F.replace(F.coalesce(s["cep"], F.lit("")), F.lit("-"), F.lit("")), F.lit(" "), F.lit(""))
    return [cep.alias("cep")] + [F.nullif(s[f], F.lit("")).alias(f) for f in ADDRESS_FIELDS[1:]]
