"""Code (8-digit postal code) expressions: extract, clean, validate, format.

All are built-in Column expressions, so they stay inside whole-stage codegen.
Digits are restricted to ASCII ``[0-9]`` (Python's ``\\d``/``isdigit`` also
accept other Unicode digits; documented narrowing).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postalspark.schemas import PY_WHITESPACE_CLASS, REGIONAL_PREFIX

# Fixed patterns.
CODE_IN_TEXT = r"\b[0-9]{5}-?[0-9]{3}\b"
EIGHT_DIGITS = r"\A[0-9]{8}\z"
HYPHEN_FORM = r"\A[0-9]{5}-[0-9]{3}\z"
_STRIP = rf"\A{PY_WHITESPACE_CLASS}+|{PY_WHITESPACE_CLASS}+\z"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hyphenate(c) -> Column:
    """``NNNNNNNN`` -> ``NNNNN-NNN`` (input assumed to be 8 characters)."""
    c = _c(c)
    return F.concat(F.substring(c, 1, 5), F.lit("-"), F.substring(c, 6, 3))


def dehyphenate(c) -> Column:
    """C6 reverse: drop every hyphen."""
    return F.replace(_c(c), F.lit("-"), F.lit(""))


def extract_codes(text) -> Column:
    """Every ``NNNNN-NNN`` / ``NNNNNNNN`` on word boundaries, in hyphen form, repeats kept."""
    found = F.regexp_extract_all(_c(text), F.lit(CODE_IN_TEXT), 0)
    return F.transform(found, lambda m: hyphenate(F.replace(m, F.lit("-"), F.lit(""))))


def strip_py(c) -> Column:
    """Python ``str.strip()``: remove leading and trailing Unicode whitespace."""
    return F.regexp_replace(_c(c), _STRIP, "")


def clean_code(c) -> Column:
    """Strip the ends, then drop hyphens and spaces (tabs inside are kept)."""
    return F.replace(F.replace(strip_py(c), F.lit("-"), F.lit("")), F.lit(" "), F.lit(""))


def is_valid_code(c) -> Column:
    """C4: after C2 exactly eight digits; NULL or empty gives False, never NULL."""
    return F.coalesce(clean_code(c).rlike(EIGHT_DIGITS), F.lit(False))


def is_valid_regional(c, prefix: str = REGIONAL_PREFIX) -> Column:
    """Strict ``NNNNN-NNN`` and the regional leading digit(s)."""
    c = _c(c)
    return F.coalesce(c.rlike(HYPHEN_FORM) & c.startswith(prefix), F.lit(False))


def is_code_length(c) -> Column:
    """Non-empty and eight characters once hyphens and spaces are removed."""
    bare = F.replace(F.replace(_c(c), F.lit("-"), F.lit("")), F.lit(" "), F.lit(""))
    return F.coalesce((F.length(bare) == 8), F.lit(False))


def request_code(c) -> Column:
    """The request-side normalisation: hyphens and spaces removed, no strip."""
    return F.replace(F.replace(_c(c), F.lit("-"), F.lit("")), F.lit(" "), F.lit(""))
