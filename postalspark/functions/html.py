"""Page expressions: links and codes read out of raw HTML with built-in string functions.

No HTML parser runs per row. Comments, scripts and styles are taken out first; attribute values may be in
double quotes, single quotes or bare; end tags of rows and cells may be left out; numeric character
references and the named ones that matter here are decoded. Nested tables and a ``>`` inside an attribute
before the one that is read are out of scope.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postalspark.functions.codes import extract_codes, is_valid_regional

# An attribute value in any of its three forms.
_VALUE = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""
LINK_VALUE = r"(?is)<a(?=\s)[^>]*?\shref\s*=\s*" + _VALUE
LINK_TEXT = r"(?is)<a(?=\s)[^>]*?\shref\s*=[^>]*>(.*?)(?:</a\s*>|\z)"
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
NON_TEXT = HIDDEN + r"|<template\b.*?(?:</template\s*>|\z)|<!doctype[^>]*>"
CODE_TABLE = r"""(?is)<table\b[^>]*\sid\s*=\s*(?:"ul_list"|'ul_list'|ul_list(?=[\s>]))[^>]*>(.*?)(?:</table\s*>|\z)"""
CODE_TBODY = r"""(?is)<tbody\b[^>]*\sid\s*=\s*(?:"tbody_results"|'tbody_results'|tbody_results(?=[\s>]))[^>]*>(.*?)(?:</tbody\s*>|\z)"""
ROW_START, CELL_START = r"(?i)<tr\b[^>]*>", r"(?i)<td\b[^>]*>"
CELL_END = r"(?is)(?:</td\b|</tr\b|</tbody\b|</table\b).*"
CODE_IN_HREF = r"/cep/([0-9]{5}-[0-9]{3})/"
ANY_TAG = r"<[^>]*>"
# Named character references that are decoded; the ampersand comes last.
NAMED = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&sol;", "/"),
         ("&colon;", ":"), ("&period;", "."), ("&amp;", "&"))
_DECIMAL, _HEXADECIMAL = r"\A([0-9]{1,7})(?![0-9])", r"(?i)\Ax([0-9a-f]{1,6})(?![0-9a-f])"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _numeric_reference(piece: Column, i: Column) -> Column:
    """What follows one ``&#``: its character and the rest, or the text as it was."""
    digits, hexes = F.regexp_extract(piece, _DECIMAL, 1), F.regexp_extract(piece, _HEXADECIMAL, 1)
    hexed = F.when(digits != "", F.conv(digits, 10, 16)).when(hexes != "", hexes)
    code = F.conv(hexed, 16, 10).cast("long")
    known = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    letter = F.decode(F.unhex(F.lpad(hexed, 8, "0")), "UTF-32")
    rest = F.regexp_replace(piece, r"(?i)\A(?:[0-9]+|x[0-9a-f]+);?", "")
    return F.when(i == 0, piece).when(known, F.concat(letter, rest)).otherwise(F.concat(F.lit("&#"), piece))


def decode_entities(c) -> Column:
    """Character references to characters: decimal, hexadecimal and the names in `NAMED`."""
    text = _c(c)
    numeric = F.array_join(F.transform(F.split(text, "&#"), _numeric_reference), "")
    out = F.when(text.contains("&#"), numeric).otherwise(text)
    for name, letter in NAMED:
        out = F.replace(out, F.lit(name), F.lit(letter))
    return out


def _link_values(markup: Column) -> Column:
    """Decoded ``href`` values of ``<a>`` tags in markup without comments and scripts."""
    def value(v: Column) -> Column:
        quoted = v.startswith('"') | v.startswith("'")
        return decode_entities(F.when(quoted, F.substr(v, F.lit(2), F.length(v) - 2)).otherwise(v))

    return F.transform(F.regexp_extract_all(markup, F.lit(LINK_VALUE), 1), value)


def shown(html) -> Column:
    """Markup without comments, scripts and styles."""
    return F.regexp_replace(_c(html), HIDDEN, "")


def page_links(html) -> Column:
    """Every ``href`` of an ``<a>`` tag, in page order (array)."""
    return _link_values(shown(html))


def visible_text(html) -> Column:
    """Text of a page: script/style/template/comment blocks and tags removed, no separator."""
    no_blocks = F.regexp_replace(_c(html), NON_TEXT, "")
    return decode_entities(F.regexp_replace(no_blocks, ANY_TAG, ""))


def href_code(href) -> Column:
    """First ``/cep/NNNNN-NNN/`` of a link, or NULL."""
    m = F.regexp_extract(_c(href), CODE_IN_HREF, 1)
    return F.when(m != "", m)


def table_codes(html) -> Column:
    """Codes of the first cell of each row in ``table#ul_list > tbody#tbody_results``.

    Taken from the cell's link targets and from the link texts, then kept only if
    they pass C3. Returns an array (may hold repeats).
    """
    tbl = F.regexp_extract(shown(html), CODE_TABLE, 1)
    body = F.regexp_extract(tbl, CODE_TBODY, 1)
    rows = F.slice(F.split(body, ROW_START), 2, 1 << 30)
    cells = F.transform(rows, lambda r: F.regexp_replace(F.coalesce(F.get(F.split(r, CELL_START), F.lit(1)), F.lit("")), CELL_END, ""))
    from_href = F.transform(F.flatten(F.transform(cells, _link_values)), href_code)
    texts = F.flatten(F.transform(cells, lambda c: F.regexp_extract_all(c, F.lit(LINK_TEXT), 1)))
    from_text = F.flatten(F.transform(texts, lambda t: extract_codes(visible_text(t))))
    both = F.concat(from_href, from_text)
    return F.filter(both, lambda x: x.isNotNull() & is_valid_regional(x))


def link_codes(html) -> Column:
    """Codes in any link target ``/cep/NNNNN-NNN/`` passing C3 (array)."""
    codes = F.transform(page_links(html), href_code)
    return F.filter(codes, lambda x: x.isNotNull() & is_valid_regional(x))


def text_codes(html) -> Column:
    """Codes in the visible text passing C3 (array)."""
    return F.filter(extract_codes(visible_text(html)), lambda x: is_valid_regional(x))


def primary_codes(html) -> Column:
    """Table and link codes of a page, distinct (array)."""
    return F.array_distinct(F.concat(table_codes(html), link_codes(html)))


def page_codes(html) -> Column:
    """Table and link codes; if there are none, text codes; distinct (array)."""
    primary = primary_codes(html)
    return F.when(F.size(primary) > 0, primary).otherwise(F.array_distinct(text_codes(html)))
