"""PII: base patterns on the text itself, then offset-preserving deobfuscation.

Base detectors find e-mail addresses, IPv4 addresses, card numbers and international phone numbers in the
text as written. The deobfuscator is a chain of three small transducers, each of which rewrites stretches
of text and keeps, for every character it puts out, the source stretch that it came from:

1. homoglyphs: wide, mathematical and other compatibility forms, digits of other scripts, Cyrillic and
   Greek look-alikes become ASCII;
2. spelled digits: runs of at least three number words become digits ("plus" before them ``+``), shorter runs too
   where digits, a plus or dots (also hidden ones) stand beside them;
3. disguises: ``(at)``, ``[at]``, `` at `` and ``(dot)``, `` dot `` become ``@`` and ``.``; the bare words only where
   both stand in address position (a known top domain, or a local part that looks like an address), bare "at"
   before an ordinary domain only after such a local part, and dots of any kind between four numbers, so that ordinary sentences stay as they are.

The same detectors run on what comes out, and every span found is mapped back to source offsets. A span
is added only if the transducers changed something in it and no base span of its kind overlaps it.

Offsets are code points, ends exclusive. Defined cases: a null text is empty; repeated rows are treated
alike; an empty table gives none; extra columns are ignored (`find`) or kept (`mask`).
Every text is scanned whole; all scans are linear in its length.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_OTHER = re.compile(r"[^0-9]+")


def _emails(text: str) -> list[Span]:
    """Each ``@`` with the longest run of local characters before it (not into the last match) and a dotted domain."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > floor and _LOCAL.match(text, begin - 1):
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            out.append(("email", begin, m.end()))
            floor = m.end()
        else:
            floor = at + 1
        at = text.find("@", floor)
    return out


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def detect(text: str) -> list[Span]:
    """Spans of the base patterns, kind by kind: leftmost, non-overlapping per kind, failing matches dropped."""
    out = _emails(text) if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text) if "." in text else ():
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _OTHER.sub("", m[0]) if m.end() - m.start() <= 40 else ""
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 10 <= len(_OTHER.sub("", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


#: fixed values: letters of other scripts that look like ASCII ones
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p",
    "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P",
    "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "υ": "u", "Α": "A", "Β": "B", "Ε": "E", "Η": "H",
    "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X", "Ζ": "Z",
    "․": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-",
}
_NUMBER = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
           "seven": "7", "eight": "8", "nine": "9",
           "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
           "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
           "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9"}
#: fixed values: "at" and "dot" in the four languages; an English "at" is also a common word, the others are not
_AT_NAMES, _DOT_NAMES = "arroba|arobase|klammeraffe", "dot|punto|punkt|point"
_NUMBER_WORD = "(?:" + "|".join(_NUMBER) + ")"
#: fixed values: last labels that make bare "at" and "dot" an address: generic ones and all country codes but those that are common English words
TOP_DOMAINS = frozenset("com org net edu gov mil int info biz io ai dev app co example test name pro mobi jobs travel museum aero coop asia cat tel eu uk "
                        "online site shop store tech xyz cloud blog email club agency "
                        "ac ad ae af ag al ao aq ar at au aw ax az ba bb bd be bf bg bh bi bj bm bn bo br bs bt bw bz ca cc cd cf cg ch ci ck "
                        "cl cm cn cr cu cv cw cx cy cz de dj dk dm dz ec ee eg er es et fi fj fk fm fo fr ga gb gd ge gf gg gh gi gl gm gn gp gq gr "
                        "gs gt gu gw gy hk hm hn hr ht hu id ie il im in iq ir it je jm jo jp ke kg kh ki km kn kp kr kw ky kz la lb lc li lk lr ls "
                        "lt lu lv ly ma mc md mg mh mk ml mm mn mo mp mq mr ms mt mu mv mw mx mz na nc ne nf ng ni nl no np nr nu nz om pa pe pf "
                        "pg ph pk pl pm pn pr ps pt pw py qa re ro rs ru rw sa sb sc sd se sg sh si sk sl sm sn sr ss st su sv sx sy sz tc td tf tg "
                        "th tj tk tl tm tn tr tt tv tw tz ua ug us uy uz va vc ve vg vi vn vu wf ws ye yt za zm zw".split())
_GAP = r"[ \t,.\-]{1,3}"
_SPELLED = re.compile(rf"\b(?:plus{_GAP})?(?:{_NUMBER_WORD}{_GAP}){{2,}}{_NUMBER_WORD}\b", re.I)
_WORD = re.compile(r"[a-zéü]+|[0-9+]", re.I)
_LABEL = r"[A-Za-z0-9-]+"
_AT = rf"[ \t]*[\[({{<][ \t]*(?:at|{_AT_NAMES}|@)[ \t]*[\])}}>][ \t]*"
_DOT = rf"[ \t]*[\[({{<][ \t]*(?:{_DOT_NAMES}|\.)[ \t]*[\])}}>][ \t]*"
_SAID_DOT = rf"[ \t](?:{_DOT_NAMES})[ \t]"
#: an address has at most 64 characters before the at (so 32 pieces) and 127 labels after it (RFC 5321, RFC 1035)
_DISGUISED = re.compile(
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}(?:(?:(?:{_DOT}|{_SAID_DOT})[A-Za-z0-9_%+-]{{1,64}}){{0,31}})"
    rf"(?P<at>{_AT}|@|[ \t](?:at|{_AT_NAMES})[ \t])"
    rf"{_LABEL}(?:(?:{_DOT}|{_SAID_DOT}|\.){_LABEL}){{1,126}}", re.I)
_SPOKEN_IP = re.compile(rf"(?<![0-9.])[0-9]{{1,3}}(?:(?:{_DOT}|{_SAID_DOT}|\.)[0-9]{{1,3}}){{3}}(?![0-9])", re.I)
#: parts of a phone or an address by numbers in which words and digits may be mixed
_ONE = rf"(?:{_NUMBER_WORD}\b|[0-9]+)"
_MIXED_PHONE = re.compile(rf"(?:\bplus[ \t,.\-]{{1,3}}|\+[ \t]?){_ONE}(?:[ \t,.()\-]{{1,3}}{_ONE}){{0,14}}(?![A-Za-z0-9])", re.I)
_PART = rf"{_ONE}(?:[ \t\-]{{1,3}}{_ONE}){{0,2}}"
_MIXED_IP = re.compile(rf"(?<![A-Za-z0-9.]){_PART}(?:(?:{_DOT}|{_SAID_DOT}|[ \t]?\.[ \t]?){_PART}){{3}}(?![A-Za-z0-9])", re.I)
#: a card number in words and digits mixed, piece by piece
_MIXED_CARD = re.compile(rf"(?<![A-Za-z0-9+]){_ONE}(?:[ \t\-]{{1,3}}{_ONE}){{3,18}}(?![A-Za-z0-9])", re.I)
_NAMED = re.compile(rf"\b(?:plus|{_NUMBER_WORD})\b", re.I)
_BRACKET_AT, _BRACKET_DOT = re.compile(_AT, re.I), re.compile(_DOT, re.I)
_BARE_DOT = re.compile(_SAID_DOT, re.I)


class Mapped:
    """A text with, for stretches of it, the source stretch each came from."""

    def __init__(self, text: str):
        self.text, self.steps = text, []

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace [start, end) by a text, for ascending edits; remembers how to get back."""
        if not edits:
            return
        out, at, new_at, new, old, kind = [], 0, 0, [0], [0], []
        for a, b, s in edits:
            out += [self.text[at:a], s]
            new_at += a - at
            new += [new_at, new_at + len(s)]
            old += [a, b]
            new_at += len(s)
            at = b
        out.append(self.text[at:])
        self.text = "".join(out)
        self.steps.append((new, old))

    def source(self, a: int, b: int) -> tuple[int, int, bool]:
        """Source offsets of [a, b) and whether any of it was rewritten."""
        changed = False
        for new, old in reversed(self.steps):
            # segments alternate: kept [new[2i], new[2i+1]), rewritten [new[2i+1], new[2i+2])
            i, j = bisect_right(new, a) - 1, bisect_right(new, b - 1) - 1
            changed |= i % 2 == 1 or j % 2 == 1 or j > i
            a = old[i] if i % 2 else old[i] + a - new[i]
            b = old[j + 1] if j % 2 else old[j] + b - new[j]
        return a, b, changed


def _plain(c: str) -> str:
    """ASCII form of a look-alike character, or the character itself."""
    got = LOOKALIKES.get(c)
    if got is None:
        wide = unicodedata.normalize("NFKC", c)
        digit = unicodedata.digit(c, None)
        got = str(digit) if digit is not None else wide if len(wide) == 1 and wide.isascii() and wide.isprintable() and wide != " " else c
    return got


_plain_of: dict[str, str] = {}
_BEYOND_LATIN = re.compile(r"[^\x00-ɏ]")


def _homoglyphs(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in _BEYOND_LATIN.finditer(text):
        c = m[0]
        if c not in _plain_of:
            if len(_plain_of) > 100_000:
                _plain_of.clear()
            _plain_of[c] = _plain(c)
        if _plain_of[c] != c:
            edits.append((m.start(), m.end(), _plain_of[c]))
    return edits


def _spelled(text: str) -> list[tuple[int, int, str]]:
    def digits(words: str) -> str:
        return "".join("+" if w.lower() == "plus" else _NUMBER.get(w.lower(), w) for w in _WORD.findall(words))

    edits = []

    def take(begin: int, end: int) -> None:
        i = bisect_right(edits, (begin, len(text) + 1, ""))
        if not (i and edits[i - 1][1] > begin) and not (i < len(edits) and edits[i][0] < end):
            edits.insert(i, (begin, end, digits(text[begin:end])))

    for m in _MIXED_IP.finditer(text):  # 192 dot one six eight dot zero dot one
        if _NAMED.search(m[0]):
            for part in re.finditer(_PART, m[0], re.I):
                if not part[0].isdigit():
                    take(m.start() + part.start(), m.start() + part.end())
    for m in _MIXED_PHONE.finditer(text):  # plus four nine 30 1234 5678
        if _NAMED.search(m[0]) and re.search("[0-9]", m[0]) and 10 <= len(digits(m[0])) - 1 <= 15:
            take(m.start(), m.end())
    for m in _MIXED_CARD.finditer(text):  # four one one one 1111 1111 1111 1111
        if _NAMED.search(m[0]) and re.search("[0-9]", m[0]) and 14 <= len(digits(m[0])) <= 19 and _luhn(digits(m[0])):
            take(m.start(), m.end())
    for m in _SPELLED.finditer(text):
        take(m.start(), m.end())
    return edits


def _overlaps(taken: list[tuple[int, int]], a: int, b: int) -> bool:
    """Whether [a, b) meets one of ascending stretches that don't overlap: only the last that begins before b can."""
    at = bisect_left(taken, (b, -1))
    return at > 0 and taken[at - 1][1] > a


def _looks_like_local(part: str) -> bool:
    """Whether bare words before "at" look like the local part of an address: a digit, or a dot, plus, underscore or percent sign inside."""
    return bool(re.search(r"[0-9]|[A-Za-z0-9][._+%][A-Za-z0-9]", part)) and bool(re.search("[A-Za-z]", part))


def _disguises(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in _DISGUISED.finditer(text):
        inside, begin, end = m[0], m.start(), m.end()
        bare = m["at"].strip().lower() == "at"
        hidden_dot = _BRACKET_DOT.search(inside) or _BARE_DOT.search(text, m.end("at") - 1, end)
        local, host = text[begin: m.start("at")], text[m.end("at"): end]
        if bare and not hidden_dot and not (_looks_like_local(local) and host.rsplit(".", 1)[-1].lower() in TOP_DOMAINS):
            continue  # "meet at example.com" is no address, nor is "bob42 at noon.Then"
        if (bare and hidden_dot and not _BRACKET_DOT.search(inside) and re.split(r"[ \t.]", inside)[-1].lower() not in TOP_DOMAINS
                and not _looks_like_local(local)):
            continue  # nor is "look at a dot on paper"
        found = [(x.start(), x.end(), "@") for x in [re.compile(re.escape(m["at"])).search(text, m.start("at"))]]
        for pattern in (_BRACKET_DOT, _BARE_DOT):
            found += [(x.start(), x.end(), ".") for x in pattern.finditer(text, begin, end)]
        last = begin
        for a, b, s in sorted(set(found)):
            if a >= last:
                edits.append((a, b, s))
                last = b
    taken = [(a, b) for a, b, _ in edits]  # ascending, without overlaps
    for m in _SPOKEN_IP.finditer(text):  # 192 dot 168 dot 0 dot 1
        for pattern in (_BRACKET_DOT, _BARE_DOT):
            edits += [(x.start(), x.end(), ".") for x in pattern.finditer(text, m.start(), m.end()) if not _overlaps(taken, x.start(), x.end())]
    return sorted(edits)


_NUMBER_HINT = re.compile(r"(?:" + "|".join(_NUMBER) + r")[ \t,.\-]{1,3}(?:" + "|".join(_NUMBER) + ")")


_DISGUISE_HINT = re.compile(rf"(?:{_DOT_NAMES}|{_AT_NAMES})|[\[({{<][ \t]*(?:at|@|\.)[ \t]*[\])}}>]|[ \t]at[ \t]")


def deobfuscate(text: str) -> Mapped:
    """The text after all three transducers, with the way back to the source."""
    m = Mapped(text)
    if not text.isascii():
        m.rewrite(_homoglyphs(m.text))
    low = m.text.lower()
    if len(low) != len(m.text) or _NUMBER_HINT.search(low) or _NAMED.search(low) and re.search(r"[0-9]|dot|\+|plus|\.", low):
        m.rewrite(_spelled(m.text))
        low = m.text.lower()
    if _DISGUISE_HINT.search(low):
        m.rewrite(_disguises(m.text))
    return m


_LONG_RUN = re.compile(r"(?<![0-9+])[0-9]{10,15}(?![0-9])")


def find_spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, spans that only the deobfuscated text shows), each by start, then kind."""
    text = text or ""
    base = detect(text)
    plain = deobfuscate(text)
    more: list[Span] = []
    if plain.steps:
        found = detect(plain.text)
        cards = [(a, b) for k, a, b in found if k == "card"]
        # ten to fifteen number words in a row are dialled, unless they are a card number
        found += [("phone", m.start(), m.end()) for m in _LONG_RUN.finditer(plain.text)
                  if not _overlaps(cards, m.start(), m.end())
                  and _SPELLED.fullmatch(text[slice(*plain.source(m.start(), m.end())[:2])])]
        taken: dict[str, list[tuple[int, int]]] = {k: sorted((a, b) for x, a, b in base if x == k) for k in KINDS}
        for kind, a, b in found:
            a, b, changed = plain.source(a, b)
            at = bisect_right(taken[kind], (b, -1))  # base spans of a kind don't overlap, so only the last before b can
            if changed and not (at and taken[kind][at - 1][1] > a):
                more.append((kind, a, b))
    order = {k: i for i, k in enumerate(KINDS)}
    return tuple(sorted(set(s), key=lambda x: (x[1], order[x[0]], x[2])) for s in (base, more))  # type: ignore[return-value]


SPAN = StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())])


def _spans_of(docs: DataFrame, text: str = "text"):
    @F.pandas_udf(StructType([StructField("base", ArrayType(SPAN)), StructField("added", ArrayType(SPAN))]))
    def spans(texts: pd.Series) -> pd.DataFrame:
        got = [find_spans(t) for t in texts]
        rows = [[[{"kind": k, "start": a, "end": b} for k, a, b in part] for part in pair] for pair in got]
        return pd.DataFrame({"base": [r[0] for r in rows], "added": [r[1] for r in rows]})

    return spans(F.col(text))


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, base, added``: arrays of (kind, start, end) for every row."""
    d = docs.select("doc_id", "text").withColumn("s", _spans_of(docs))
    return d.select("doc_id", F.col("s.base").alias("base"), F.col("s.added").alias("added"))


def spans_text(base: list[Span], added: list[Span]) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    both = sorted({*base, *added}, key=lambda x: (x[1], order[x[0]], x[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in both)


def mask_text(text: str | None) -> str | None:
    """The text with every span (overlapping ones as one) replaced by its first kind in brackets."""
    if text is None:
        return None
    base, added = find_spans(text)
    out, at, open_end = [], 0, -1
    for kind, a, b in sorted({*base, *added}, key=lambda x: (x[1], -x[2])):
        if a < open_end:
            open_end = max(open_end, b)
            at = open_end
            continue
        out += [text[at:a], f"[{kind.upper()}]"]
        at = open_end = b
    out.append(text[at:])
    return "".join(out)


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans in ``text`` replaced; ``n_chars``, where there is one, follows the new text."""
    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return pd.Series([mask_text(t) for t in texts], dtype=object)

    out = docs.withColumn("text", masked("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
