"""URL filters: host/path rules first, then a weighted vocabulary counted by an Aho-Corasick automaton.

Host and path are cut out with built-in functions. A rule ``(verdict, "host/path")`` fits its host and
every subdomain when the page's path starts with the rule's path; the longest fitting rule decides.
Pages without a rule are judged by the vocabulary: the automaton finds every strict and soft term in the
lower-cased, percent-decoded URL in one pass; a hit counts only between boundaries (no ASCII letter or digit on either
side). One strict term rejects; so do ``min_soft`` different soft terms whose weights reach ``soft_weight``.

Defined cases: a null URL or one without ``://`` has empty host and path, fits no rule and is judged on
its whole text (null: none, so it is allowed); repeated rows are judged alike; an empty table gives none.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed values: host/path rules of the contract
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: one hit rejects
STRICT_TERMS = ("casino", "cheap-pills", "escorts", "gambling", "hardcore", "malware", "phishing", "porn",
                "spam", "spam-farm", "viagra", "warez", "xxx")
#: several different hits reject; weight of each term
SOFT_TERMS = {"adult": 1.0, "bet": 0.5, "bonus": 0.5, "cheap": 0.5, "click": 0.5, "crack": 1.0, "dating": 1.0,
              "farm": 0.5, "free": 0.5, "loan": 1.0, "nude": 1.0, "pills": 1.0, "poker": 1.0, "promo": 0.5,
              "torrent": 1.0, "win": 0.5}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """Between ``://`` and the next ``/``, ``?`` or ``#``, ASCII lower case; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"\A[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """From the end of the host to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host_: Column, path_: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, nulls where none does."""
    rule = verdict = None
    for v, text in sorted(rules, key=lambda r: len(r[1])):
        h, _, p = text.partition("/")
        fits = ((host_ == h) | host_.endswith("." + h)) & path_.startswith("/" + p)
        rule = F.when(fits, F.lit(text)).otherwise(F.lit(None).cast("string") if rule is None else rule)
        verdict = F.when(fits, F.lit(v)).otherwise(F.lit(None).cast("string") if verdict is None else verdict)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def vocabulary_counter(strict=STRICT_TERMS, soft=SOFT_TERMS):
    """Pandas UDF: URL -> (different strict terms, different soft terms, weight of the soft terms)."""
    terms = {t: (True, 0.0) for t in strict} | {t: (False, float(w)) for t, w in soft.items() if t not in strict}

    @F.pandas_udf("n_strict int, n_soft int, soft_weight double")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick
        machine = ahocorasick.Automaton()
        for t in terms:
            machine.add_word(t, t)
        if terms:
            machine.make_automaton()

        def word(c: str) -> bool:
            return "a" <= c <= "z" or "0" <= c <= "9"

        def judge(url: str | None) -> tuple[int, int, float]:
            text = unquote(url or "").lower()
            found = set()
            for end, t in machine.iter(text) if terms and text else ():
                begin = end - len(t) + 1
                if not (begin and word(text[begin - 1])) and not (end + 1 < len(text) and word(text[end + 1])):
                    found.add(t)
            mild = [terms[t][1] for t in found if not terms[t][0]]
            return len(found) - len(mild), len(mild), float(sum(sorted(mild)))

        for urls in batches:
            yield pd.DataFrame([judge(None if u is None or u != u else u) for u in urls],
                               columns=["n_strict", "n_soft", "soft_weight"])

    return count


def filter_urls(pages: DataFrame, rules=RULES, strict=STRICT_TERMS, soft=SOFT_TERMS, min_soft: int = 2,
                soft_weight: float = 1.5) -> DataFrame:
    """Rows ``page_id, host, path, rule, verdict, n_strict, n_soft, soft_weight`` for every page."""
    d = pages.select("page_id", "url").withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    rule, fixed = fitting_rule(F.col("host"), F.col("path"), rules)
    d = d.withColumns({"rule": rule, "_fixed": fixed, "_v": vocabulary_counter(strict, soft)("url")})
    bad = (F.col("_v.n_strict") >= 1) | ((F.col("_v.n_soft") >= min_soft) & (F.col("_v.soft_weight") >= soft_weight))
    return d.select("page_id", "host", "path", "rule",
                    F.coalesce("_fixed", F.when(bad, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                    F.col("_v.n_strict").alias("n_strict"), F.col("_v.n_soft").alias("n_soft"),
                    F.col("_v.soft_weight").alias("soft_weight"))
