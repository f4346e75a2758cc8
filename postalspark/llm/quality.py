"""Quality rules: thresholds whose false-rejection risk is controlled on labelled holdouts.

Features (whole texts, built-in functions only) are shares for which higher is worse: symbols, repeated lines, repeated
three-word windows, upper-case letters, exclamation marks, words with a symbol attached.

Rules. A labelled good document is held out or not by a hash of its id. In each stratum (language) the other half
proposes, for each risk level of a fixed ladder, one cutoff per feature: the feature's quantile among good
documents. The held-out half tests every level: ``k`` of its ``n`` good documents would be rejected by any rule
of the level. The exact binomial tail P(X <= k | n, MAX_RISK) is the p-value of "the risk is above
`MAX_RISK`", and a level is certified if that is at most `ERROR` divided by the number of tests (all levels of all strata,
Bonferroni). So with probability 1 - `ERROR` no stratum loses more than `MAX_RISK` of its good documents. Of the certified levels
the one that parts good from bad best (proposal half) is used; a stratum without a certified level rejects nothing.

Defined cases: a null or empty text has no words (it fails the base rule); a null stratum is a stratum of its own; a document with
several labels is good only if all say so; without labels no level is certified; repeated rows are judged each; an empty table gives
none. Feature columns start with ``__``, so other columns may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_SEPARATORS, stash

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
MAX_RISK, ERROR = 0.02, 0.05
#: share of good documents that a cutoff of the level gives up on the proposal half
LEVELS = (0.0, 0.0002, 0.0005, 0.001, 0.002, 0.005, 0.01)
SYMBOLS = "#*$%&|<>"
_W = "[\\x20\\x09-\\x0D]"


def _count(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def _windows(words: Column) -> Column:
    """Hash of every three-word window, in order."""
    n = F.size(words)
    at = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))


def _covered(hashes: Column) -> Column:
    """Words covered by windows found twice or more: windows are sorted by (hash, place); places of those equal to a
    neighbour, sorted again, cover 3 words each less what overlaps the one before."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(sorted_: Column) -> Column:
        kept = F.filter(sorted_, lambda s, k: F.coalesce((k > 0) & (F.get(sorted_, F.greatest(k - 1, F.lit(0)))["h"] == s["h"]), F.lit(False))
                        | F.coalesce(F.get(sorted_, k + 1)["h"] == s["h"], F.lit(False)))
        return F.sort_array(F.transform(kept, lambda s: s["i"]))

    # let-binding: the sorted array is built once and handed on as the one element of an array
    found = F.get(F.transform(F.array(placed), places), F.lit(0))
    total = F.aggregate(found, F.struct(F.lit(0).alias("sum"), F.lit(-3).alias("last")),
                        lambda a, p: F.struct((a["sum"] + F.least(F.lit(3), p - a["last"])).alias("sum"), p.alias("last")))
    return total["sum"]


def with_counts(docs: DataFrame, prefix: str = "__") -> DataFrame:
    """``docs`` with the counts ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, n_letters, n_bang,
    n_marked`` of every whole text (names get ``prefix``)."""
    p = prefix
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(WORD_SEPARATORS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{_W}+"))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    d = docs.withColumns({f"{p}words": words, f"{p}lines": lines,
                          f"{p}word_chars": F.length(F.translate(text, WORD_SEPARATORS, "")).cast("long"),
                          f"{p}n_symbols": _count(text, SYMBOLS).cast("long"),
                          f"{p}n_bang": _count(text, "!").cast("long"),
                          f"{p}n_upper": _count(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long"),
                          f"{p}n_marked": F.size(F.split(text, f"[{SYMBOLS}!]{_W}", -1)).cast("long") - 1})
    d = d.withColumns({f"{p}n_words": F.size(f"{p}words").cast("long"),
                       f"{p}n_dup_lines": (F.size(f"{p}lines") - F.size(F.array_distinct(f"{p}lines"))).cast("long"),
                       f"{p}hashes": _windows(F.col(f"{p}words"))})
    repeats = F.when(F.size(F.array_distinct(f"{p}hashes")) == F.size(f"{p}hashes"), F.lit(0)).otherwise(_covered(F.col(f"{p}hashes")))
    return d.withColumn(f"{p}n_repeat_words", repeats.cast("long")).drop(f"{p}words", f"{p}lines", f"{p}hashes")


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _features(p: str = "__") -> dict[str, Column]:
    c = {k: F.col(f"{p}{k}").cast("double") for k in (*COUNTS, "n_upper", "n_bang", "n_marked")}
    words, chars = F.greatest(c["n_words"], F.lit(1.0)), F.greatest(c["word_chars"], F.lit(1.0))
    return {"symbols": c["n_symbols"] / chars, "lines": c["n_dup_lines"] / words, "repeats": c["n_repeat_words"] / words,
            "upper": c["n_upper"] / chars, "bangs": c["n_bang"] / chars, "marked": c["n_marked"] / words}


FEATURES = ("symbols", "lines", "repeats", "upper", "bangs", "marked")


def base_failed(p: str = "__") -> Column:
    return (F.col(f"{p}n_words") < MIN_WORDS) | (100 * F.col(f"{p}n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{p}n_words"))


def _log_factorial(n: Column) -> Column:
    """ln n! for n >= 0: Stirling's series at n + 8, brought back by eight factors."""
    m = n + 8.0
    series = (m + 0.5) * F.log(m) - m + 0.5 * math.log(2 * math.pi) + 1 / (12 * m) - 1 / (360 * F.pow(m, F.lit(3.0))) + 1 / (1260 * F.pow(m, F.lit(5.0)))
    back = F.lit(1.0)
    for i in range(1, 9):
        back = back * (n + float(i))
    return series - F.log(back)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of a binomial(n, p): 1 above the mean, else summed downwards from k until terms vanish.

    Below the mean terms fall at least as fast as a normal's, so 12 standard deviations hold all that a double can show.
    """
    k, n = k.cast("double"), n.cast("double")
    top = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p))
    terms = F.least(k, F.ceil(12 * F.sqrt(n * p) + 40)).cast("int")
    steps = F.when(terms >= 1, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(steps, F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term")), lambda a, i: F.transform(
        F.array(a["term"] * (k - i + 1) * (1 - p) / ((n - k + i) * p)), lambda t: F.struct((a["sum"] + t).alias("sum"), t.alias("term")))[0])
    return F.when(n <= 0, F.lit(1.0)).when(k >= n * p, F.lit(1.0)).otherwise(top * total["sum"])


def select_cutoffs(features: DataFrame, labels: DataFrame, max_risk: float = MAX_RISK, error: float = ERROR,
                   levels: tuple[float, ...] = LEVELS) -> DataFrame:
    """One row per stratum with a certified level: ``stratum``, a cutoff per feature, ``level, n, k, p_value``.

    ``features``: ``doc_id, stratum, base_failed`` and `FEATURES`. All labelled rows that pass the base rules are used.
    """
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("good"))
    rows = features.where("not base_failed").join(marks, "doc_id").withColumn("held", F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1)
    rows = stash(rows.drop("base_failed"), "quality")
    asked = [F.percentile_approx(f, F.array(*[F.lit(1.0 - x) for x in levels]), F.lit(100_000)).alias(f"c_{f}") for f in FEATURES]
    proposed = rows.where("not held and good = 1").groupBy("stratum").agg(*asked)
    ladder = proposed.select("stratum", F.posexplode(F.arrays_zip(*[f"c_{f}" for f in FEATURES])).alias("rung", "c"))
    ladder = ladder.select("stratum", "rung", *[F.col(f"c.c_{f}").alias(f"c_{f}") for f in FEATURES])
    tried = rows.join(F.broadcast(ladder), "stratum")  # strata times levels: a bounded list
    rejected = F.greatest(*[(F.col(f) > F.col(f"c_{f}")) for f in FEATURES])
    counts = tried.withColumn("r", rejected.cast("int")).groupBy("stratum", "rung", *[f"c_{f}" for f in FEATURES]).agg(
        F.sum(F.when(F.col("held") & (F.col("good") == 1), 1).otherwise(0)).alias("n"),
        F.sum(F.when(F.col("held") & (F.col("good") == 1), F.col("r")).otherwise(0)).alias("k"),
        (F.avg(F.when(~F.col("held") & (F.col("good") == 0), F.col("r"))) - F.coalesce(F.avg(F.when(~F.col("held") & (F.col("good") == 1), F.col("r"))), F.lit(0.0))).alias("gain"))
    tests = ladder.agg(F.count("*").alias("tests"), F.lit(1).alias("one"))
    tested = counts.withColumns({"p_value": binomial_tail(F.col("k"), F.col("n"), max_risk), "one": F.lit(1)}).join(F.broadcast(tests), "one")
    certified = tested.where((F.col("p_value") <= error / F.col("tests")) & (F.col("gain") > 0))
    best = F.max_by(F.struct(*[f"c_{f}" for f in FEATURES], "rung", "n", "k", "p_value"), F.struct(F.round("gain", 6), -F.col("rung")))
    return certified.groupBy("stratum").agg(best.alias("b")).select("stratum", "b.*")


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", keep: tuple[str, ...] = (), **control) -> DataFrame:
    """``doc_id``, `COUNTS`, ``base_failed``, ``kept``, ``rejected``, ``stratum`` and the columns ``keep`` of every row,
    with the cutoffs selected from ``labels``."""
    d = with_counts(docs.select("doc_id", *keep, "text", F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("")).alias("stratum")))
    rows = stash(d.withColumn("base_failed", base_failed()).withColumns(_features()).select(
        "doc_id", *keep, "stratum", "base_failed", *[F.col(f"__{c}").alias(c) for c in COUNTS], *FEATURES), "features")
    cutoffs = select_cutoffs(rows.select("doc_id", "stratum", "base_failed", *FEATURES), labels, **control)
    cutoffs = stash(cutoffs.select("stratum", *[f"c_{f}" for f in FEATURES]), "cutoffs")
    judged = rows.join(F.broadcast(cutoffs), "stratum", "left")  # a row per language
    bad = F.coalesce(F.greatest(*[F.col(f) > F.col(f"c_{f}") for f in FEATURES]), F.lit(False))
    return judged.select("doc_id", *keep, *COUNTS, "base_failed", (~F.col("base_failed") & ~bad).alias("kept"), bad.alias("rejected"), "stratum")


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **control) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns; rows travel with their verdict, so nothing is joined back."""
    d = docs.select("doc_id", "text", F.col(stratum).alias("lang"), F.struct("*").alias("whole"))
    return judge(d, labels, "lang", ("whole",), **control).where("kept").select("whole.*")
