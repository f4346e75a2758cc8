"""Toxicity: a weighted finite-state grammar over clauses, with weights learned from labelled rows.

A prefix automaton gives each word its class and weight (the longest learned prefix or whole word wins). Over the classes of a
clause's words run five small weighted transducers, each written down on its own and composed once into `CLAUSE`:

* `INSULT_MACHINE` and `THREAT_MACHINE` pass the words of their classes on (learned entries, a class of their own, with the insults);
  their weights add up, since a word is one or the other;
* `TARGET_MACHINE` counts down the words since a target: an insult near one weighs more, a threat without one nothing;
* `NEGATION_MACHINE` counts down the words since a negation, `REPORT_MACHINE` remembers reported speech; both make matches lighter.
  The weights of these three multiply.

A target may also follow its insult. `AHEAD` reads the clause from its end and marks the words that a target follows soon; with that mark
as part of each symbol the composed machine reads the clause from its start (the two together are a bimachine), so a clause takes
two steps a word.

A document's features are its strongest clause, the sum over clauses (on a log scale) and the share of
clauses matched; a logistic function, fitted on other labelled rows than the word weights, turns
them into a score from 0 to 1.

Learning. Word and prefix counts come from a Spark aggregation over the labelled rows given (at most
``max_labelled`` of them, lowest hash of the id first: a documented bound). An entry enters the automaton when its
log-likelihood ratio against the base rate passes ``LEAST_G2``, so chance words of a large vocabulary stay out.
Seeds (plain English) are there whatever the labels. Labels, language, source and id are no inputs of a score.

Defined cases: null or empty text has no clause and gets the score of no match; a document with several
labels counts as toxic if any says so; without any labelled row the seeds and a fixed calibration are used; repeated rows are scored
each; an empty table gives none; extra columns are ignored. Whole texts are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.3
MAX_LABELLED = 20_000
LEAST_G2 = 18.0
MAX_ENTRIES = 20_000
PREFIX_LETTERS = (4, 5, 6, 7, 8)

#: seeds of each class; the grammar's closed-class words
INSULTS = ("idiot", "idiots", "moron", "morons", "stupid", "trash", "scum", "loser", "losers", "pathetic", "worthless",
           "disgusting", "clown", "clowns", "imbecile", "dumb", "filth", "vermin", "garbage", "bastard")
THREATS = ("kill", "hurt", "destroy", "burn", "beat", "crush", "murder", "stab", "shoot", "hang", "die")
TARGETS = ("you", "your", "yours", "yourself", "he", "she", "they", "them", "him", "her", "his", "their", "people", "everyone",
           "du", "dich", "dein", "ihr", "euch", "tu", "te", "toi", "vous", "ton", "ta", "tú", "ti", "usted", "ustedes")
NEGATIONS = ("not", "no", "never", "isn't", "aren't", "wasn't", "don't", "nobody", "nicht", "kein", "keine", "nie", "pas", "jamais", "nunca")
REPORTS = ("said", "says", "reported", "quoted", "quote", "wrote", "claimed", "allegedly", "called", "sagte", "dit", "dijo")
#: how far a negation, a target and a report reach, in words, and what they do to a match's weight
NEGATION_REACH, TARGET_REACH = 3, 4
NEGATED, REPORTED, AIMED = 0.25, 0.5, 1.5
SEED_WEIGHT, THREAT_WEIGHT = 3.0, 4.0

_WORDS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;\n]")
#: classes of words; a symbol is twice the class, plus one where a target follows soon
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, LEARNED = range(7)
_CLASSES = range(7)


class Transducer:
    """A weighted finite-state transducer: ``arcs[state][symbol]`` is (next state, weight), state 0 is the start."""

    def __init__(self, start, step: Callable):
        """All states that ``step(state, class, ahead) -> (state, weight)`` leads to from ``start``, numbered."""
        number, self.arcs, names = {start: 0}, [], [start]
        for name in names:  # grows as states are found
            row = []
            for c in _CLASSES:
                for ahead in (False, True):
                    to, weight = step(name, c, ahead)
                    if to not in number:
                        number[to] = len(names)
                        names.append(to)
                    row.append((number[to], weight))
            self.arcs.append(tuple(row))

    def with_other(self, other: Transducer, weigh: Callable[[float, float], float]) -> Transducer:
        """Both machines side by side on the same words; ``weigh`` joins their weights."""
        def step(state: tuple[int, int], c: int, ahead: bool):
            (p, x), (q, y) = self.arcs[state[0]][2 * c + ahead], other.arcs[state[1]][2 * c + ahead]
            return (p, q), weigh(x, y)

        return Transducer((0, 0), step)

    def __add__(self, other: Transducer) -> Transducer:
        return self.with_other(other, lambda x, y: x + y)

    def __mul__(self, other: Transducer) -> Transducer:
        return self.with_other(other, lambda x, y: x * y)

    def idle(self, state: int, n: int) -> int:
        """The state after ``n`` words of no class; it settles within the longest reach."""
        for _ in range(min(n, max(TARGET_REACH, NEGATION_REACH))):
            state = self.arcs[state][2 * OTHER][0]
        return state


def _down(left: int, seen: bool, reach: int) -> int:
    return reach if seen else max(0, left - 1)


def _aimed(c: int, aimed: bool) -> float:
    if c == THREAT:
        return float(aimed)
    return AIMED if aimed and c in (INSULT, LEARNED) else 1.0


INSULT_MACHINE = Transducer(0, lambda s, c, ahead: (0, float(c in (INSULT, LEARNED))))
THREAT_MACHINE = Transducer(0, lambda s, c, ahead: (0, float(c == THREAT)))
TARGET_MACHINE = Transducer(0, lambda s, c, ahead: (_down(s, c == TARGET, TARGET_REACH), _aimed(c, s > 0 or ahead)))
NEGATION_MACHINE = Transducer(0, lambda s, c, ahead: (_down(s, c == NEGATION, NEGATION_REACH), NEGATED if s else 1.0))
REPORT_MACHINE = Transducer(0, lambda s, c, ahead: (int(s or c == REPORT), REPORTED if s else 1.0))
CLAUSE = (INSULT_MACHINE + THREAT_MACHINE) * TARGET_MACHINE * NEGATION_MACHINE * REPORT_MACHINE
AHEAD = Transducer(0, lambda s, c, ahead: (_down(s, c == TARGET, TARGET_REACH), float(s > 0)))


@dataclass
class Grammar:
    """The learned automaton (prefix or word -> weight) and the calibration of document features."""
    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[str, float] = field(default_factory=dict)
    calibration: tuple[float, ...] = (-3.0, 0.9, 0.6, 0.0)


class Reader:
    """Runs the transducers of a grammar over texts (one per worker; remembers the classes of words)."""

    def __init__(self, grammar: Grammar):
        self.grammar = grammar
        self.closed = ({w: (INSULT, SEED_WEIGHT) for w in INSULTS} | {w: (THREAT, THREAT_WEIGHT) for w in THREATS}
                       | {w: (TARGET, 0.0) for w in TARGETS} | {w: (NEGATION, 0.0) for w in NEGATIONS} | {w: (REPORT, 0.0) for w in REPORTS})
        self.closed |= {w: (INSULT, max(x, SEED_WEIGHT)) if w in self.closed else (LEARNED, x) for w, x in grammar.words.items()
                        if w not in self.closed or self.closed[w][0] == INSULT}
        self.seen: dict[str, tuple[int, float] | None] = {}

    def tag(self, word: str) -> tuple[int, float] | None:
        got = self.closed.get(word)
        if got is None:
            for n in sorted(PREFIX_LETTERS, reverse=True):
                w = self.grammar.prefixes.get(word[:n]) if len(word) >= n else None
                if w is not None:
                    return LEARNED, w
        return got

    def clauses(self, text: str | None) -> tuple[int, list[float]]:
        """(number of clauses, weights of the matched ones)."""
        seen, out, n, at, tags = self.seen, [], 0, 0, []
        if len(seen) > 500_000:
            seen.clear()
        for w in _WORDS.findall((text or "").lower()):
            if w in ".!?;\n":
                if at:
                    n += 1
                    if tags:
                        out.append(self.match(tags))
                at, tags = 0, []
                continue
            try:
                t = seen[w]
            except KeyError:
                t = seen[w] = self.tag(w)
            if t is not None:
                tags.append((at, *t))
            at += 1
        if at:
            n += 1
            if tags:
                out.append(self.match(tags))
        return n, [x for x in out if x > 0]

    @staticmethod
    def match(tags: list[tuple[int, int, float]]) -> float:
        """Weight of a clause's matches. ``tags``: (position, class, weight) of its tagged words, in order."""
        ahead, state, then = [0] * len(tags), 0, tags[-1][0] + 1
        for k in range(len(tags) - 1, -1, -1):
            p, c, _ = tags[k]
            state, mark = AHEAD.arcs[AHEAD.idle(state, then - p - 1)][2 * c]
            ahead[k], then = int(mark), p
        total, state, then = 0.0, 0, -1
        for (p, c, w), soon in zip(tags, ahead, strict=True):
            state, weight = CLAUSE.arcs[CLAUSE.idle(state, p - then - 1)][2 * c + soon]
            total, then = total + w * weight, p
        return total

    def features(self, text: str | None) -> tuple[float, float, float]:
        n, found = self.clauses(text)
        return (max(found), math.log1p(sum(found)), len(found) / n) if found else (0.0, 0.0, 0.0)

    def score(self, text: str | None) -> float:
        a, *b = self.grammar.calibration
        z = a + sum(x * y for x, y in zip(b, self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def labelled(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, text, toxic`` of at most ``max_labelled`` labelled rows, lowest hash of the id first."""
    marks = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(marks), "doc_id")


def learn(sample: DataFrame, fold) -> Grammar:
    """A grammar from ``labelled`` rows: word weights where ``fold`` (0 to 2, a column) is below 2, calibration where it is 2."""
    from .common import stash

    rows = stash(sample.withColumn("fold", fold), "toxicity")
    base = rows.where("fold < 2").agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    n, toxic = base["n"], base["t"] or 0
    grammar = Grammar()
    if not toxic or toxic == n:
        return grammar
    words = F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}']+"))
    each = rows.where("fold < 2").select("toxic", F.explode(words).alias("w")).where("w <> ''")
    counts = each.groupBy("w").agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).where("t >= 3")
    stems = rows.where("fold < 2").select("toxic", F.explode(F.array_distinct(F.flatten(F.transform(
        F.filter(words, lambda w: F.length(w) >= min(PREFIX_LETTERS)),
        lambda w: F.array(*[F.substring(w, 1, k) for k in PREFIX_LETTERS]))))).alias("w"))
    prefixes = stems.groupBy("w").agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).where("t >= 3")

    def chosen(c: DataFrame) -> dict[str, float]:
        rate = toxic / n
        t, m = F.col("t"), F.col("n")
        safe = F.greatest(m - t, F.lit(0))
        g2 = 2 * (t * F.log(t / (m * rate)) + F.when(safe > 0, safe * F.log(safe / (m * (1 - rate)))).otherwise(0.0))
        weight = F.log((t + 0.5) / (safe + 0.5)) - math.log(rate / (1 - rate))
        picked = c.where((t / m > rate) & (g2 >= LEAST_G2)).select("w", weight.alias("x")).where(f"x >= {math.log(6)}")
        return {r["w"]: float(r["x"]) for r in picked.orderBy(F.desc("x"), "w").limit(MAX_ENTRIES).collect()}

    grammar.words = chosen(counts)
    grammar.prefixes = chosen(prefixes)
    got = features(rows.where("fold = 2"), grammar).select("toxic", "f.*").toPandas()  # at most max_labelled small rows
    if 0 < got["toxic"].sum() < len(got):
        grammar.calibration = _logistic(got[["strongest", "sum", "share"]].to_numpy(float), got["toxic"].to_numpy(float))
    return grammar


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps; the intercept is not shrunk. Slopes are held at zero or above."""
    x = np.column_stack([np.ones(len(x)), x])
    b, shrink = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    shrink[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + shrink, x.T @ (y - p) - shrink @ b)
        b = b + step
        if np.abs(step).max() < 1e-8:
            break
    return (float(b[0]), *(max(0.0, float(v)) for v in b[1:]))


def features(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """``docs`` with ``f``: strongest clause, log sum over clauses, share of matched clauses."""
    @F.pandas_udf("strongest double, sum double, share double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader(grammar)
        for texts in batches:
            yield pd.DataFrame([reader.features(t) for t in texts], columns=["strongest", "sum", "share"])

    return docs.withColumn("f", run("text"))


def score(docs: DataFrame, grammar: Grammar, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` for every row."""
    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(grammar)
        for texts in batches:
            yield pd.Series([reader.score(t) for t in texts], dtype=float)

    d = docs.select("doc_id", "text").withColumn("score", run("text"))
    return d.select("doc_id", "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
