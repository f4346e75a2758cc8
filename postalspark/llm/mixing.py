"""Mixing to target weights: soft domain membership, then document rates by projected-gradient least squares.

Domains are the classes of the labelled table (clean, junk, toxic). Tokens are counted as words.

Classifier. At most `MAX_LABELLED` labelled rows (lowest hash of the id first; a documented bound) are split in three by another hash.
The first part chooses each scarcer domain's words (a likelihood-ratio test); the second gives every chosen word its log-likelihood ratio to
"clean"; the third fits a multinomial logistic model (Newton steps over Spark sums, with a ridge) of the word scores and of the shares of symbols, capitals
and repeated words. So the words, their weights and the calibration come from different rows, and posteriors vary from document to document.

Rates. With tokens c_i, posteriors p_id and rates r_i >= 0, domain d's expected share is S_d = sum_i c_i r_i p_id / sum_i c_i. Rates start at
r0_i = sum_d p_id t_d / s_d (target over present share, as the posterior weighs them) and take accelerated projected-gradient steps for the
least squares sum_d (S_d - t_d)^2 / t_d: from y, a little beyond the last two rates, r_i = min(`MOST` r0_i, max(`LEAST` r0_i,
y_i - sum_d p_id (S_d(y) - t_d) / (t_d L))), with L the largest eigenvalue of sum_i c_i p_i p_i^T / sum_i c_i between the
square roots of 1 / t_d (gradients are taken per token). At most `STEPS` steps are taken; they end sooner when targets are met or when a step moves
no rate (`CLOSE_ENOUGH`). Rates are nonnegative and stay near their start, because blurred posteriors make far ones meet the targets by
artefacts (whole groups of clean documents dropped, short odd ones repeated); none exceeds `MOST` times the largest target / share. `reached`
tells the shares that rates come to beside the wanted ones. A step sends a few sums to the driver and none of the documents.

Copies. ``copies`` is the rate rounded up or down by a hash of the id, so that its expectation is the rate.

Defined cases: null or empty texts have no tokens and rate as their posterior says; labels of one id: toxic if any says so, else junk if any says quality 0;
without labels every document has the uniform posterior; a domain without any posterior mass keeps what is reachable; repeated rows are rated each;
an empty table gives none; extra columns are ignored (`rates`) or kept, whatever their names (`resample`). Built-in functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stash

DOMAINS = ("clean", "junk", "toxic")
TARGETS = {"clean": 0.95, "junk": 0.03, "toxic": 0.02}
MAX_LABELLED, MAX_WORDS, LEAST_G2 = 20_000, 1_000, 25.0
#: projected-gradient steps at most, and Newton steps of the calibration
STEPS, NEWTON = 25, 10
#: largest mean square root of a step (by tokens) at which rates count as settled, and largest miss of a share at which targets count as met
CLOSE_ENOUGH = 1e-4
#: rates stay between these multiples of their start, the posterior's mean of target over share
LEAST, MOST = 0.25, 2.0
RIDGE = 0.5
_BREAKS = r"[\x00-@\[-`{-\x7f]+"
#: word scores beyond this add nothing
_SCORE = 20.0


def _words(text: Column) -> Column:
    """Hashes of the lower-case words, repeats included."""
    return F.transform(F.split(F.lower(text), _BREAKS), lambda w: F.xxhash64(w))


def _shares(text: Column, words: Column) -> list[Column]:
    """Log-scaled shares of symbols, capitals and repeated words."""
    n = F.greatest(F.length(text), F.lit(1))

    def share(others: str) -> Column:
        return F.log1p(500 * F.length(F.regexp_replace(text, others, "")) / n)

    repeats = (F.size(words) - F.size(F.array_distinct(words))) / F.greatest(F.size(words), F.lit(1))
    return [share("[^#*$%&|<>!]+"), share("[^A-Z]+"), -F.log(1.02 - repeats)]


def _counted(text: Column) -> Column:
    """Words: runs without blank or ASCII control 9 to 13."""
    # every run of other characters becomes one letter and separators go
    marked = F.regexp_replace(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w"), r"[\x20\x09-\x0D]+", "")
    return F.length(marked).cast("long")


def domains_of(labels: DataFrame) -> DataFrame:
    """``doc_id, domain`` (number into `DOMAINS`) of every labelled id."""
    marks = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    return marks.select("doc_id", F.when(F.col("t") == 1, 2).when(F.col("q") == 0, 1).otherwise(0).alias("domain"))


_SHARES = ("symbols", "capitals", "repeats")
_FEATURES = (*[f"score_{d}" for d in DOMAINS[1:]], *_SHARES)


@dataclass
class Model:
    """Word scores (hash -> log-likelihood ratio to the first domain, per other domain) and logistic weights (intercept first)."""

    words: dict[int, list[float]] = field(default_factory=dict)
    weights: list[list[float]] = field(default_factory=lambda: [[0.0] * (1 + len(_FEATURES)) for _ in DOMAINS[1:]])

    def features(self, text: Column) -> Column:
        """A struct of `_FEATURES`."""
        known = sorted(self.words)
        listed = F.array(*[F.lit(w) for w in known])

        def score(j: int, words: Column) -> Column:
            if not known:
                return F.lit(0.0)
            table = F.map_from_arrays(listed, F.array(*[F.lit(self.words[w][j]) for w in known]))
            total = F.aggregate(F.array_intersect(listed, words), F.lit(0.0), lambda a, w: a + F.element_at(table, w))
            return F.greatest(F.lit(-_SCORE), F.least(F.lit(_SCORE), total))

        def of(words: Column) -> Column:
            scores = [score(j, words) for j in range(len(DOMAINS) - 1)]
            return F.struct(*[c.alias(n) for n, c in zip(_FEATURES, [*scores, *_shares(text, words)], strict=True)])

        return let(_words(text), of)

    def posterior(self, x: list[Column]) -> list[Column]:
        """Probabilities of the domains from the features."""
        lines = [sum((F.lit(b) * c for b, c in zip(w[1:], x, strict=True)), F.lit(w[0])) for w in self.weights]
        top = F.greatest(F.lit(0.0), *lines)
        parts = [F.exp(-top), *[F.exp(line - top) for line in lines]]
        total = sum(parts[1:], parts[0])
        return [p / total for p in parts]


def _solve(a: list[list[float]], b: list[float]) -> list[float]:
    """Solution of a small symmetric system, by elimination (with a little of each diagonal element added to it)."""
    n = len(b)
    m = [[*(a[i][j] * (1 + 1e-9) + 1e-300 if i == j else a[i][j] for j in range(n)), b[i]] for i in range(n)]
    for i in range(n):
        p = max(range(i, n), key=lambda r: abs(m[r][i]))
        m[i], m[p] = m[p], m[i]
        for r in range(n):
            if r != i and m[i][i]:
                f = m[r][i] / m[i][i]
                m[r] = [x - f * y for x, y in zip(m[r], m[i], strict=True)]
    return [m[i][n] / m[i][i] if m[i][i] else 0.0 for i in range(n)]


def _largest_eigenvalue(a: list[list[float]], rounds: int = 200) -> float:
    """Of a small positive semidefinite matrix with nonnegative elements, by power iteration."""
    x = [1.0] * len(a)
    top = 0.0
    for _ in range(rounds):
        y = [sum(v * z for v, z in zip(row, x, strict=True)) for row in a]
        top = math.sqrt(sum(z * z for z in y))
        if not top:
            return 0.0
        x = [z / top for z in y]
    return top


def _calibrate(rows: DataFrame, model: Model, newton: int = NEWTON) -> None:
    """Fit the logistic weights to ``rows`` (features and ``domain``) by Newton steps; the intercepts have no ridge."""
    rows = stash(rows, "calibration")
    k, f = len(DOMAINS) - 1, 1 + len(_FEATURES)
    x = [F.lit(1.0), *map(F.col, _FEATURES)]
    for _ in range(newton):
        p = model.posterior(x[1:])
        sums = [F.sum((F.when(F.col("domain") == a + 1, 1.0).otherwise(0.0) - F.col(f"p{a}")) * x[i]).alias(f"g{a}_{i}") for a in range(k) for i in range(f)]
        pairs = [(a, i, b, j) for a in range(k) for i in range(f) for b in range(a, k) for j in range(f) if a < b or i <= j]
        sums += [F.sum(F.col(f"p{a}") * ((1.0 if a == b else 0.0) - F.col(f"p{b}")) * x[i] * x[j]).alias(f"h{a}_{i}_{b}_{j}") for a, i, b, j in pairs]
        got = rows.select("domain", *_FEATURES, *[p[a + 1].alias(f"p{a}") for a in range(k)]).agg(*sums).first()
        if got["g0_0"] is None:
            return
        grad = [got[f"g{a}_{i}"] - (RIDGE * model.weights[a][i] if i else 0.0) for a in range(k) for i in range(f)]
        hess = [[0.0] * (k * f) for _ in range(k * f)]
        for a, i, b, j in pairs:
            hess[a * f + i][b * f + j] = hess[b * f + j][a * f + i] = got[f"h{a}_{i}_{b}_{j}"]
        for a in range(k):
            for i in range(f):
                hess[a * f + i][a * f + i] += RIDGE if i else 1e-6
        step = _solve(hess, grad)
        longest = max(map(abs, step))
        model.weights = [[model.weights[a][i] + step[a * f + i] * min(1.0, 5.0 / longest if longest else 1.0) for i in range(f)] for a in range(k)]
        if longest < 1e-4:
            return


def train(docs: DataFrame, labelled: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """A model from at most ``max_labelled`` rows ``doc_id, domain``."""
    few = stash(labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled), "labelled")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(few), "doc_id")
    rows = stash(rows.select("domain", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(3)).alias("part"), "text",
                             F.array_distinct(_words(F.col("text"))).alias("words")), "marks")
    model, k = Model(), len(DOMAINS)
    n = {(r["part"], r["domain"]): r["count"] for r in rows.groupBy("part", "domain").count().collect()}
    if not n:
        return model
    first = [n.get((0, d), 0) for d in range(k)]
    total = sum(first)
    each = [F.sum(F.when(F.col("domain") == d, 1).otherwise(0)).alias(f"n{d}") for d in range(k)]
    of_part = lambda part: rows.where(F.col("part") == part).select("domain", F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"), *each)
    seen = of_part(0).where("n >= 3")

    def of_domain(d: int) -> DataFrame:
        """Words that are far more frequent in the domain than outside, the clearest first."""
        t, m, rate = F.col(f"n{d}"), F.col("n"), max(first[d], 1) / total
        rest = F.greatest(m - t, F.lit(0))
        g2 = 2 * (t * F.log(t / (m * rate)) + F.when(rest > 0, rest * F.log(rest / (m * (1 - rate)))).otherwise(0.0))
        far = seen.where((t > 0) & (t / m > 2 * rate)).withColumn("g2", g2).where(F.col("g2") >= LEAST_G2)
        return far.orderBy(F.desc("g2"), "word").limit(MAX_WORDS).select("word")

    # the first domain is what scores compare with, and a domain that most rows belong to has no words of its own
    lists = [of_domain(d) for d in range(1, k) if 0 < first[d] < total / 2]
    if lists:
        chosen = lists[0]
        for more in lists[1:]:
            chosen = chosen.union(more)
        counts = of_part(1).join(F.broadcast(chosen.distinct()), "word").collect()       # at most MAX_WORDS a domain
        size = [n.get((1, d), 0) for d in range(k)]
        for r in counts:
            base = math.log((r["n0"] + 0.5) / (size[0] + 1.0))
            model.words[r["word"]] = [math.log((r[f"n{d}"] + 0.5) / (size[d] + 1.0)) - base for d in range(1, k)]
    _calibrate(rows.where(F.col("part") == 2).select("domain", model.features(F.col("text")).alias("x")).select("domain", "x.*"), model)
    return model


def posteriors(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns ``keep``, ``n_tokens`` and ``p_<domain>`` of every row."""
    text = F.coalesce("text", F.lit(""))
    d = docs.select("doc_id", *keep, _counted(text).alias("n_tokens"), model.features(text).alias("x"))
    blank = not any(map(any, model.weights))
    p = [F.lit(1.0 / len(DOMAINS)) for _ in DOMAINS] if blank else model.posterior([F.col(f"x.{f}") for f in _FEATURES])
    return d.select("doc_id", *keep, "n_tokens", *[c.alias(f"p_{name}") for name, c in zip(DOMAINS, p, strict=True)])


def _goal(targets: dict[str, float]) -> list[float]:
    return [targets.get(d, 0.0) / sum(targets.values()) for d in DOMAINS]


def fit_rates(soft: DataFrame, targets: dict[str, float] = TARGETS, steps: int = STEPS, close: float = CLOSE_ENOUGH, most: float = MOST) -> Column:
    """The rate of a document as an expression of its ``p_<domain>`` columns; ``soft``: a stored table of those and ``n_tokens``."""
    k, goal = len(DOMAINS), _goal(targets)
    p, c = [F.col(f"p_{d}") for d in DOMAINS], F.col("n_tokens")
    have = soft.agg(F.sum(c).alias("c"), *[F.sum(c * p[i]).alias(f"s{i}") for i in range(k)],
                    *[F.sum(c * p[i] * p[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    tokens = float(have["c"] or 0)
    if not tokens:
        return F.lit(1.0)
    start = sum((p[j] * F.lit(goal[j] * tokens / have[f"s{j}"] if have[f"s{j}"] else 0.0) for j in range(1, k)),
                p[0] * F.lit(goal[0] * tokens / have["s0"] if have["s0"] else 0.0))
    # least squares in which a domain weighs as one over its target (a domain that is not wanted weighs as the scarcest)
    weight = [1.0 / max(g, min((x for x in goal if x > 0), default=1.0)) for g in goal]
    h = [[have[f"g{min(i, j)}_{max(i, j)}"] / tokens * math.sqrt(weight[i] * weight[j]) for j in range(k)] for i in range(k)]
    length = _largest_eigenvalue(h) or 1.0
    moves: list[tuple[list[float], float]] = []     # (step, how far beyond it the next one starts)

    def after(some: list[tuple[list[float], float]]) -> Column:
        """Struct of the rates ``r`` after these steps, the rates ``q`` before the last, and the point ``y`` of the next step."""
        def of(r0: Column) -> Column:
            first = F.struct(r0.alias("r"), r0.alias("q"), r0.alias("y"))
            if not some:
                return first
            taken = F.array(*[F.struct(*[F.lit(float(m[j])).alias(f"m{j}") for j in range(k)], F.lit(float(beyond)).alias("b")) for m, beyond in some])

            def step(at: Column, m: Column) -> Column:
                moved = at["y"] - sum((p[j] * m[f"m{j}"] for j in range(1, k)), p[0] * m["m0"])
                return let(F.least(r0 * most, F.greatest(r0 * LEAST, moved)),
                           lambda r: F.struct(r.alias("r"), at["r"].alias("q"), (r + m["b"] * (r - at["r"])).alias("y")))

            return F.aggregate(taken, first, step)

        return let(start, of)

    for n in range(steps + 1):
        rated = soft.select("n_tokens", *[f"p_{d}" for d in DOMAINS], after(moves).alias("at"))
        got = rated.agg(*[F.sum(c * F.col(f"at.{x}") * p[j]).alias(f"{x}{j}") for x in "ry" for j in range(k)],
                        F.sum(c * (F.col("at.r") - F.col("at.q")) ** 2).alias("moved")).first()
        off = [got[f"r{j}"] / tokens - goal[j] for j in range(k)]
        if max(map(abs, off)) <= close or n == steps or n and math.sqrt(got["moved"] / tokens) <= close / 10:
            break
        moves.append(([weight[j] * (got[f"y{j}"] / tokens - goal[j]) / length for j in range(k)], n / (n + 3)))
    return after(moves)["r"]


def reached(rated: DataFrame, targets: dict[str, float] = TARGETS, times: str = "rate") -> DataFrame:
    """``domain, wanted, reached``: target and share of the expected tokens after mixing, by the column ``times`` (``rate`` or ``copies``)."""
    each = F.col("n_tokens") * F.col(times)
    got = rated.agg(F.sum(each).alias("c"), *[F.sum(each * F.col(f"p_{d}")).alias(d) for d in DOMAINS])
    rows = F.array(*[F.struct(F.lit(d).alias("domain"), F.lit(goal).alias("wanted"), F.try_divide(F.col(d), F.col("c")).alias("reached"))
                     for d, goal in zip(DOMAINS, _goal(targets), strict=True)])
    return got.select(F.explode(rows).alias("r")).select("r.*")


def copies_of(rate: Column, doc_id: Column, seed: int = 7) -> Column:
    """Whole copies with expectation ``rate``: a hash of the id decides about the fraction."""
    u = F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(1 << 32)) / float(1 << 32)
    return F.floor(rate + u).cast("long")


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, keep: tuple[str, ...] = (), most: float = MOST) -> DataFrame:
    """``doc_id, n_tokens, p_<domain>..., rate, copies`` and the columns ``keep`` of every row."""
    soft = stash(posteriors(docs, train(docs, domains_of(labels)), keep), "posteriors")
    rate = fit_rates(soft, targets, most=most)
    return soft.withColumn("rate", rate).withColumn("copies", copies_of(F.col("rate"), F.col("doc_id")))


def resample(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, most: float = MOST) -> DataFrame:
    """``docs`` with each row repeated ``copies`` times (none: gone), all columns kept.

    The targets are solved for as given, whatever the shares of ``docs`` are. Rows travel with their posteriors in one stored
    table, so nothing is joined back.
    """
    d = docs.select("doc_id", "text", F.struct("*").alias("whole"))
    rated = rates(d, labels, targets, ("whole",), most)
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return rated.where("copies > 0").select("whole", again.alias("copy")).select("whole.*")
