"""Plain restatements of the operators' results, and the fixture rows the tests share."""

from __future__ import annotations

import hashlib
import math
import random
import re
import struct
from fractions import Fraction

import pandas as pd
import xxhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, row string, stratum string, h long, fp long, `__row` string"


def docs_frame(spark, rows, schema=SCHEMA):
    """Documents with clashing extra columns; ``rows``: (doc_id, text[, lang[, source]])."""
    full = [(i, t, *(rest or ("en",))[:1], rest[1] if len(rest) > 1 else "s0", None if t is None else len(t), 9, "r", "x", 5, 6, "q") for i, t, *rest in rows]
    return spark.createDataFrame(full, schema)


def edge_rows():
    """Nulls, empties, ties, repeats, a long text and ordinary ones."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(400)}" for _ in range(600)]
    text = " ".join(words[:80])
    return [(1, text), (2, text), (2, text), (3, None), (4, ""), (5, " \t\n"), (6, "one two"), (None, "null id words here " * 30),
            (8, " ".join(words)), (9, " ".join(words[100:300])), (10, "the same line\n" * 12), (11, "é ü ß " * 40),
            (12, " ".join(rng.choice(words) for _ in range(5000))), (-5, text + " tail")]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def quality_counts(text):
    from collections import Counter
    t, w = text or "", words_of(text)
    lines = [x for x in t.split("\n") if words_of(x)]
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {k for j in range(len(w) - 2) if grams[(w[j], w[j + 1], w[j + 2])] > 1 for k in (j, j + 1, j + 2)}
    counts = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
    return (*counts, counts[0] < 50 or 100 * counts[4] > 50 * counts[0])


def repeats_removed(rows, length):
    """(n_bytes, n_removed, n_spans, sha256) per row, rows in (doc_id, given) order; nulls first."""
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        d = (t or "").encode()
        gone = [False] * len(d)
        for s in range(len(d) - length + 1):
            w = d[s:s + length]
            if w in seen:
                gone[s:s + length] = [True] * length
            seen.add(w)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(d), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest()))
    return out


def simhash(text, n=3):
    w = [x.encode().lower() for x in words_of(text)]
    shingles = [b" ".join(w[j:j + n]) for j in range(len(w) - n + 1)] if len(w) >= n else [b" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(rows, fingerprint, bits=2):
    """component id per row (smallest id reachable)."""
    fps = [fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                parent[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[root(a)] = min(i, least.get(root(a), i))
    return fps, [least.get(root(a)) for a in range(len(rows))]


def frame(df, *order) -> pd.DataFrame:
    out = df.toPandas()
    return out.sort_values(list(order or out.columns[:1])).reset_index(drop=True)


def quality_features(text):
    """Shares that the quality rules look at, by name."""
    t = text or ""
    n_words, chars, symbols, lines, covered, _ = quality_counts(t)
    return {"symbols": symbols / max(chars, 1), "lines": lines / max(n_words, 1), "repeats": covered / max(n_words, 1), "upper": len(re.findall("[A-Z]", t)) / max(chars, 1),
            "bangs": t.count("!") / max(chars, 1), "marked": len(re.findall(r"[#*$%&|<>!][\x20\x09-\x0D]", t)) / max(n_words, 1)}


def at_most(k, n, p):
    """Exact P(X <= k) of a binomial(n, p)."""
    p = Fraction(str(p))
    return float(sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1)))


def quality_cutoffs(rows, labels, max_risk, error, levels):
    """stratum -> (rung, n, k, cutoffs by feature) of the certified level that parts good from bad best; rows: (doc_id, text, stratum)."""
    good = {}
    for i, q in labels:
        if i is not None and q is not None:
            good[i] = min(q, good.get(i, q))
    strata = {}
    for i, t, s in rows:
        if i in good and not quality_counts(t)[5]:
            held = xxhash.xxh64_intdigest(struct.pack("<q", i), 42) % 2 == 1
            strata.setdefault(s, []).append((held, good[i], quality_features(t)))
    ladder = {}
    for s, docs in strata.items():
        mine = [f for held, q, f in docs if not held and q == 1]
        for rung, level in enumerate(levels if mine else ()):
            ladder[s, rung] = {name: sorted(f[name] for f in mine)[max(math.ceil((1.0 - level) * len(mine)), 1) - 1] for name in mine[0]}
    best = {}
    for (s, rung), cut in ladder.items():
        hit = {(held, q): [any(f[name] > c for name, c in cut.items()) for h, g, f in strata[s] if (h, g) == (held, q)] for held in (0, 1) for q in (0, 1)}
        n, k = len(hit[1, 1]), sum(hit[1, 1])
        if not hit[0, 0] or (at_most(k, n, max_risk) if n else 1.0) > error / len(ladder):
            continue
        gain = sum(hit[0, 0]) / len(hit[0, 0]) - sum(hit[0, 1]) / len(hit[0, 1])
        if gain > 0 and (s not in best or (round(gain, 6), -rung) > best[s][0]):
            best[s] = (round(gain, 6), -rung), (rung, n, k, cut)
    return {s: b for s, (_, b) in best.items()}
