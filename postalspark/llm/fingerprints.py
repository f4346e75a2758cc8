"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the ``k`` smallest different 64-bit hashes (XXH64) of a text's five-word shingles, plus their exact
number when there are at most ``k``. Sketches merge: the sketch of a union is the ``k`` smallest of both
sketches. From them come resemblance, containment and the number of different shingles, each with
relative error about 1/sqrt(k), whatever the text's length.

Defined cases: null text counts as empty; a text with fewer than five words has one shingle, all its
words; an empty one has none (two empty sketches have likeness 1, an empty and another one 0).
Rows with one ``doc_id`` are ordered by the text's hash and are each other's next document.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

K = 64
SHINGLE_WORDS = 5
SEED = 42


def sketch(text: str | None, k: int = K, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Ascending array of the ``k`` smallest different shingle hashes of a text."""
    toks = (text or "").encode("utf-8", "surrogatepass").split()  # bytes: splits at blank and 9..13 only
    if not toks:
        return np.empty(0, np.uint64)
    h = xxhash.xxh64_intdigest
    line = b" ".join(toks)
    if len(toks) <= words:
        return np.array([h(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, toks), np.int64, len(toks)) + 1) - 1
    begins = [0, *(ends[: -words] + 1).tolist()]
    hashes = np.array([h(line[a:b], SEED) for a, b in zip(begins, ends[words - 1:].tolist(), strict=True)], np.uint64)
    if len(hashes) > 4 * k:  # the k smallest different ones lie among the smallest few, unless repeats fill them
        low = np.unique(np.partition(hashes, 4 * k)[: 4 * k])
        if len(low) >= k:
            return low[:k]
    return np.unique(hashes)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union of two texts' (or two parts') shingle sets."""
    return np.union1d(a, b)[:k]


def distinct_count(a: np.ndarray, k: int = K) -> float:
    """Estimated number of different shingles (exact below ``k``)."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[k - 1]) + 1) / 2.0**64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard likeness of the two shingle sets, 0 to 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = merge(a, b, k)
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, both, assume_unique=True).sum()) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of ``a``'s shingles that ``b`` holds too."""
    r, na, nu = resemblance(a, b, k), distinct_count(a, k), distinct_count(merge(a, b, k), k)
    return min(1.0, r * nu / na) if na else 1.0


def to_text(a: np.ndarray) -> str:
    return a.astype(">u8").tobytes().hex()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(s), ">u8").astype(np.uint64)


def sketch_documents(docs: DataFrame, k: int = K, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fingerprint`` (hex of the sketch), ``n_shingles`` (estimate) for every row."""
    def rows(c: dict[str, list]) -> dict[str, list]:
        got = [sketch(t, k, words) for t in c["text"]]
        return {"doc_id": c["doc_id"], "fingerprint": [to_text(s) for s in got],
                "n_shingles": [distinct_count(s, k) for s in got]}

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(d, rows, "doc_id long, fingerprint string, n_shingles double")


class Ranges:
    """Ranges of the order (doc_id with nulls first, hash of the text), as even as ``doc_id`` and the hash let them be.

    ``cuts`` are quantiles of ``doc_id``, repeated where one id holds several of them: such an id, and the null one, is cut
    further by the hash, which is spread evenly, so that an id on a third of all rows gets a third of the ranges.
    """

    def __init__(self, cuts: list[int], null_ranges: int):
        self.ids, self.times = np.unique(np.array(cuts, np.int64), return_counts=True)
        self.before = np.concatenate([[0], np.cumsum(self.times)]).astype(np.int64)
        self.null_ranges = null_ranges
        self.count = null_ranges + int(self.before[-1]) + 1

    def of(self, ids: pd.Series, hashes: pd.Series) -> np.ndarray:
        missing = ids.isna().to_numpy()
        known = ids.fillna(0).to_numpy(np.int64)
        at = np.searchsorted(self.ids, known, "right")
        out = self.before[at]
        # the top 32 bits of the hash, as a share of all of them
        share = (hashes.to_numpy(np.int64) >> 32) + (1 << 31)
        if len(self.ids):
            cut = np.maximum(at - 1, 0)
            equal = (at > 0) & (self.ids[cut] == known)
            out = np.where(equal, self.before[cut] + 1 + (share * self.times[cut] >> 32), out)
        out = out + self.null_ranges
        return np.where(missing, share * max(self.null_ranges, 1) >> 32, out).astype(np.int32)


def ranges_of(ids: DataFrame) -> Ranges:
    """As many ranges of ``ids`` (one column doc_id) as there are shuffle partitions; the driver holds a number per range."""
    n = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = ids.agg(F.count("*").alias("rows"), F.count("doc_id").alias("known")).first()
    missing = sizes["rows"] - sizes["known"]
    nulls = 0 if not missing else max(1, round(n * missing / sizes["rows"]))
    parts = max(1, n - nulls)
    probs = [i / parts for i in range(1, parts)]
    cuts = ids.approxQuantile("doc_id", probs, 1 / (4 * n)) if probs and sizes["known"] else []
    return Ranges(cuts, nulls)


def with_next(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows ``bucket, tail, doc_id, h, text`` in which each row's next document follows it in its bucket, and the number of buckets.

    The first document of each range also goes to the range before (``tail`` true), the very first one to the last range, so no
    range needs another's rows and each text is shuffled once.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranges = ranges_of(d.select("doc_id"))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series(ranges.of(ids, hashes))

    hashed = d.withColumn("h", F.xxhash64("text")).withColumn("at", range_of("doc_id", "h"))
    # struct order puts a null id before all others, as the sort does
    lead = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "h"))
    first = {r["at"]: (r["a"]["doc_id"], r["a"]["h"]) for r in hashed.groupBy("at").agg(lead.alias("a")).collect()}
    used = sorted(first)
    before = dict(zip(used, used[-1:] + used[:-1], strict=True))

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series, hashes: pd.Series, at: pd.Series) -> pd.Series:
        known = ids.astype("Int64")
        return pd.Series([[2 * b, 2 * before[b] + 1] if first[b] == (None if i is pd.NA else i, h) else [2 * b]
                          for i, h, b in zip(known, hashes, at, strict=True)])

    rows = hashed.select(F.explode(places("doc_id", "h", "at")).alias("place"), "doc_id", "h", "text").select(
        F.shiftright("place", 1).alias("bucket"), (F.col("place") % 2 == 1).alias("tail"), "doc_id", "h", "text")
    return rows, ranges.count


def compare_with_next(docs: DataFrame, k: int = K, words: int = SHINGLE_WORDS) -> DataFrame:
    """Each document's sketch against its edited text's and the next document's (ascending ``doc_id``, cyclic).

    The edited text is the text with its last half (floor of half its code points) replaced by the first
    as many code points, or all, of the next document. Returns ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, n_shingles, held_by_next`` (containment).
    """
    rows, n = with_next(docs)
    rows = (rows.repartitionById(n, F.col("bucket"))
            .sortWithinPartitions("bucket", "tail", F.col("doc_id").asc_nulls_first(), "h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (bucket, doc_id, text, sketch) that waits for its next document
        closed = None  # the bucket whose last document has met its tail
        for b in batches:
            out = []
            for bucket, tail, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("bucket", "tail", "doc_id", "text")), strict=True):
                if bucket == closed:
                    continue
                own = last[3] if last is not None and last[2] == text else sketch(text, k, words)
                if last is not None:
                    _, i, t, s = last
                    half = len(t) // 2
                    edited = t[: len(t) - half] + text[:half]
                    e = sketch(edited, k, words) if edited != t else s
                    out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), to_text(s), to_text(e),
                                resemblance(s, e, k), resemblance(s, own, k), distinct_count(s, k), containment(s, own, k)))
                last, closed = (None, bucket) if tail else ((bucket, doc_id, text, own), closed)
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], f.type) for j, f in enumerate(schema)], schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                        ("near_next", pa.float64()), ("n_shingles", pa.float64()), ("held_by_next", pa.float64())])
    return rows.select("bucket", "tail", "doc_id", "text").mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double, n_shingles double, held_by_next double")
