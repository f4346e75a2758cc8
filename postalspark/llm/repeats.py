"""Suffix-array dedup: repeated byte windows by a depth-limited radix sort.

Only whether two suffixes agree in their first ``length`` bytes matters, so suffixes are ordered no further than
that, by most-significant-digit passes, and a suffix leaves as soon as its group is a single one. The suffixes of
a document that share their first digit go as one record:

* digit 0 is the hash of the window's minimizer, the leftmost ``GRAM``-byte string in it with the least hash.
  Equal windows have equal minimizers at equal offsets, and about 35 neighbouring windows share one, so
  a record stands for a run of suffixes;
* digit 1 is the hash of the whole stretch that the run's windows cover. Runs equal in it are equal window by
  window: all but the first are repeats and need no further pass, and one of them stands for all;
* digit 2, for runs that share digit 0 with a different stretch, is the hash of each single window.

Equal groups of full windows after the last pass are exactly the repeated windows; all but each group's first (smallest
document, then start) are removed, judged on the input. Repeats inside a document are settled while it
is read, so a document sends each digit-1 group once. The sorted groups are streamed: a group of any size takes constant
memory. Hashes have 64 bits per digit from unrelated multipliers; digits 0 and 1 are compared together
(128 bits), digit 2 with 24 bits of another hash (88), so a false repeat is out of reach in practice.

Texts travel twice, zstd-compressed: to the runs of digit 2, and to the spans.

Defined cases: a null text is empty; texts shorter than a window lose nothing; rows with one ``doc_id`` (or a null one, which
comes first) count as documents in an order of their own (ordered by the text's hash); an empty table gives
none; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import has_repeats, ranked, stash

LENGTH, GRAM = 100, 32
#: bits of a second hash that go along with digit 2 (88 bits together)
EXTRA = 24
_M = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93 | 1, 0xA0761D6478BD642F | 1))
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_S = np.uint64(32)


def _inverse(m: int) -> int:
    return pow(m, -1, 1 << 64)


class Prefix:
    """Hashes of any stretches of a byte string, by prefix sums of a polynomial modulo 2**64."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, which: int):
        n = len(data)
        have = self._powers.get(which)
        if have is None or len(have[0]) <= n:
            size = max(1 << 16, 2 * n)
            up = np.full(size, _M[which], np.uint64)
            down = np.full(size, np.uint64(_inverse(int(_M[which]))), np.uint64)
            up[0] = down[0] = 1
            have = self._powers[which] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
        self.down = have[1]
        self.sums = np.zeros(n + 1, np.uint64)
        letters = (data.astype(np.uint64) + np.uint64(1)) * _MIX
        letters ^= letters >> _S
        np.cumsum(letters * have[0][:n], out=self.sums[1:])

    def of(self, a, b) -> np.ndarray:
        """Hashes of [a, b), well mixed."""
        h = (self.sums[b] - self.sums[a]) * self.down[a]
        h ^= h >> _S
        h *= _MIX
        h ^= h >> _S
        return h


def runs(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(position of the minimizer, first window, last window, digit 0) of each run of windows with one minimizer.

    ``data`` holds documents one after the other, each up to its place in ``ends``; no window crosses.
    """
    if len(data) < length:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    h = Prefix(data, 0).of(slice(0, len(data) - gram + 1), slice(gram, len(data) + 1))
    span, pos = length - gram + 1, np.arange(len(h), dtype=np.int32)
    best, reach = h, 1
    while reach < span:  # leftmost least of ever wider stretches, doubled until they fill a window
        step = min(reach, span - reach)
        right = best[step:] < best[:-step]
        pos = np.where(right, pos[step:], pos[:-step])
        best = np.where(right, best[step:], best[:-step])
        reach += step
    whole = np.ones(len(pos) + 2, bool)  # windows inside one document, with a closed border on either side
    whole[0] = whole[-1] = False
    for e in ends:
        whole[max(1, e - length + 2): max(1, e + 1)] = False
    whole[-1] = False
    step = np.ones(len(pos) + 1, bool)
    step[1:-1] = pos[1:] != pos[:-1]
    first = np.flatnonzero(whole[1:-1] & (step[:-1] | ~whole[:-2]))
    last = np.flatnonzero(whole[1:-1] & (step[1:] | ~whole[2:]))
    return pos[first].astype(np.int64), first, last, h[pos[first]]


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def keyed(docs: DataFrame) -> DataFrame:
    """``key, doc_id, text``: ``key`` is the document's place in the order (the id itself where ids are unique)."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not has_repeats(d, "doc_id"):
        return d.select(F.col("doc_id").alias("key"), "doc_id", "text")
    order = ranked(d.withColumn("h", F.xxhash64("text")), ["doc_id", "h"], "key")
    return order.select("key", "doc_id", "text")


#: bytes of text that are hashed in one go
CHUNK = 1 << 19


def _chunks(keys: list, texts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document keys, their ends, their bytes one after the other) of about `CHUNK` bytes each; documents stay whole."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK or i == len(texts) - 1:
            part = texts[begin: i + 1]
            yield np.array(keys[begin: i + 1], np.int64), np.cumsum([len(x) for x in part]), np.concatenate(part)
            begin, size = i + 1, 0


def _later(*columns: np.ndarray, same: int) -> np.ndarray:
    """Marks the rows that agree with an earlier row (order of ``columns``) in the first ``same`` columns."""
    order = np.lexsort(columns[::-1])
    equal = np.ones(max(0, len(order) - 1), bool)
    for c in columns[:same]:
        equal &= c[order][1:] == c[order][:-1]
    out = np.zeros(len(order), bool)
    out[order[1:]] = equal
    return out


def _records(docs: DataFrame, length: int) -> DataFrame:
    """One row per run: ``digit0, digit1, key, place``; ``place`` is negative (~place) where the batch holds the same
    stretch earlier, which makes the run a repeat whatever else there is."""
    schema = pa.schema([("digit0", pa.int64()), ("digit1", pa.int64()), ("key", pa.int64()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for keys, ends, data in _chunks(b.column(0).to_pylist(), [_bytes(t) for t in b.column(1).to_pylist()]):
                pos, lo, hi, zero = runs(data, ends, length)
                one = Prefix(data, 1).of(lo, hi + length) ^ ((hi - lo).astype(np.uint64) * _M[1] + (pos - lo).astype(np.uint64) * _M[2])
                doc = np.searchsorted(ends, lo, "right")
                begin = np.concatenate([[0], ends])[doc]
                found.append((zero, one, keys[doc], ((lo - begin) << 16) | ((hi - lo) << 8) | (pos - lo)))
            if found:
                zero, one, key, place = (np.concatenate(x) for x in zip(*found, strict=True))
                place = np.where(_later(zero, one, key, place, same=2), ~place, place)
                for i in range(0, len(key), 1 << 17):
                    cut = slice(i, i + (1 << 17))
                    yield pa.RecordBatch.from_arrays([pa.array(zero[cut].view(np.int64)), pa.array(one[cut].view(np.int64)), pa.array(key[cut]), pa.array(place[cut])], schema=schema)

    return docs.select("key", "text").mapInArrow(run, "digit0 long, digit1 long, key long, place long")


def _dealt(rows: DataFrame, group: str, place: str, order: list) -> DataFrame:
    """Groups whole and sorted in their partitions; rows that are repeats already (negative place) anywhere, before them."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    settled = F.col(place) < 0
    return (rows.repartition(n, F.when(settled, F.xxhash64("key", place)).otherwise(F.col(group)))
            .sortWithinPartitions(settled.desc(), *order))


def _sift(records: DataFrame) -> DataFrame:
    """Digits 0 and 1: ``key, place, repeat`` of runs that are repeats (true) or must be looked at window by window (false)."""
    schema = pa.schema([("key", pa.int64()), ("place", pa.int64()), ("repeat", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None     # (digit0, digit1) of the row before
        waiting = None  # the first run of a digit-0 group, until a second stretch of the group shows up
        for b in batches:
            zero, one, key, place = (b.column(i).to_numpy() for i in range(4))
            settled = place < 0
            done = [(key[settled], ~place[settled], np.ones(settled.sum(), bool))]
            zero, one, key, place = (c[~settled] for c in (zero, one, key, place))
            if n := len(zero):
                same0, same1 = np.zeros(n, bool), np.zeros(n, bool)
                same0[1:] = zero[1:] == zero[:-1]
                same1[1:] = same0[1:] & (one[1:] == one[:-1])
                if last is not None:
                    same0[0] = zero[0] == last[0]
                    same1[0] = same0[0] and one[0] == last[1]
                heads = np.flatnonzero(~same1)       # the first run of each stretch
                follows = same0[heads]               # not the first stretch of its digit-0 group
                followed = np.append(follows[1:], False)
                look = heads[follows | followed]
                done += [(key[same1], place[same1], np.ones(same1.sum(), bool)), (key[look], place[look], np.zeros(len(look), bool))]
                if len(heads):
                    if waiting is not None and follows[0]:
                        done.append((*waiting, np.zeros(1, bool)))
                    h = heads[-1]
                    waiting = None if follows[-1] else (key[h: h + 1], place[h: h + 1])
                last = (zero[-1], one[-1])
            cols = [np.concatenate(x) for x in zip(*done, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=schema)

    order = _dealt(records, "digit0", "place", ["digit0", "digit1", "key", "place"])
    return order.mapInArrow(run, "key long, place long, repeat boolean")


def _packed(docs: DataFrame) -> DataFrame:
    """``key, doc_id, packed``: the texts, zstd-compressed, as they travel."""
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("packed", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([z.compress(_bytes(t).tobytes()) for t in b.column(2).to_pylist()], pa.binary())], schema=schema)

    return docs.select("key", "doc_id", "text").mapInArrow(run, "key long, doc_id long, packed binary")


def _windows(packed: DataFrame, look: DataFrame, length: int) -> DataFrame:
    """Digit 2: ``digit2, key, at`` of every window of the runs to be looked at; ``at`` is its start with `EXTRA` more bits
    of its digit, negative (~at) where the batch holds the same window earlier."""
    schema = pa.schema([("digit2", pa.int64()), ("key", pa.int64()), ("at", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        z = zstandard.ZstdDecompressor()
        for b in batches:
            found, size = [], 0
            for i, (key, text, places) in enumerate(zip(*(b.column(j).to_pylist() for j in range(3)), strict=True)):
                data, at = np.frombuffer(z.decompress(text), np.uint8), np.unique(np.array(places, np.int64))
                lo, n = at >> 16, ((at >> 8) & 255) + 1
                starts = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                more = Prefix(data, 2).of(starts, starts + length) >> np.uint64(64 - EXTRA)
                found.append((Prefix(data, 1).of(starts, starts + length), more.astype(np.int64), np.full(len(starts), key, np.int64), starts))
                size += len(starts)
                if size >= 1 << 20 or i == b.num_rows - 1:
                    one, two, key_, start = (np.concatenate(x) for x in zip(*found, strict=True))
                    at = (start << EXTRA) | two
                    at = np.where(_later(one, two, key_, start, same=2), ~at, at)
                    yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(key_), pa.array(at)], schema=schema)
                    found, size = [], 0

    each = look.groupBy("key").agg(F.collect_list("place").alias("places"))  # at most one entry per byte of the document
    return packed.join(each, "key").select("key", "packed", "places").mapInArrow(run, "digit2 long, key long, at long")


def _repeated_windows(windows: DataFrame) -> DataFrame:
    """``key, start`` of every window but the first of its equal group, in (document, start) order."""
    schema = pa.schema([("key", pa.int64()), ("start", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            one, key, at = (b.column(i).to_numpy() for i in range(3))
            settled = at < 0
            at = np.where(settled, ~at, at)
            two = at & ((1 << EXTRA) - 1)
            again = np.zeros(len(one), bool)
            again[1:] = (one[1:] == one[:-1]) & (two[1:] == two[:-1]) & ~settled[:-1]
            if len(one):
                again[0] = last is not None and (one[0], two[0]) == last
                last = None if settled[-1] else (one[-1], two[-1])
            out = settled | again
            yield pa.RecordBatch.from_arrays([pa.array(key[out]), pa.array(at[out] >> EXTRA)], schema=schema)

    order = ["digit2", F.col("at").bitwiseAND(F.lit((1 << EXTRA) - 1).cast("long")), "key", "at"]
    return _dealt(windows, "digit2", "at", order).mapInArrow(run, "key long, start long")


def repeated_spans(packed: DataFrame, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``key, spans`` of every document of which an earlier window repeats something.

    ``spans`` holds runs of repeated windows, (first start << 8) + number of further ones; not yet merged.
    """
    sifted = stash(_sift(_records(docs, length)), "sifted")
    whole = sifted.where("repeat").select("key", (F.shiftleft(F.shiftright("place", 16), 8) + F.shiftright("place", 8).bitwiseAND(F.lit(255).cast("long"))).alias("span"))
    single = _repeated_windows(_windows(packed, sifted.where("not repeat"), length)).select("key", F.shiftleft("start", 8).alias("span"))
    return whole.union(single).groupBy("key").agg(F.collect_list("span").alias("spans"))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: maximal removed byte runs (start, end) and the bytes that stay, for every row."""
    d = keyed(docs)
    packed = _packed(d)
    spans = repeated_spans(packed, d, length)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        z = zstandard.ZstdDecompressor()
        for b in batches:
            out = [], [], [], []
            for doc_id, text, got in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                data = np.frombuffer(z.decompress(text), np.uint8)
                gone = np.zeros(len(data) + 1, np.int32)
                if got:
                    at = np.array(got, np.int64)
                    np.add.at(gone, at >> 8, 1)
                    np.add.at(gone, (at >> 8) + (at & 255) + length, -1)
                removed = np.cumsum(gone)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], removed.view(np.int8), [0]])))
                out[0].append(doc_id)
                out[1].append(len(data))
                out[2].append([{"start": int(a), "end": int(e)} for a, e in zip(edge[::2], edge[1::2], strict=True)])
                out[3].append(data[~removed].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, schema, strict=True)], schema=schema)

    joined = packed.join(spans, "key", "left").select("doc_id", "packed", "spans")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
