"""Packing: mixture-controlled, by deficit round-robin over one queue per source.

Every full window of ``size`` tokens takes from each source its target share of tokens. A source's share is
seldom a whole number, so its deficit (what it is owed) carries over from window to window: after ``w``
windows each source has given the tokens that come first when all queues are merged by
(j + 1/2) / share, the order in which deficit round-robin serves token ``j`` of a queue. That state has a closed form
in ``w`` (`served`), so each task finds its documents' windows by itself and deficits carry over between
partitions without passing rows on. No source is ever more than one round ahead of or behind its
share, and only the very last window is padded.

Documents keep their order (input split, then row) within their source's queue, and are cut where a window has had enough of the
source. When targets differ from the corpus' shares a queue can run dry; from there on
the others share the windows in proportion (one phase per queue that ends).

Two passes: the first tokenizes each whole text once and stores the ids; the second reads them and cuts. Queue positions
come from counts per (source, input split), never from a window over a source. The driver holds one number per source
(a corpus has a bounded list of sources; it doesn't grow with documents).

Defined cases: a null text is empty and still gives its end id; a null source is a source of its own;
repeated rows are packed each; an empty table gives no piece; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash

SIZE = 2048
END_ID = 1
#: segments whose ids a worker remembers; beyond it the memory starts anew
REMEMBERED = 400_000


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Tokenizer:
    """Byte-level BPE ids (unsigned 16 bit, little endian) of whole texts.

    The split pattern lets no token reach over a blank unless the blank starts it, so a text without double blanks
    and without white space after a blank is the concatenation of its blank-separated segments; ids of
    segments are remembered. Other texts are encoded whole.
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer as Full
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)["model"]["vocab"]
        specials = {"<|endoftext|>"}
        back = {c: b for b, c in _byte_letters().items()}
        ranks = {bytes(back[c] for c in t): i for t, i in spec.items() if t not in specials}
        if max(ranks.values()) >= 1 << 16:
            raise ValueError("ids need more than 16 bits")
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.full = Full.from_file(path)
        self.full.encode_special_tokens = True
        self.seen: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        try:
            ids = self.fast.encode_ordinary(text)
        except BaseException as e:  # its pattern engine panics on extreme runs of white space; the panic's type can't be imported
            if type(e).__name__ != "PanicException" and not isinstance(e, ValueError):
                raise
            ids = self.full.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u2").tobytes()

    def encode(self, text: str) -> bytes:
        segments = text.split(" ")
        if any(not s or s[0].isspace() for s in segments[1:]) or not segments[0]:
            return self._whole(text)
        seen = self.seen
        if len(seen) > REMEMBERED:
            seen.clear()
        out = [self._whole(segments[0])]
        for s in segments[1:]:
            ids = seen.get(s)
            if ids is None:
                ids = self._whole(" " + s)
                if len(s) <= 40:
                    seen[s] = ids
            out.append(ids)
        return b"".join(out)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def tokenize(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """``doc_id, source, split, start, n_tokens, ids``: ``start`` counts the tokens before it of its source in its input split."""
    path = tokenizer or default_tokenizer()
    schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("split", pa.int32()), ("start", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        split = TaskContext.get().partitionId()
        tok, end = Tokenizer(path), np.array([end_id], "<u2").tobytes()
        at: dict[str, int] = {}
        for b in batches:
            ids = [tok.encode(t) + end for t in b.column("text").to_pylist()]
            sources = b.column("source").to_pylist()
            counts, starts = [len(x) // 2 for x in ids], []
            for s, n in zip(sources, counts, strict=True):
                starts.append(at.get(s, 0))
                at[s] = starts[-1] + n
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sources, pa.string()), pa.array([split] * len(ids), pa.int32()),
                                              pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], schema=schema)

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
                    F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("source"))
    return d.mapInArrow(run, "doc_id long, source string, split int, start long, n_tokens long, ids binary")


class Schedule:
    """How many tokens of each queue the first ``n`` tokens of the packed stream hold."""

    def __init__(self, totals: list[int], weights: list[float] | None = None):
        self.totals = np.array(totals, np.int64)
        w = np.array(totals if weights is None else weights, np.float64)
        w = np.where(self.totals > 0, np.maximum(w, 1e-12), 0.0)
        # phases: (stream position, tokens already served of each queue, rates from there on)
        self.phases: list[tuple[int, np.ndarray, np.ndarray]] = []
        done, at = np.zeros(len(w), np.int64), 0
        while (left := self.totals - done).any():
            live = left > 0
            rates = np.where(live, w, 0) / w[live].sum()
            self.phases.append((at, done.copy(), rates))
            if weights is None:
                break
            need = np.full(len(w), np.inf)
            need[live] = left[live] / rates[live]
            span = int(np.ceil(need.min()))
            step = self._mix(np.array([span]), rates, left)[0]
            done = np.minimum(self.totals, done + step)
            at = int(done.sum())

    @staticmethod
    def _mix(n: np.ndarray, rates: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Tokens of each queue among the first ``n`` (vector): fewest virtual times (j + 1/2) / rate, never more than is left."""
        n = np.minimum(n, left.sum()).astype(np.int64)
        got = np.minimum(np.floor(n[:, None] * rates + 0.5).astype(np.int64), left)
        with np.errstate(divide="ignore", invalid="ignore"):
            while True:
                short = n - got.sum(1)
                if not short.any():
                    return got
                rows = np.flatnonzero(short > 0)
                if len(rows):
                    nxt = np.where(got[rows] < left, (got[rows] + 0.5) / rates, np.inf)
                    got[rows, nxt.argmin(1)] += 1
                rows = np.flatnonzero(short < 0)
                if len(rows):
                    last = np.where(got[rows] > 0, (got[rows] - 0.5) / rates, -np.inf)
                    got[rows, len(rates) - 1 - last[:, ::-1].argmax(1)] -= 1  # of equal times the last queue, as it came last

    def served(self, n: np.ndarray) -> np.ndarray:
        n = np.asarray(n, np.int64)
        out = np.zeros((len(n), len(self.totals)), np.int64)
        starts = [p[0] for p in self.phases]
        which = np.searchsorted(starts, n, "right") - 1
        for k, (at, done, rates) in enumerate(self.phases):
            rows = which == k
            if rows.any():
                out[rows] = done + self._mix(n[rows] - at, rates, self.totals - done)
        return out


def pack(docs: DataFrame, size: int = SIZE, targets: dict[str | None, float] | None = None, tokenizer: str | None = None,
         end_id: int = END_ID) -> DataFrame:
    """Pieces ``doc_id, source, start, length, doc_tokens, sequence_id, offset, ids`` (unsigned 32 bit, little endian) of every document.

    ``targets``: source -> weight; by default each source's share of the corpus, so that all queues end together.
    """
    tokens = stash(tokenize(docs, tokenizer, end_id), "tokens")
    return cut(tokens, size, targets)


def cut(tokens: DataFrame, size: int = SIZE, targets: dict[str | None, float] | None = None) -> DataFrame:
    """Deal the documents of `tokenize` out over windows."""
    per_split = tokens.groupBy("source", "split").agg(F.sum("n_tokens").alias("n"))
    totals = {r["source"]: r["n"] for r in per_split.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    sources = sorted(totals)
    weights = None if targets is None else [float(targets.get(s[1:] if s else None, 0.0)) for s in sources]
    plan = Schedule([totals[s] for s in sources], weights)
    number = {s: i for i, s in enumerate(sources)}
    total = sum(totals.values())
    # tokens of the source in the splits before: a window over counts per split, not over documents
    from pyspark.sql import Window
    before = Window.partitionBy("source").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    # stored, so that its size is known when the join is planned: broadcast below Spark's threshold, shuffled beyond
    shifts = stash(per_split.select("source", "split", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")), "shifts")
    placed = tokens.join(shifts, ["source", "split"]).select("doc_id", "source", (F.col("shift") + F.col("start")).alias("at"), "n_tokens", "ids")
    schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])

    def bounds(q: int, a: int, b: int) -> tuple[int, np.ndarray, np.ndarray]:
        """First window with a token of [a, b) of queue q, the queue's state at each window's start, offsets in the windows."""
        lo, hi = _window_of(plan, q, a, size, total), _window_of(plan, q, b - 1, size, total)
        state = plan.served(np.minimum(np.arange(lo, hi + 2) * size, total))
        return lo, state[:, q], (state[1:] - state[:-1])[:, :q].sum(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            cols = {k: v.to_pylist() for k, v in zip(batch.schema.names, batch.columns, strict=True)}
            queues = [number[s] for s in cols["source"]]
            known = {}
            for q in set(queues):  # one schedule for each queue's stretch of this batch
                own = [(a, a + n) for x, a, n in zip(queues, cols["at"], cols["n_tokens"], strict=True) if x == q]
                first, last = min(a for a, _ in own), max(b for _, b in own)
                if last - first <= 4 * sum(b - a for a, b in own) + 64 * size:
                    known[q] = bounds(q, first, last)
            out: list[tuple] = []
            for q, doc, at, n, ids, source in zip(queues, cols["doc_id"], cols["at"], cols["n_tokens"], cols["ids"], cols["source"], strict=True):
                lo, state, offsets = known.get(q) or bounds(q, at, at + n)
                wide = np.frombuffer(ids, "<u2").astype("<u4")
                w = int(np.searchsorted(state, at, "right")) - 1
                here = at
                while here < at + n:
                    stop = min(at + n, int(state[w + 1]))
                    if stop > here:
                        part = wide[here - at: stop - at]
                        out.append((doc, source[1:] if source else None, here - at, stop - here, n, lo + w,
                                    int(offsets[w]) + here - int(state[w]), part.tobytes()))
                    here, w = max(here, stop), w + 1
                if len(out) >= 20_000:
                    yield _batch(out, schema)
                    out = []
            yield _batch(out, schema)

    return placed.mapInArrow(run, "doc_id long, source string, start long, length long, doc_tokens long, "
                                  "sequence_id long, offset long, ids binary")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], f.type) for j, f in enumerate(schema)], schema=schema)


def _window_of(plan: Schedule, q: int, at: int, size: int, total: int) -> int:
    """The window that holds token ``at`` of queue ``q``: bisection over the closed form."""
    lo, hi = 0, max(0, -(-total // size) - 1)
    while lo < hi:
        mid = (lo + hi) // 2
        if plan.served(np.array([min((mid + 1) * size, total)]))[0, q] > at:
            hi = mid
        else:
            lo = mid + 1
    return lo
