import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from postalspark.llm import packing, queries

from .plain import docs_frame, edge_rows


def ids_of(texts):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    return [[*tok.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


TEXTS = ["", " ", "  two  blanks", "a\n b", "a \nb", "x\n\n y", "end ", " start", "don't can't 'll", "é ü ß  wide", "tab\t x", "a  \n  b", "1 2,3 ...", "<|endoftext|> x", "混合 テキスト 🙂 ok", "a" * 3000, " " * 500,
         "caf́e ​ zero", "\x85next \x1c sep"]


def test_segments_give_the_tokenizer_s_ids():
    tok = packing.Tokenizer(packing.default_tokenizer())
    for _ in range(2):  # with and without remembered segments
        for t, want in zip(TEXTS, ids_of(TEXTS)):
            assert [*np.frombuffer(tok.encode(t), "<u2"), 1] == want, repr(t)


def check(pieces, rows, size):
    ids = ids_of([t for _, t, *_ in rows])
    by_doc, windows = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        windows[p.sequence_id].append(p)
    want = defaultdict(list)
    for (i, *_), x in zip(rows, ids):
        want[i].append(x)
    for i, xs in want.items():
        assert sum(p.length for p in by_doc[i]) == sum(map(len, xs))
        if len(xs) == 1:
            at = 0
            for p in sorted(by_doc[i], key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(xs[0])
                assert list(np.frombuffer(p.ids, "<u4")) == xs[0][at: at + p.length]
                at += p.length
    for s, ps in windows.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == size or s == max(windows)
    assert sorted(windows) == list(range(len(windows)))
    return windows


def test_every_window_has_the_target_mixture(spark):
    rows = [(i, " ".join(f"w{(i * 13 + j) % 97}" for j in range(20 + 7 * (i % 11))), "en", "big" if i % 3 else ("mid" if i % 2 else "tiny")) for i in range(120)]
    got = packing.pack(docs_frame(spark, rows), size=128).collect()
    windows = check(got, rows, 128)
    total = defaultdict(int)
    for p in got:
        total[p.source] += p.length
    whole = sum(total.values())
    for s, ps in windows.items():
        if s != max(windows):
            for name, n in total.items():
                assert abs(sum(p.length for p in ps if p.source == name) - 128 * n / whole) <= 2


def test_given_targets_until_a_queue_runs_dry(spark):
    rows = [(i, " ".join(f"w{(i * 13 + j) % 97}" for j in range(60)), "en", "a" if i % 2 else "b") for i in range(80)]
    got = packing.pack(docs_frame(spark, rows), size=100, targets={"a": 3.0, "b": 1.0}).collect()
    windows = check(got, rows, 100)
    first = sum(p.length for p in windows[0] if p.source == "a")
    assert abs(first - 75) <= 1
    assert all(p.source == "b" for p in windows[max(windows)])


def test_edges(spark):
    rows = edge_rows()
    check(packing.pack(docs_frame(spark, rows), size=64).collect(), rows, 64)
    assert packing.pack(docs_frame(spark, [])).count() == 0


def test_query_checksums(spark, sf_small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    ids = dict(zip(texts, ids_of(texts.values())))
    got = queries.op7_packing(spark, sf_small).collect()
    for r in got:
        part = np.array(ids[r.doc_id][r.start: r.start + r.length], "<u4")
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
    assert sum(r.length for r in got) == sum(map(len, ids.values()))


@pytest.mark.parametrize("totals,weights", [([1000, 10, 1], None), ([5, 5, 5, 5], None), ([700, 300, 50], [1.0, 5.0, 2.0]), ([3, 0, 9], [0.0, 1.0, 1.0])])
def test_schedule_is_monotone_and_complete(totals, weights):
    plan = packing.Schedule(totals, weights)
    n = np.arange(0, sum(totals) + 1)
    got = plan.served(n)
    assert (got.sum(1) == n).all() and (np.diff(got, axis=0) >= 0).all() and (got[-1] == totals).all()
