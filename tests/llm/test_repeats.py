import hashlib
import random

import pytest

from postalspark.llm import repeats

from .plain import docs_frame, edge_rows, repeats_removed


def removed(spark, rows, length):
    got = repeats.remove_repeats(docs_frame(spark, rows), length).collect()
    return sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got)


def wanted(rows, length):
    return sorted((i is not None, i or 0, *rest) for i, *rest in repeats_removed(rows, length))


@pytest.mark.parametrize("seed", range(3))
def test_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    letters = "ab " if seed == 0 else "abcdefghij é"
    passages = ["".join(rng.choice(letters) for _ in range(rng.randrange(20, 400))) for _ in range(6)]
    rows = []
    for i in range(40):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice(letters) for _ in range(rng.randrange(0, 200))) for _ in range(rng.randrange(0, 6))]
        rows.append((i * 3, "".join(parts)))
    rows += [(500, "aaaa" * 200), (501, "xyz" * 300), (502, None), (503, ""), (504, "q" * 99)]
    assert removed(spark, rows, 100) == wanted(rows, 100)


def test_edges_repeated_ids_and_null_ids(spark):
    rows = edge_rows()
    assert removed(spark, rows, 100) == wanted(rows, 100)


def test_all_texts_in_one_group(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh ") for _ in range(1000))
    got = removed(spark, [(i, text) for i in range(300)], 100)
    assert [g[3] for g in got] == [0] + [1000] * 299
    # one letter only: the first text repeats itself but for its first byte
    got = removed(spark, [(i, "a" * 1000) for i in range(300)], 100)
    assert [g[3] for g in got] == [999] + [1000] * 299


def test_empty_table(spark):
    assert repeats.remove_repeats(docs_frame(spark, [])).count() == 0
