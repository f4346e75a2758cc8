import hashlib
import random
import re

import pytest

from postalspark.llm import pii, queries

from .plain import docs_frame, edge_rows

KINDS = ("email", "ip", "card", "phone")


def luhn(digits):
    double = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in double) % 10 == 0


def plain(t):
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) < 256 for x in m[0].split("."))]
    for kind, pattern, low, high in (("card", r"[0-9]([\x20-]?[0-9])+", 14, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 10, 15)):
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m[0])
            if low <= len(d) <= high and (kind == "phone" or luhn(d)):
                out.append((kind, m))
    return sorted(((k, m.start(), m.end()) for k, m in out), key=lambda x: (x[1], KINDS.index(x[0])))


def test_base_spans_match_the_plain_patterns():
    rng = random.Random(8)
    letters = "a1.@+- ()5%_é"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 80))) for _ in range(4000)]
    texts += ["a@b.c_x@d.e", "4111 1111 1111 1111", "4111-1111-1111-1111 1", "1.2.3.4.5.6.7.8", "256.1.1.1", "+1 (017) 555-7713", "001.002.003.004", "x" * 5000 + "@a.b", "1" * 5000]
    for t in texts:
        assert pii.find_spans(t)[0] == plain(t), t


@pytest.mark.parametrize("text,kind,found", [
    ("write joe (at) example (dot) com now", "email", "joe (at) example (dot) com"),
    ("jim at example dot co dot uk!", "email", "jim at example dot co dot uk"),
    ("x jоhn@exаmple.com y", "email", "jоhn@exаmple.com"),
    ("ｂｏｂ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｂｏｂ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("host １９２.168.0.1 up", "ip", "１９２.168.0.1"),
    ("call plus one five five five one two three four five six seven now", "phone", "plus one five five five one two three four five six seven"),
    ("card four one one one one one one one one one one one one one one one.", "card", "four one one one one one one one one one one one one one one one"),
    ("ping 10 dot 0 dot 12 dot 255 now", "ip", "10 dot 0 dot 12 dot 255"),
    ("p.q [at] r.example [.] org", "email", "p.q [at] r.example [.] org"),
])
def test_disguises_map_back_to_the_source(text, kind, found):
    base, added = pii.find_spans(text)
    assert [(k, text[a:b]) for k, a, b in added] == [(kind, found)]
    assert pii.mask_text(text) == text.replace(found, f"[{kind.upper()}]")


@pytest.mark.parametrize("text,kind,found", [
    ("ping 192 dot one six eight dot zero dot one now", "ip", "192 dot one six eight dot zero dot one"),
    ("ping one nine two dot one six eight dot 0 dot one two now", "ip", "one nine two dot one six eight dot 0 dot one two"),
    ("host 192.168 dot 0 dot 1 up", "ip", "192.168 dot 0 dot 1"),
    ("host 10 [.] 0.0 (dot) 7 up", "ip", "10 [.] 0.0 (dot) 7"),
    ("call plus four nine 30 1234 5678 now", "phone", "plus four nine 30 1234 5678"),
    ("call +49 three zero 1234 5678 now", "phone", "+49 three zero 1234 5678"),
    ("write jane.doe42 at example.com now", "email", "jane.doe42 at example.com"),
    ("write jane at mail dot gr now", "email", "jane at mail dot gr"),
    ("write jane at firma dot ro now", "email", "jane at firma dot ro"),
    ("write jane_d at firma dot gr now", "email", "jane_d at firma dot gr"),
])
def test_mixed_disguises(text, kind, found):
    base, added = pii.find_spans(text)
    assert [(k, text[a:b]) for k, a, b in added] == [(kind, found)]
    assert pii.mask_text(text) == text.replace(found, f"[{kind.upper()}]")


@pytest.mark.parametrize("text", ["one at 10.5 or two at 3.5", "version 2 at 1.4.2 has one dot two", "plus one more for 2019", "we met at three dot four points", "one two dot three"])
def test_numbers_in_sentences_stay(text):
    assert pii.find_spans(text) == ([], [])


@pytest.mark.parametrize("text", ["meet at example.com today", "two three words at a dot on the map", "one two", "Привет мир как дела", "α β γ", "at dot at dot", "", None,
                                  "the cat sat at noon. Dot said so."])
def test_clean_texts_stay(text):
    assert pii.find_spans(text) == ([], [])
    assert pii.mask_text(text) == text


def test_query_and_mask_over_edge_rows(spark, sf_small):
    d = docs_frame(spark, edge_rows() + [(70, "a@b.de and a@b.de"), (71, "mail x (at) y (dot) de, z@w.fr")])
    out = pii.mask(d)
    assert out.columns == d.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[70].text == "[EMAIL] and [EMAIL]" and got[70].n_chars == len(got[70].text) and got[3].text is None
    assert pii.find(d).count() == d.count() and pii.find(docs_frame(spark, [])).count() == 0
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    for r in queries.op4_pii(spark, sf_small).collect():
        base = plain(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for x, _, _ in base) for k in KINDS)
        assert set(joined.split(",")) <= set(r.spans.split(","))


@pytest.mark.parametrize("text,kind", [
    ("jane dot doe arroba mail punto es", "email"), ("j.doe42 (arobase) mail [point] fr", "email"), ("max klammeraffe firma punkt de", "email"),
    ("null eins zwei drei vier fünf sechs sieben acht neun", "phone"), ("cero uno dos tres cuatro cinco seis siete ocho nueve", "phone"),
    ("zéro un deux trois quatre cinq six sept huit neuf", "phone"), ("four one one one 1111 1111 1111", "card"),
    (" dot ".join("abcdefgh") + " at " + " dot ".join(["mail"] * 9) + " dot org", "email")])
def test_disguises_in_four_languages_and_long_ones(text, kind):
    found = pii.find_spans("see " + text + ", please")[1]
    assert [(k, a, b) for k, a, b in found] == [(kind, 4, 4 + len(text))]


@pytest.mark.parametrize("text", ["Ask bob42 at noon.Then go", "file_a at foo.bar x", "the point at issue is a point in time", "un deux trois", "uno de los dos puntos"])
def test_prose_is_left_alone(text):
    assert pii.find_spans(text) == ([], [])


@pytest.mark.parametrize("unit", ["192 dot 168 dot 0 dot 1 and a at b dot com, ", "four one one one 1111 1111 1111 x ", "a dot a dot a dot ", "one two three four five six seven eight nine zero, "])
def test_a_megabyte_takes_linear_time(unit):
    import time
    t = time.time()
    pii.find_spans(unit * (1_000_000 // len(unit)))
    assert time.time() - t < 20
