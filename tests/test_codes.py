import pytest
from pyspark.sql import functions as F

from postalspark.functions import codes as C
from postalspark.operators import codes as oc
from postalspark.sinks.files import write_csv
from postalspark.sources.codes import read_codes_csv, scan_codes_unvalidated
from postalspark.session import scratch_dir


def one_col(spark, values, name="cep"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"row_id long, {name} string")


def numbered(n):
    """The n-th code of a series of eight digits that starts with 0."""
    return f"{(n * 7_654_321 + 2_468_135) % 10_000_000:08d}"


def hyphened(digits):
    return digits[:5] + "-" + digits[5:]


def test_extract_codes_from_text(spark):
    a, b, c = (numbered(n) for n in range(3))
    texts = {f"ends with {hyphened(a)}": [a], f"{a} begins": [a], f"<{hyphened(a)}>;{b}/{hyphened(c)}.{a}": [a, b, c, a],
             f"nine {a}1, glued x{b}, split {c[:4]}-{c[4:]}": [], "": []}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.c for r in df.select("i", C.extract_codes("t").alias("c")).orderBy("i").collect()]
    assert got == [[hyphened(x) for x in want] for want in texts.values()]


def test_regional_validity_by_first_digit_and_hyphen_place(spark):
    digits = numbered(4)[1:]
    cases = {hyphened(f"{d}{digits}"): d == 0 for d in range(10)}
    whole = "0" + digits
    cases |= {whole[:k] + "-" + whole[k:]: k == 5 for k in range(9)}
    cases |= {whole: False, hyphened(whole)[:-1]: False, hyphened(whole) + "0": False, hyphened(whole)[:-1] + "o": False, " " + hyphened(whole): False}
    df = spark.createDataFrame(list(cases), "string")
    assert {r.value: r.ok for r in df.select("value", C.is_valid_regional("value").alias("ok")).collect()} == cases


def test_mark_valid_by_digit_count_and_region(spark):
    digits = numbered(6)
    good = [str(d) + digits[1:] for d in range(10)] + [hyphened(digits), f"\t{digits}\n", digits[:2] + " " + digits[2:]]
    bad = [digits[:k] for k in range(8)] + [digits + "0", digits[:7] + "x", None]
    df = oc.mark_valid(one_col(spark, good + bad))
    got = {r.row_id: r.is_valid for r in df.collect()}
    assert [got[i] for i in range(len(good + bad))] == [True] * len(good) + [False] * len(bad)
    assert dict(df.dtypes)["is_valid"] == "boolean"


def test_clean_strips_unicode_whitespace_but_keeps_inner_tabs(spark):
    df = one_col(spark, ["  01310-100\t", "0131 0100", "01\t310100"])
    assert [r.c for r in df.select(C.clean_code("cep").alias("c")).orderBy("row_id").collect()] == \
        ["01310100", "01310100", "01\t310100"]


def test_valid_and_invalid_lists_are_cleaned(spark):
    a, b = numbered(8), numbered(9)
    df = one_col(spark, [hyphened(a), f" {b} ", a[1:], None])
    assert sorted(r.cep for r in oc.valid_codes(df).collect()) == sorted([a, b])
    inv = oc.invalid_codes(df).orderBy("row_id").collect()
    assert [r.cep for r in inv] == [a[1:], None]


def test_code_stats(spark):
    df = one_col(spark, [numbered(n) for n in range(6)] + [numbered(6)[:k] for k in (3, 7)])
    r = oc.code_stats(df).first()
    assert (r.total, r.valid, r.invalid) == (8, 6, 2)


def test_code_length_check_is_length_only(spark):
    df = one_col(spark, ["abcdefgh", "01310-100", "0131 0100", "0131010", None, ""])
    got = [r[0] for r in df.orderBy("row_id").select(C.is_code_length("cep")).collect()]
    assert got == [True, True, True, False, False, False]


def test_format_code_round_trip(spark):
    df = spark.createDataFrame([("01310100",)], "cep string")
    r = df.select(C.hyphenate("cep").alias("h"), C.dehyphenate(C.hyphenate("cep")).alias("d")).first()
    assert (r.h, r.d) == ("01310-100", "01310100")


def test_sample_invalid_first_five_and_count(spark):
    vals = ["bad%d" % i if i % 2 else "0100190%d" % (i % 10) for i in range(20)]
    df = one_col(spark, vals)
    got = oc.sample_invalid(df).orderBy("row_id").collect()
    assert [r.row_id for r in got] == [1, 3, 5, 7, 9]
    assert {r.invalid_count for r in got} == {10}


def test_unvalidated_scan_keeps_unvalidated_values(spark):
    df = one_col(spark, ["01310-100", "", None, "abc-1"])
    assert sorted(r.cep for r in scan_codes_unvalidated(df).collect()) == ["01310100", "abc1"]


def test_number_batches_matches_brute_force(spark):
    ids = list(range(5, 5000, 7))
    df = spark.createDataFrame([(i, "x") for i in ids], "row_id long, cep string")
    got = {r.row_id: r.batch for r in oc.number_batches(df, 120).collect()}
    assert got == {rid: pos // 120 for pos, rid in enumerate(ids)}
    assert oc.batch_size_for(2.0) == 120


def test_csv_reader_checks(spark):
    missing = scratch_dir(spark, "missing")
    with pytest.raises(FileNotFoundError):
        read_codes_csv(spark, missing)
    header_only = write_csv(spark.createDataFrame([], "cep string").coalesce(1), "h")
    with pytest.raises(ValueError):
        read_codes_csv(spark, header_only)
    no_cep = write_csv(spark.createDataFrame([("1", "a")], "code string, name string"), "nc")
    with pytest.raises(ValueError):
        read_codes_csv(spark, no_cep)
    codes = sorted(numbered(n) for n in range(20))
    ok = write_csv(spark.createDataFrame([(c,) for c in codes], "cep string"), "ok")
    df = read_codes_csv(spark, ok)
    assert sorted(r.cep for r in df.collect()) == codes
    assert dict(df.dtypes)["cep"] == "string"


def test_cap_and_sort(spark):
    codes = [hyphened(numbered(n)) for n in (5, 2, 7, 2, 0)]
    df = spark.createDataFrame([(c,) for c in codes], "cep string")
    assert [r.cep for r in oc.cap_codes(df, 2).collect()] == sorted(set(codes))[:2]
    assert [r.cep for r in oc.sort_codes(df).collect()] == sorted(set(codes))
    assert F is not None


def test_validation_matches_python_model_on_random_strings(spark):
    import random
    rnd = random.Random(5)
    alphabet = list("0123456789") * 4 + ["-", " ", "\t", "\n", "\x0b", "\x1c", "\x85", "\xa0", " ", "　",
                                         "a", "Z", "_", "."]
    values = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]

    def model(c):
        if not c:
            return False
        s = c.strip().replace("-", "").replace(" ", "")
        return len(s) == 8 and all("0" <= ch <= "9" for ch in s)

    def model_clean(c):
        return c.strip().replace("-", "").replace(" ", "")

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "row_id long, cep string")
    got = {r.row_id: (r.v, r.c) for r in df.select("row_id", C.is_valid_code("cep").alias("v"),
                                                   C.clean_code("cep").alias("c")).collect()}
    bad = [(values[i], got[i]) for i in range(len(values)) if got[i] != (model(values[i]), model_clean(values[i]))]
    assert not bad, bad[:5]


def test_extraction_matches_python_findall_on_random_text(spark):
    import random
    import re
    rnd = random.Random(9)
    alphabet = list("0123456789") * 5 + list("-- ,.:ab_X/\n")
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(2000)]

    def model(t):
        out = []
        for m in re.findall(r"\b[0-9]{5}-?[0-9]{3}\b", t):
            d = m.replace("-", "")
            out.append(f"{d[:5]}-{d[5:]}")
        return out

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = {r.i: r.c for r in df.select("i", C.extract_codes("t").alias("c")).collect()}
    bad = [(texts[i], got[i]) for i in range(len(texts)) if got[i] != model(texts[i])]
    assert not bad, bad[:5]
