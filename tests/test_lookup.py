from pyspark.sql import functions as F

from postalspark.functions.responses import is_valid_response
from postalspark.operators import lookup as ol
from postalspark.sources.responses import parse_responses

FOUND = ('{"cep": "01310-100", "logradouro": "Avenida Paulista", "complemento": "", "bairro": "Bela Vista", '
         '"localidade": "São Paulo", "uf": "SP", "ibge": "3550308", "gia": "1004", "ddd": "11", "siafi": "7107"}')


def responses(spark, *bodies):
    return spark.createDataFrame([(f"{i:08d}", b) for i, b in enumerate(bodies)], "code string, body string")


def test_parse_statuses(spark):
    df = parse_responses(responses(spark, FOUND, '{"erro": true}', '{"erro": "true"}', "[1]", "{bad", '{"erro": false}'))
    got = [r.status for r in df.orderBy("code").collect()]
    assert got == ["ok", "not_found", "not_found", "not_object", "malformed", "ok"]
    first = df.orderBy("code").first()
    assert (first.cep, first.localidade, first.complemento) == ("01310-100", "São Paulo", "")


def test_parsed_answers_give_what_the_bodies_give(spark):
    resp = responses(spark, FOUND, '{"erro": true}', "[1]", "{bad", FOUND.replace("Paulista", "Nova"))
    codes = spark.createDataFrame([(f"{i:08d}",) for i in (0, 1, 2, 3, 4, 4, 9)], "cep string")
    stored = ol.parsed_answers(resp)
    for look in (lambda r: ol.enrich_codes(codes, r), lambda r: ol.process_codes(codes, r, "2024-01-01 00:00:00"), lambda r: ol.not_found_codes(codes, r)):
        assert sorted(map(str, look(stored).collect())) == sorted(map(str, look(resp).collect()))


def test_response_check(spark):
    df = responses(spark, FOUND, '{"erro": true}', '{"cep": "01310-100"}', "[]", None)
    got = [r[0] for r in df.orderBy("code").select(is_valid_response("body")).collect()]
    assert got == [True, False, False, False, False]


def test_enrich_and_not_found(spark):
    resp = responses(spark, FOUND, '{"erro": true}', "[1]", "{bad")
    codes = spark.createDataFrame([("00000000",), ("00000001",), ("00000002",), ("00000003",), ("99999999",),
                                   ("00000000",)], "cep string")
    got = {r.cep: (r.found, r.status) for r in ol.enrich_codes(codes, resp).collect()}
    assert got == {"00000000": (True, "ok"), "00000001": (False, "not_found"), "00000002": (False, "not_object"),
                   "00000003": (False, "malformed"), "99999999": (False, "absent")}
    errs = {r.cep: (r.error_type, r.context) for r in ol.not_found_codes(codes, resp).collect()}
    assert errs["00000001"] == ("cep_not_found", '{"status_code":"200"}')
    assert errs["00000002"] == ("api_error", "")
    assert errs["00000003"] == ("api_error", '{"retry_attempt":"3"}')
    assert errs["99999999"] == ("cep_not_found", '{"status_code":"404","retry_attempt":"3"}')


def test_process_codes_maps_response(spark):
    resp = responses(spark, FOUND)
    codes = spark.createDataFrame([("00000000",)], "cep string")
    r = ol.process_codes(codes, resp, "2024-01-01 00:00:00").first()
    assert (r.cep, r.logradouro, r.complemento, r.uf) == ("01310100", "Avenida Paulista", None, "SP")


def test_resolve_attempts(spark):
    log = spark.createDataFrame([
        ("a", 1, "Timeout querying CEP a (attempt 1/3)"), ("a", 2, None),
        ("b", 1, "Request timeout"), ("b", 2, "Request timeout"),
        ("c", 1, "CEP c not found in ViaCEP"), ("c", 2, "Request timeout"),
        ("d", 1, "Connection reset by peer"), ("d", 2, "HTTP 500"), ("d", 3, "HTTP 502"), ("d", 4, None),
    ], "cep string, attempt int, error_message string")
    got = {r.cep: (r.attempts, r.outcome, r.error_type, r.waited) for r in ol.resolve_attempts(log, 3).collect()}
    assert got["a"] == (2, "success", None, 2.0)
    assert got["b"] == (2, "failed", "api_timeout", 2.0)
    assert got["c"] == (1, "not_found", "cep_not_found", 0.0)
    assert got["d"] == (3, "failed", "api_error", 4.0 + 4.0)


def test_max_retries_with_two_attempts(spark):
    log = spark.createDataFrame([("b", 1, "Request timeout"), ("b", 2, "Request timeout")],
                                "cep string, attempt int, error_message string")
    r = ol.resolve_attempts(log, 2).first()
    assert (r.attempts, r.outcome) == (2, "failed")


def test_latest_per_code(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "w")],
                               "code string, seq int, body string")
    got = {r.code: r.body for r in ol.latest_per_code(df).collect()}
    assert got == {"a": "z", "b": "w"}


def test_request_status(spark):
    resp = responses(spark, FOUND, '{"erro": true}')
    req = spark.createDataFrame([(1, "0000-0000"), (2, "00000001"), (3, "123"), (4, "99999999")],
                                "row_id long, cep string")
    got = {r.row_id: r.status_code for r in ol.request_status(req, resp).collect()}
    assert got == {1: 200, 2: 404, 3: 400, 4: 404}
    assert F is not None


def test_attempt_numbers_match_row_number(spark, sf_small):
    from postalspark import fixtures as fx
    built = {r.seq: r.attempt for r in fx.view(spark, sf_small, "attempts").collect()}
    sql = spark.sql("SELECT seq, row_number() OVER (PARTITION BY cep ORDER BY seq) AS attempt FROM failures")
    assert built == {r.seq: r.attempt for r in sql.collect()}


def test_broadcast_only_under_the_bound(spark):
    from postalspark.operators.joins import broadcast_if_small, estimated_bytes
    small = spark.range(10)
    assert estimated_bytes(small) > 0
    plan_small = spark.range(1000).join(broadcast_if_small(small, 10**9), "id")._jdf.queryExecution().optimizedPlan().toString()
    plan_big = spark.range(1000).join(broadcast_if_small(small, 1), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan_small.lower() and "broadcast" not in plan_big.lower()


def test_resolve_attempts_matches_retry_loop_model(spark):
    import random
    rnd = random.Random(13)
    msgs = [None, "Request timeout", "CEP x not found in ViaCEP", "Invalid response format for CEP x",
            "Connection reset by peer", "HTTP 500"]
    rows = []
    for c in range(300):
        for a in range(1, rnd.randint(1, 5) + 1):
            rows.append((f"{c:08d}", a, rnd.choice(msgs)))

    def kind(m):
        if m is None:
            return "success"
        low = m.lower()
        if "timeout" in low:
            return "timeout"
        if m.startswith("CEP ") and "not found" in low:
            return "not_found"
        if m.startswith("Invalid response format"):
            return "not_object"
        return "retry"

    def backoff(a, m):
        base = 2.0 ** a
        conn = any(p in (m or "").lower() for p in ["connection refused", "connection aborted", "connection reset",
                                                    "remote end closed", "failed to establish"])
        return min(max(base * 2, 2.0), 60.0) if conn else min(max(base, 1.0), 30.0)

    def model(attempts, n=3):
        waited = 0.0
        last = None
        for a, m in sorted(attempts):
            if a > n:
                break
            last = (a, m)
            if kind(m) in ("success", "not_found", "not_object"):
                return a, kind(m), waited
            if a < n:
                waited += backoff(a, m)
        a, m = last
        return a, "failed", waited - (backoff(a, m) if a < n else 0.0)

    by_cep = {}
    for c, a, m in rows:
        by_cep.setdefault(c, []).append((a, m))
    df = spark.createDataFrame(rows, "cep string, attempt int, error_message string")
    got = {r.cep: (r.attempts, r.outcome, r.waited) for r in ol.resolve_attempts(df, 3).collect()}
    want = {c: model(v) for c, v in by_cep.items()}
    assert got == want
