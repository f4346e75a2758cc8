import datetime as dt

from postalspark.functions.errors import classify_error, error_context, is_connection_error, retry_backoff
from postalspark.operators import errors as oe
from postalspark.session import scratch_dir
from postalspark.sinks.files import append_errors, clear_errors
from postalspark.sources.store import filter_errors, read_error_log


def test_classification_order(spark):
    msgs = ["Request timeout", "CEP not found (404)", "HTTP 500", "Timeout: not found", "404 Client Error", "x"]
    df = spark.createDataFrame([(m,) for m in msgs], "m string")
    assert [r[0] for r in df.select(classify_error("m")).collect()] == \
        ["api_timeout", "cep_not_found", "api_error", "api_timeout", "cep_not_found", "api_error"]


def test_context(spark):
    df = spark.createDataFrame([(408, None), (None, 2), (0, 0), (None, None)], "s int, a int")
    got = [r[0] for r in df.select(error_context(status_code=df.s, retry_attempt=df.a)).collect()]
    assert got == ['{"status_code":"408"}', '{"retry_attempt":"2"}', "", ""]


def test_backoff_and_connection_errors(spark):
    df = spark.createDataFrame([(1, "Request timeout"), (2, "Connection refused"), (5, "HTTP 500"), (6, "Connection reset")],
                               "a int, m string")
    got = [(r[0], r[1]) for r in df.select(retry_backoff("a", "m"), is_connection_error("m")).collect()]
    assert got == [(2.0, False), (8.0, True), (30.0, False), (60.0, True)]


def log(spark):
    ts = dt.datetime(2024, 1, 1, 0, 0, 1, 5)
    rows = [("01310100", ts, "Request timeout", None, 1), ("01310100", ts, "database down", None, None),
            ("01001900", ts, "CEP not found (404)", 404, None), ("20040020", ts, "bad format", None, None)]
    df = spark.createDataFrame(rows, "cep string, ts timestamp_ntz, error_message string, status_code int, attempt int")
    return oe.error_log(df)


def test_summary(spark):
    s = oe.error_summary(log(spark)).collect()
    total = [r for r in s if r.level == "total"][0]
    assert (total.errors, total.distinct_ceps) == (4, 3)
    by_cep = {r.cep: r.errors for r in s if r.level == "by_cep"}
    assert by_cep["01310100"] == 2
    by_type = {r.error_type: r.errors for r in s if r.level == "by_type"}
    assert by_type == {"api_timeout": 1, "api_error": 2, "cep_not_found": 1}


def test_write_filter_count_clear(spark):
    path = scratch_dir(spark, "errors")
    assert read_error_log(spark, path).count() == 0  # missing file reads as empty
    append_errors(log(spark), path)
    append_errors(log(spark), path)
    back = read_error_log(spark, path)
    assert back.columns == ["cep", "error_type", "error_message", "timestamp", "context"]
    assert back.count() == 8
    assert filter_errors(back, cep="01310100", error_type="api_timeout").count() == 2
    assert oe.count_errors(back, error_type="cep_not_found").first().error_count == 2
    assert {r.timestamp for r in back.collect()} == {"2024-01-01T00:00:01.000005"}
    clear_errors(spark, path)
    assert read_error_log(spark, path).count() == 0
    assert spark.read.text(path).first().value == "cep,error_type,error_message,timestamp,context"


def test_summary_as_maps(spark):
    r = oe.error_summary_maps(log(spark)).first()
    assert r.total_errors == 4 and r.unique_ceps_with_errors == 3
    assert r.by_type == {"api_timeout": 1, "api_error": 2, "cep_not_found": 1}


def test_typed_error_rows(spark):
    rows = spark.createDataFrame([("01310100", "connection lost")], "cep string, error_message string")
    r = oe.database_errors(rows, "save").first()
    assert (r.error_type, r.context) == ("database_error", '{"operation":"save"}')
    r = oe.validation_errors(rows, "length").first()
    assert (r.error_type, r.context) == ("validation_error", '{"validation_rule":"length"}')
    assert oe.validation_errors(rows).first().context == ""
