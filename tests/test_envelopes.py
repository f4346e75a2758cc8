import json

from postalspark.sources.envelopes import explode_envelope, route_events


def route_py(event: str) -> str:
    """Brute force: the handler's dispatch on a parsed event."""
    try:
        e = json.loads(event)
    except ValueError:
        return "malformed"
    if not isinstance(e, dict):
        return "malformed"
    if "Records" in e:
        recs = e["Records"]
        if not recs or not isinstance(recs[0], dict):
            return "invalid"
        first = recs[0]
        if "s3" in first:
            return "s3"
        if "eventSource" in first and first["eventSource"] == "aws:sqs":
            return "sqs"
        return "unrouted"
    if "httpMethod" in e or "requestContext" in e:
        return "http"
    return "scheduled"


def test_route_events(spark):
    events = ['{"Records":[{"s3":{"bucket":{"name":"b"},"object":{"key":"k.csv"}}}]}',
              '{"Records":[{"eventSource":"aws:sqs","body":"{}"}]}', '{"Records":[{"eventSource":"aws:sns"}]}',
              '{"Records":[]}', '{"httpMethod":"GET"}', '{"requestContext":{}}', '{"source":"aws.events"}',
              '{bad', '[1]', '{"Records":[{"s3":null}]}']
    df = spark.createDataFrame([(i, e) for i, e in enumerate(events)], "seq long, event string")
    got = {r.seq: r.route for r in route_events(df).collect()}
    assert got == {i: route_py(e) for i, e in enumerate(events)}


def test_explode_envelope(spark):
    def env(*bodies):
        return json.dumps({"Records": [{"eventSource": "aws:sqs", "body": b} for b in bodies]})
    rows = [(1, env('{"cep": "01310-100"}', '{"cep": " 0100 1900"}', '{"cep": "123"}', '{"other": 1}')),
            (2, env('{"cep": "abcdefgh"}', '{bad')), (3, env())]
    df = spark.createDataFrame(rows, "envelope_id long, envelope string")
    got = sorted((r.envelope_id, r.cep) for r in explode_envelope(df).collect())
    assert got == [(1, "01001900"), (1, "01310100"), (2, "abcdefgh")]
