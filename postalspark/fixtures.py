"""Derived input views over the driver tables.

Each view is plain SQL over the parquet tables, valid in Spark SQL and in
DuckDB, so the Spark operators and the DuckDB oracles start from identical
rows. Where the two dialects differ (integer division, ordered aggregation)
the view carries one text per engine. Every view grows with its base tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations"]

_CODE_OF = "lpad(CAST(({k} * 65537) % 100000000 AS STRING), 8, '0')"

SHARED_SQL: dict[str, str] = {
    # codes as they arrive: hyphen, blanks, short, letters, null, long, inner space, clean
    "raw_codes": """
SELECT o_orderkey AS row_id,
 CASE o_orderkey % 10 WHEN 0 THEN substr(c8,1,5) || '-' || substr(c8,6,3) WHEN 1 THEN '  ' || c8 || ' '
  WHEN 2 THEN substr(c8,1,7) WHEN 3 THEN 'abc' || substr(c8,1,5) WHEN 4 THEN NULL WHEN 5 THEN c8 || '9'
  WHEN 6 THEN substr(c8,1,4) || ' ' || substr(c8,5,4) ELSE c8 END AS cep
 FROM (SELECT o_orderkey, """ + _CODE_OF.format(k="o_custkey") + """ AS c8 FROM orders) t""",
    # lookup directory: code unique, 1 in 13 not found
    "directory": """
SELECT """ + _CODE_OF.format(k="c_custkey") + """ AS code, c_custkey,
 c_name AS logradouro, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS bairro, n_name AS localidade,
 substr('SPRJMGBAPRSCRSPEESGO', 1 + 2 * (c_nationkey % 10), 2) AS uf, CAST(n_nationkey AS STRING) AS ibge,
 c_custkey % 13 = 0 AS erro
 FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    # raw lookup responses: found, not-found (also by a string), non-object, malformed bodies, text after the object
    "responses": """
SELECT code, CASE WHEN erro THEN '{"erro": true}' WHEN c_custkey % 29 = 0 THEN '[1]' WHEN c_custkey % 31 = 0 THEN '{bad'
 WHEN c_custkey % 37 = 0 THEN '{"erro": "false"}' WHEN c_custkey % 41 = 0 THEN '{"cep":"' || code || '","localidade":"x","uf":"SP"} xyz'
 ELSE '{"cep":"' || substr(code,1,5) || '-' || substr(code,6,3) || '","logradouro":"' || logradouro
  || '","complemento":"","bairro":"' || bairro || '","localidade":"' || localidade || '","uf":"' || uf
  || '","ibge":"' || ibge || '"}' END AS body FROM directory""",
    # the same responses twice per code: an older and a newer version
    "responses_versions": """
SELECT code, CASE WHEN substr(code, 8, 1) IN ('0','2','4','6','8') THEN 1 ELSE 3 END AS seq, body FROM responses
UNION ALL
SELECT code, 2 AS seq, replace(body, '"logradouro":"', '"logradouro":"Updated ') AS body FROM responses""",
    # queue messages with their lookup outcome; some malformed or with text after the object, some without a code
    "messages": """
SELECT event_id AS seq, ts, user_id AS consumer, event_type <> 'error' AS ok,
 CASE WHEN event_id % 17 = 0 THEN '{bad' WHEN event_id % 19 = 0 THEN '{"other":1}'
  WHEN event_id % 23 = 0 THEN '{"cep":"' || """ + _CODE_OF.format(k="user_id") + """ || '"} xyz'
 ELSE '{"cep":"' || """ + _CODE_OF.format(k="user_id") + """ || '"}' END AS body FROM events""",
    # error log before classification
    "failures": """
SELECT event_id AS seq, """ + _CODE_OF.format(k="user_id") + """ AS cep, ts,
 CASE event_id % 6 WHEN 0 THEN 'Request timeout' WHEN 1 THEN 'CEP not found (404)' WHEN 2 THEN 'HTTP 500'
  WHEN 3 THEN 'Timeout: not found' WHEN 4 THEN '404 Client Error' ELSE 'Connection reset' END AS error_message,
 CASE WHEN event_id % 6 = 2 THEN 500 ELSE NULL END AS status_code FROM events WHERE event_type = 'error'""",
    # lookup attempt log: failures numbered per code in arrival order
    "attempts": """
SELECT seq, cep, ts, error_message, status_code,
 row_number() OVER (PARTITION BY cep ORDER BY seq) AS attempt FROM failures""",
    # crawled pages: table text, link, text with hyphen, text without, none
    "code_pages": """
SELECT c_custkey AS page_id, 'https://codes.example/pt-br/brasil/sp/sao-paulo/p' || CAST(c_nationkey AS STRING) || '/' AS url,
 CASE c_custkey % 5
  WHEN 0 THEN '<table id="ul_list"><tbody id="tbody_results"><tr><td><a href="/x/">' || h || '</a></td></tr></tbody></table>'
  WHEN 1 THEN '<a href="/pt-br/brasil/cep/' || h || '/">z</a>' WHEN 2 THEN '<p>CEP: ' || h || '</p>'
  WHEN 3 THEN '<p>' || c8 || '</p>' ELSE '<p>none</p>' END AS html
 FROM (SELECT c_custkey, c_nationkey, c8, substr(c8,1,5) || '-' || substr(c8,6,3) AS h FROM
  (SELECT c_custkey, c_nationkey, """ + _CODE_OF.format(k="c_custkey") + """ AS c8 FROM customer) a) b""",
    # everything crawled: the code pages and the raw web pages (ids kept apart)
    "crawl_pages": """
SELECT page_id, url, html FROM code_pages
UNION ALL SELECT -page_id - 1 AS page_id, url, html FROM pages""",
    # pages with area links of every kind the crawl filter must judge
    "area_pages": """
SELECT c_custkey AS page_id, 'https://codes.example/pt-br/brasil/sp/sao-paulo/p' || CAST(c_nationkey AS STRING) || '/' AS url,
 '<ul id="ul_list"><li><a href="/pt-br/brasil/sp/sao-paulo/' || lower(n_name) || '/">' || n_name || '</a></li>'
 || '<li><a href="https://codes.example/pt-br/brasil/sp/sao-paulo/c' || CAST(c_custkey % 50 AS STRING) || '/">c</a></li>'
 || '<li><a href="https://other.example/pt-br/brasil/sp/sao-paulo/x/">x</a></li>'
 || '<li><a href="/pt-br/brasil/cep/01310-100/">cep</a></li></ul>'
 || '<a href="/pt-br/brasil/sp/sao-paulo/logradouro/r' || CAST(c_custkey AS STRING) || '/">r</a>'
 || '<a href="/pt-br/brasil/sp/sao-paulo/">home</a><a href="/blog/">b</a>'
 || '<a href="//codes.example/pt-br/brasil/sp/sao-paulo/sp/">sp</a>'
 || '<a href="pt-br/brasil/sp/sao-paulo/rel' || CAST(c_custkey % 7 AS STRING) || '/">rel</a>'
 || '<a href="../pt-br/brasil/sp/sao-paulo/dot' || CAST(c_custkey % 3 AS STRING) || '/">dot</a>'
 || '<a href="/PT-BR/brasil/SP/Sao-Paulo/Up/">up</a><a href="">empty</a>' AS html
 FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    # a site whose pages link to ten further pages each, with a code in the text
    "site_pages": """
SELECT c_custkey AS page_id, 'https://codes.example/pt-br/brasil/sp/sao-paulo/p' || CAST(c_custkey AS STRING) || '/' AS url,
 '<p>CEP: 0' || substr(CAST(1000000 + c_custkey AS STRING), 2, 4) || '-' || substr(CAST(1000 + c_custkey % 1000 AS STRING), 2, 3) || '</p>'
 || '<a href="/pt-br/brasil/sp/sao-paulo/p' || CAST(10 * c_custkey + -8 AS STRING) || '/">n</a>'
 || '<a href="/pt-br/brasil/sp/sao-paulo/p' || CAST(10 * c_custkey + -7 AS STRING) || '/">n</a>'
 || '<a href="/pt-br/brasil/sp/sao-paulo/p' || CAST(10 * c_custkey + -6 AS STRING) || '/">n</a>'
 || '<a href="/pt-br/brasil/sp/sao-paulo/p' || CAST(10 * c_custkey + -5 AS STRING) || '/">n</a>'
 || '<a href="/pt-br/brasil/sp/sao-paulo/p' || CAST(10 * c_custkey + -4 AS STRING) || '/">n</a>'
 || '<a href="/pt-br/brasil/sp/sao-paulo/p' || CAST(10 * c_custkey + -3 AS STRING) || '/">n</a>'
 || '<a href="/pt-br/brasil/sp/sao-paulo/p' || CAST(10 * c_custkey + -2 AS STRING) || '/">n</a>'
 || '<a href="/pt-br/brasil/sp/sao-paulo/p' || CAST(10 * c_custkey + -1 AS STRING) || '/">n</a>'
 || '<a href="/pt-br/brasil/sp/sao-paulo/p' || CAST(10 * c_custkey + 0 AS STRING) || '/">n</a>'
 || '<a href="/pt-br/brasil/sp/sao-paulo/p' || CAST(10 * c_custkey + 1 AS STRING) || '/">n</a>'
 || '<a href="/pt-br/brasil/sp/sao-paulo/p1/">first</a>' AS html
 FROM customer""",
    # crawl graph: base -> regions -> nations -> suppliers, and a cycle back to base
    "links": """
SELECT 'base' AS src, 'r' || CAST(r_regionkey AS STRING) AS dst FROM region
 UNION ALL SELECT 'r' || CAST(n_regionkey AS STRING), 'n' || CAST(n_nationkey AS STRING) FROM nation
 UNION ALL SELECT 'n' || CAST(s_nationkey AS STRING), 's' || CAST(s_suppkey AS STRING) FROM supplier
 UNION ALL SELECT 'n' || CAST(n_nationkey AS STRING), 'base' FROM nation""",
    # handler events of every shape the router must tell apart
    "handler_events": """
SELECT seq, CASE seq % 6
 WHEN 0 THEN '{"Records":[{"s3":{"bucket":{"name":"uploads"},"object":{"key":"codes/' || CAST(seq AS STRING) || '.csv"}}}]}'
 WHEN 1 THEN '{"Records":[{"eventSource":"aws:sqs","body":"{}"}]}'
 WHEN 2 THEN '{"httpMethod":"POST","body":"{}"}'
 WHEN 3 THEN '{"requestContext":{"stage":"prod"},"body":"{}"}'
 WHEN 4 THEN '{"Records":[{"eventSource":"aws:sns","Sns":{}}]}'
 ELSE '{"source":"aws.events","detail-type":"Scheduled Event"}' END AS event
 FROM messages""",
    # database URLs with credentials, derived from page URLs
    "db_urls": """
SELECT page_id, CASE page_id % 4
 WHEN 0 THEN 'postgresql://user' || CAST(page_id AS STRING) || ':secret' || CAST(page_id AS STRING) || '@' || substr(url, 9)
 WHEN 1 THEN 'postgresql://reader@db' || CAST(page_id AS STRING) || '.example:5432/codes'
 WHEN 2 THEN url
 ELSE 'amqp://guest:guest@queue' || CAST(page_id AS STRING) || ':5672/' END AS url
 FROM pages""",
}

# Views whose text differs between the engines.
SPARK_SQL: dict[str, str] = {
    # queue batches of ten messages wrapped like a queue-triggered handler event
    "envelopes": """
SELECT seq DIV 10 AS envelope_id,
 '{"Records":[' || array_join(transform(array_sort(collect_list(named_struct('seq', seq,
   'rec', to_json(named_struct('eventSource', 'aws:sqs', 'body', body))))), x -> x.rec), ',') || ']}' AS envelope
 FROM messages GROUP BY seq DIV 10""",
}
DUCKDB_SQL: dict[str, str] = {
    "envelopes": """
SELECT seq // 10 AS envelope_id,
 '{"Records":[' || string_agg(to_json({'eventSource': 'aws:sqs', 'body': body}), ',' ORDER BY seq) || ']}' AS envelope
 FROM messages GROUP BY seq // 10""",
}

# Which views each view reads (for CTE ordering).
DEPENDS: dict[str, list[str]] = {
    "responses": ["directory"],
    "responses_versions": ["responses"],
    "attempts": ["failures"],
    "crawl_pages": ["code_pages"],
    "handler_events": ["messages"],
    "envelopes": ["messages"],
}

ALL_VIEWS = list(SHARED_SQL) + list(SPARK_SQL)


def _sql(name: str, engine: str) -> str:
    if name in SHARED_SQL:
        return SHARED_SQL[name]
    return (SPARK_SQL if engine == "spark" else DUCKDB_SQL)[name]


def _closure(names) -> list[str]:
    ordered: list[str] = []

    def visit(n: str) -> None:
        for d in DEPENDS.get(n, []):
            visit(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        visit(n)
    return ordered


# Driver tables each view reads.
TABLES_OF: dict[str, list[str]] = {
    "raw_codes": ["orders"], "directory": ["customer", "nation"], "messages": ["events"],
    "failures": ["events"], "code_pages": ["customer"], "site_pages": ["customer"], "crawl_pages": ["pages"], "area_pages": ["customer", "nation"],
    "links": ["region", "nation", "supplier"], "db_urls": ["pages"],
}

# Narrow tables that the views turn into texts: key, and rows that one task takes (pages are made of customers, short texts of the others).
SPREAD = {"customer": ("c_custkey", 20_000), "orders": ("o_orderkey", 100_000), "events": ("event_id", 100_000)}


def spread(df: DataFrame, key: str, rows_per_task: int) -> DataFrame:
    """``df`` dealt by ``key`` so that a task has about ``rows_per_task`` rows; small tables stay as they lie.

    Parquet is read by row groups of up to a million rows. A view may make a kilobyte of text of a row that takes ten bytes in its file,
    so the work on it would rest with as many tasks as there are row groups. Rows are counted from the file footers.
    """
    tasks = -(-df.count() // rows_per_task)
    return df.repartition(tasks, key) if tasks > 1 else df


def register_tables(spark: SparkSession, sf_dir: str, names=None) -> None:
    """Register the parquet tables of ``sf_dir`` as temp views of the same name.

    Always re-registered: another caller may have bound the same names elsewhere.
    """
    sf_dir = sf_dir.rstrip("/")
    for t in names or BASE_TABLES:
        df = spark.read.parquet(f"{sf_dir}/{t}.parquet")
        (spread(df, *SPREAD[t]) if t in SPREAD else df).createOrReplaceTempView(t)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table read straight from parquet."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _attempts(spark: SparkSession) -> DataFrame:
    """Spark form of ``attempts``: the per-code attempt number comes from a bucketed
    running count, so a code holding a third of all failures is not one task."""
    from postalspark.operators.scan import global_row_number
    failures = spark.table("failures")
    numbered = global_row_number(failures, "seq", "attempt", partition_by=["cep"])
    return numbered.select("seq", "cep", "ts", "error_message", "status_code", "attempt")


# Views built with DataFrame operators on the Spark side (same rows as the SQL text).
SPARK_BUILDERS = {"attempts": _attempts}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view as a DataFrame (plans resolve at call time)."""
    needed = sorted({t for n in _closure([name]) for t in TABLES_OF.get(n, [])})
    register_tables(spark, sf_dir, needed)
    for n in _closure([name]):
        df = SPARK_BUILDERS[n](spark) if n in SPARK_BUILDERS else spark.sql(_sql(n, "spark"))
        df.createOrReplaceTempView(n)
    return spark.table(name)


def with_views(body: str, *names: str, ctes: str = "", recursive: bool = False) -> str:
    """DuckDB text: the needed views as CTEs (plus ``ctes``) in front of ``body``."""
    parts = [f"{n} AS ({_sql(n, 'duckdb').strip()})" for n in _closure(names)]
    if ctes.strip():
        parts.append(ctes.strip().rstrip(","))
    head = "WITH RECURSIVE" if recursive else "WITH"
    return f"{head} " + ",\n".join(parts) + f"\n{body}"
