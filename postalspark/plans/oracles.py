"""DuckDB statements of the registered queries (the correctness oracles).

Each text restates an operator's semantics in plain SQL over the same derived
views, independently of the Spark code path. Queries with no entry here
(side-effect sinks, streams) are checked by row count and by their own tests.
"""

from __future__ import annotations

from urllib.parse import urlsplit

from postalspark.fixtures import with_views as W
from postalspark.plans.catalog import (CITY, ERROR_TYPE, MAX_CODES, NOW, PAGE_LIMIT, PAGE_OFFSET, POINT_CODE,
                                       PROCESS_LIMIT, SITE, STATE)
from postalspark.schemas import (ADDRESS_FIELDS, CONNECTION_ERROR_PHRASES, DEFAULT_SERVICE_URL, MSG_HTTP_404,
                                 MSG_MALFORMED, MSG_NOT_FOUND, MSG_NOT_OBJECT, SKIPPED_LINK_PARTS)

# Pattern texts of the statements, for DuckDB's engine; the Spark side has its own.
WS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
CODE_IN_TEXT = r"\b[0-9]{5}-?[0-9]{3}\b"
CODE_IN_HREF = r"/cep/([0-9]{5}-[0-9]{3})/"
A_HREF = r'(?is)<a\s(?:[^>]*?\s)?href\s*=\s*"([^"]*)"'
A_HREF_TEXT = r'(?is)<a\s(?:[^>]*?\s)?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a>'
CODE_TABLE = r'(?is)<table\b[^>]*\bid\s*=\s*"ul_list"[^>]*>(.*?)</table>'
CODE_TBODY = r'(?is)<tbody\b[^>]*\bid\s*=\s*"tbody_results"[^>]*>(.*?)</tbody>'
TABLE_ROW = r"(?is)<tr\b[^>]*>(.*?)</tr>"
FIRST_CELL = r"(?is)<td\b[^>]*>(.*?)</td>"
NON_TEXT_BLOCKS = (r"(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>"
                   r"|<template\b[^>]*>.*?</template>|<!--.*?-->|<!doctype[^>]*>")
ANY_TAG = r"<[^>]*>"
NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&")]


# ------------------------------------------------------------------ scalar snippets
def clean(x):
    return f"replace(replace(regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g'), '-', ''), ' ', '')"


def valid(x):
    return f"coalesce(regexp_matches({clean(x)}, '^[0-9]{{8}}$'), false)"


def regional(x):
    return f"coalesce(regexp_matches({x}, '^[0-9]{{5}}-[0-9]{{3}}$') AND starts_with({x}, '0'), false)"


def hyph(x):
    return f"(substr({x}, 1, 5) || '-' || substr({x}, 6, 3))"


def codelen(x):
    return f"coalesce(length(replace(replace({x}, '-', ''), ' ', '')) = 8, false)"


def decode(x):
    for ent, ch in ENTITIES:
        lit = ch.replace("'", "''")
        x = f"replace({x}, '{ent}', '{lit}')"
    return x


def visible(x):
    return decode(f"regexp_replace(regexp_replace({x}, '{NON_TEXT_BLOCKS}', '', 'g'), '{ANY_TAG}', '', 'g')")


def jt(b):
    return f"(CASE WHEN json_valid({b}) THEN json_type({b}) END)"


def jfield(b, f):
    return f"(CASE WHEN {jt(b)} = 'OBJECT' THEN json_extract_string({b}, '$.{f}') END)"


def erro(b):
    e = jfield(b, "erro")
    kind = f"(CASE WHEN {jt(b)} = 'OBJECT' THEN json_type({b}, '$.erro') END)"
    return (f"coalesce(CASE WHEN {kind} = 'VARCHAR' THEN {e} <> '' ELSE {e} NOT IN ('false', '', '[]', '{{}}') "
            f"AND NOT regexp_matches({e}, '^-?0*\\.?0*([eE][-+]?[0-9]+)?$') END, false)")


def status(b):
    return (f"(CASE WHEN {jt(b)} = 'OBJECT' AND {erro(b)} THEN 'not_found' WHEN {jt(b)} = 'OBJECT' THEN 'ok' "
            f"WHEN json_valid({b}) THEN 'not_object' ELSE 'malformed' END)")


def classify(m):
    return (f"(CASE WHEN contains(lower({m}), 'timeout') THEN 'api_timeout' "
            f"WHEN contains(lower({m}), 'not found') OR contains({m}, '404') THEN 'cep_not_found' ELSE 'api_error' END)")


def conn_err(m):
    return "coalesce(" + " OR ".join(f"contains(lower({m}), '{p}')" for p in CONNECTION_ERROR_PHRASES) + ", false)"


def backoff(a, m):
    base = f"(1.0 * pow(2.0, {a}))"
    return (f"(CASE WHEN {conn_err(m)} THEN least(greatest({base} * 2.0, 2.0), 60.0) "
            f"ELSE least(greatest({base}, 1.0), 30.0) END)")


def context(**kv):
    items, oks = [], []
    for k, v in kv.items():
        ok = f"({v} IS NOT NULL AND CAST({v} AS VARCHAR) NOT IN ('', '0'))"
        oks.append(ok)
        items.append(f"CASE WHEN {ok} THEN '\"{k}\":\"' || CAST({v} AS VARCHAR) || '\"' END")
    return f"(CASE WHEN {' OR '.join(oks)} THEN '{{' || concat_ws(',', {', '.join(items)}) || '}}' ELSE '' END)"


def iso(ts):
    return (f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || "
            f"CASE WHEN strftime({ts}, '%f') <> '000000' THEN '.' || strftime({ts}, '%f') ELSE '' END)")


def c14_cols(b):
    cep = f"replace(replace(coalesce({jfield(b, 'cep')}, ''), '-', ''), ' ', '')"
    return [f"{cep} AS cep"] + [f"nullif({jfield(b, f)}, '') AS {f}" for f in ADDRESS_FIELDS[1:]]


def area_link(h):
    low = f"lower({h})"
    rest = f"substr({h}, strpos({h}, '://') + 3)"
    path = (f"(CASE WHEN strpos({h}, '://') > 0 THEN (CASE WHEN strpos({rest}, '/') > 0 "
            f"THEN substr({rest}, strpos({rest}, '/')) ELSE '/' END) "
            f"WHEN starts_with({h}, '/') THEN {h} ELSE '/' || {h} END)")
    parts = f"list_filter(string_split({path}, '/'), lambda p: p <> '')"
    idx = f"coalesce(list_position({parts}, 'sao-paulo'), 0)"
    nxt = f"(CASE WHEN {idx} > 0 THEN {parts}[{idx} + 1] END)"
    skips = " OR ".join(f"contains({low}, '{p}')" for p in ["/cep/", "/logradouro/"] + SKIPPED_LINK_PARTS)
    rejected = f"({skips} OR regexp_matches({low}, '/sao-paulo/*$') OR NOT contains({low}, '/sao-paulo/'))"
    ok = (f"(length({h}) > 0 AND NOT {rejected} AND {idx} > 0 AND {nxt} IS NOT NULL AND {nxt} NOT IN ('', 'sp') "
          f"AND (list_contains({parts}, 'pt-br') OR list_contains({parts}, 'brasil')))")
    return f"coalesce({ok}, false)"


def resolve(h, base):
    b = urlsplit(base)
    own = f"{b.scheme.lower()}:"
    orig = h
    rest = f"substr({h}, {len(own) + 1})"
    h = (f"(CASE WHEN lower(substr({h}, 1, {len(own)})) = '{own}' AND (NOT starts_with({rest}, '//') "
         f"OR starts_with({rest}, '///')) THEN {rest} ELSE {h} END)")
    h = f"(CASE WHEN starts_with({h}, '///') THEN substr({h}, 3) ELSE {h} END)"
    origin = f"{b.scheme}://{b.netloc}"
    parts = b.path.split("/")
    if parts[-1] != "":
        parts = parts[:-1]
    path = f"regexp_extract({h}, '^([^?#]*)', 1)"
    query = f"regexp_extract({h}, '^[^?#]*[?]([^#]*)', 1)"
    frag = f"regexp_extract({h}, '^[^#]*#(.*)$', 1)"

    def tail(q):
        return (f"(CASE WHEN {q} <> '' THEN '?' || {q} ELSE '' END || "
                f"CASE WHEN {frag} <> '' THEN '#' || {frag} ELSE '' END)")

    segs = f"string_split({path}, '/')"

    def dots(seglist):
        red = (f"list_reduce({seglist}, lambda acc, s: CASE WHEN s = '..' THEN acc[1:len(acc) - 1] "
               f"WHEN s = '.' THEN acc ELSE list_append(acc, s) END, []::VARCHAR[])")
        res = f"(CASE WHEN {seglist}[-1] IN ('.', '..') THEN list_append({red}, '') ELSE {red} END)"
        return f"array_to_string({res}, '/')"

    base_list = "[" + ", ".join(f"'{p}'" for p in parts[1:]) + "]::VARCHAR[]"
    middle = f"list_filter(list_concat({base_list}, {segs}[1:len({segs}) - 1]), lambda s: s <> '')"
    rel = f"list_concat(['{parts[0]}']::VARCHAR[], {middle}, [{segs}[-1]])"

    def with_origin(p):
        return f"('{origin}/' || regexp_replace({p}, '^/', '') || {tail(query)})"

    scheme_of = f"lower(regexp_extract({h}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"
    after_scheme = f"regexp_extract({h}, '^[A-Za-z][A-Za-z0-9+.-]*:([^?#]*)', 1)"
    no_path_query = f"(CASE WHEN {query} <> '' THEN {query} ELSE '{b.query}' END)"
    is_scheme = f"regexp_matches({h}, '^[A-Za-z][A-Za-z0-9+.-]*:')"
    return (f"(CASE WHEN {orig} IS NULL THEN NULL WHEN {orig} = '' THEN '{base}' "
            f"WHEN {is_scheme} AND {scheme_of} = '{b.scheme.lower()}' THEN '{b.scheme}:' || {after_scheme} || {tail(query)} "
            f"WHEN {is_scheme} THEN {h} "
            f"WHEN starts_with({h}, '//') THEN '{b.scheme}:' || {path} || {tail(query)} "
            f"WHEN {path} = '' THEN '{origin}{b.path}' || {tail(no_path_query)} "
            f"WHEN starts_with({h}, '/') THEN {with_origin(dots(segs))} "
            f"ELSE {with_origin(dots(rel))} END)")


def same_host(u, base):
    return f"coalesce(regexp_extract({u}, '{NETLOC}', 1) = '{urlsplit(base).netloc}', false)"


# ------------------------------------------------------------------ reusable CTEs
TS_NOW = f"TIMESTAMP '{NOW}'"

ADDRESSES = f"""addresses AS (SELECT {', '.join(c14_cols('body'))}, {TS_NOW} AS created_at, {TS_NOW} AS updated_at
 FROM responses WHERE {status('body')} = 'ok')"""

PARSED = f"""parsed AS (SELECT code, {status('body')} AS status, {', '.join(f"{jfield('body', f)} AS {f}" for f in ADDRESS_FIELDS)}
 FROM responses)"""

F1 = f"f1 AS (SELECT row_id, {clean('cep')} AS cep FROM raw_codes WHERE {valid('cep')})"

ELOG = f"""elog AS (SELECT seq, cep, {classify('error_message')} AS error_type, error_message, {iso('ts')} AS timestamp,
 {context(status_code='status_code', retry_attempt='attempt')} AS context FROM attempts)"""

KEPT = f"""kept AS (SELECT seq, ts, consumer, ok, {jfield('body', 'cep')} AS cep FROM messages
 WHERE {jt('body')} = 'OBJECT' AND {jfield('body', 'cep')} IS NOT NULL
   AND {jfield('body', 'cep')} NOT IN ('', '0', 'false', '[]', '{{}}'))"""

STREAKS = """runs AS (SELECT seq, consumer, ok, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY consumer ORDER BY seq
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM kept),
streaks AS (SELECT seq, consumer, ok, CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY consumer, run ORDER BY seq
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS k FROM runs)"""


def page_code_ctes(src, p):
    """U1 over relation ``src`` (page_id, html) as CTEs; the result is ``{p}_codes``."""
    txt_codes = hyph("replace(m, '-', '')")
    return f"""
{p}_rows AS (SELECT page_id, unnest(regexp_extract_all(regexp_extract(regexp_extract(html, '{CODE_TABLE}', 1),
   '{CODE_TBODY}', 1), '{TABLE_ROW}', 1)) AS tr FROM {src}),
{p}_cells AS (SELECT page_id, regexp_extract(tr, '{FIRST_CELL}', 1) AS td FROM {p}_rows),
{p}_alinks AS (SELECT page_id, unnest(regexp_extract_all(td, '{A_HREF_TEXT}', 1)) AS href,
   unnest(regexp_extract_all(td, '{A_HREF_TEXT}', 2)) AS txt FROM {p}_cells),
{p}_tc AS (SELECT page_id, regexp_extract({decode('href')}, '{CODE_IN_HREF}', 1) AS cep FROM {p}_alinks
   UNION ALL SELECT page_id, {txt_codes} AS cep FROM
   (SELECT page_id, unnest(regexp_extract_all({visible('txt')}, '{CODE_IN_TEXT}', 0)) AS m FROM {p}_alinks)),
{p}_table AS (SELECT DISTINCT page_id, cep FROM {p}_tc WHERE cep <> '' AND {regional('cep')}),
{p}_link AS (SELECT DISTINCT page_id, cep FROM (SELECT page_id, regexp_extract({decode('h')}, '{CODE_IN_HREF}', 1) AS cep
   FROM (SELECT page_id, unnest(regexp_extract_all(html, '{A_HREF}', 1)) AS h FROM {src})) WHERE cep <> '' AND {regional('cep')}),
{p}_text AS (SELECT DISTINCT page_id, cep FROM (SELECT page_id, {txt_codes} AS cep FROM
   (SELECT page_id, unnest(regexp_extract_all({visible('html')}, '{CODE_IN_TEXT}', 0)) AS m FROM {src})) WHERE {regional('cep')}),
{p}_primary AS (SELECT page_id, cep FROM {p}_table UNION SELECT page_id, cep FROM {p}_link),
{p}_codes AS (SELECT page_id, cep FROM {p}_primary UNION ALL
   SELECT page_id, cep FROM {p}_text WHERE page_id NOT IN (SELECT page_id FROM {p}_primary))"""


U1 = page_code_ctes("code_pages", "u1")

HREFS = f"hrefs AS (SELECT page_id, {decode('h')} AS href FROM (SELECT page_id, unnest(regexp_extract_all(html, '{A_HREF}', 1)) AS h FROM area_pages))"

REACH = """reach(node, depth) AS (SELECT 'base', 0 UNION SELECT l.dst, r.depth + 1 FROM reach r JOIN links l ON l.src = r.node
   WHERE r.depth < (SELECT count(*) FROM links)),
reached AS (SELECT node, min(depth) AS depth FROM reach GROUP BY node)"""

GRAPH_PAGES = """gpages AS (SELECT p.page_id, r.depth, p.html FROM code_pages p JOIN reached r ON 's' || CAST(p.page_id AS VARCHAR) = r.node)"""

def progress(kept: str, most: int) -> str:
    """Pages up to the one that reaches ``most`` codes, as the CTE ``kept``."""
    return f"""g_first AS (SELECT cep, min({{'d': g.depth, 'p': g.page_id}}) AS f FROM g_codes c JOIN gpages g USING (page_id) GROUP BY cep),
g_new AS (SELECT f.d AS depth, f.p AS page_id, count(*) AS new_codes FROM g_first GROUP BY f.d, f.p),
g_pp AS (SELECT g.page_id, g.depth, CAST(coalesce(n.new_codes, 0) AS BIGINT) AS new_codes FROM gpages g
   LEFT JOIN g_new n ON n.page_id = g.page_id AND n.depth = g.depth),
g_tot AS (SELECT page_id, depth, new_codes, CAST(sum(new_codes) OVER (ORDER BY depth, page_id
   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_total FROM g_pp),
{kept} AS (SELECT * FROM g_tot WHERE running_total - new_codes < {most})"""


PROGRESS = progress("g_kept", MAX_CODES)

ENRICH = f"""c AS (SELECT DISTINCT cep FROM f1 WHERE cep IS NOT NULL),
j1 AS (SELECT c.cep, coalesce(p.status, 'absent') = 'ok' AS found, coalesce(p.status, 'absent') AS status,
   {', '.join(f"CASE WHEN p.status = 'ok' THEN p.{f} END AS {f}" for f in ADDRESS_FIELDS[1:])}
   FROM c LEFT JOIN parsed p ON c.cep = p.code)"""

OKCODES = f"okc AS (SELECT code FROM responses WHERE {status('body')} = 'ok')"


def _merge(target, source, ts):
    cols = ", ".join(f"CASE WHEN s.cep IS NOT NULL THEN s.{f} ELSE t.{f} END AS {f}" for f in ADDRESS_FIELDS)
    return (f"SELECT {cols}, {iso(f'coalesce(t.created_at, {ts})')} AS created_at, "
            f"{iso(f'CASE WHEN s.cep IS NOT NULL THEN {ts} ELSE t.updated_at END')} AS updated_at "
            f"FROM {target} t FULL OUTER JOIN {source} s ON t.cep = s.cep")


def oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    fields = ", ".join(ADDRESS_FIELDS)
    # ---- sources
    o["S1_scan_codes_csv"] = W("SELECT CAST(row_id AS VARCHAR) AS row_id, cep FROM raw_codes", "raw_codes")
    o["S2_scan_codes_unvalidated"] = W(
        "SELECT row_id, replace(cep, '-', '') AS cep FROM raw_codes WHERE cep IS NOT NULL AND cep <> ''", "raw_codes")
    o["S3_scan_pages"] = "SELECT page_id, url, html FROM pages WHERE html IS NOT NULL"
    o["S4_parse_responses"] = W("SELECT * FROM parsed", "responses", ctes=PARSED)
    o["S5_scan_addresses"] = W("SELECT * FROM addresses", "responses", ctes=ADDRESSES)
    o["S6_scan_error_log"] = W("SELECT cep, error_type, error_message, timestamp, context FROM elog",
                               "attempts", ctes=ELOG)
    o["S9_explode_envelope"] = W(f"""SELECT envelope_id, cep FROM (
  SELECT envelope_id, replace(replace({jfield('b', 'cep')}, '-', ''), ' ', '') AS cep FROM
  (SELECT envelope_id, unnest(json_extract_string(envelope, '$.Records[*].body')) AS b FROM envelopes))
 WHERE coalesce(length(cep) = 8, false)""", "envelopes")
    rec0 = "json_extract(event, '$.Records[0]')"
    o["S10_route_events"] = W(f"""SELECT seq, CASE WHEN {jt('event')} IS DISTINCT FROM 'OBJECT' THEN 'malformed'
  WHEN list_contains(json_keys(event), 'Records') THEN (CASE WHEN {jt(rec0)} IS DISTINCT FROM 'OBJECT' THEN 'invalid'
     WHEN list_contains(json_keys({rec0}), 's3') THEN 's3'
     WHEN list_contains(json_keys({rec0}), 'eventSource') AND json_extract_string(event, '$.Records[0].eventSource') = 'aws:sqs' THEN 'sqs'
     ELSE 'unrouted' END)
  WHEN list_contains(json_keys(event), 'httpMethod') OR list_contains(json_keys(event), 'requestContext') THEN 'http'
  ELSE 'scheduled' END AS route FROM handler_events""", "handler_events")
    # ---- scalar functions
    o["C1_extract_codes"] = W(f"""SELECT page_id, {hyph("replace(m, '-', '')")} AS cep FROM
  (SELECT page_id, unnest(regexp_extract_all(html, '{CODE_IN_TEXT}', 0)) AS m FROM code_pages)""", "code_pages")
    o["C2_clean_code"] = W(f"SELECT row_id, {clean('cep')} AS cep FROM raw_codes", "raw_codes")
    o["C3_is_valid_regional"] = W(f"SELECT row_id, cep, {regional('cep')} AS is_valid_regional FROM raw_codes", "raw_codes")
    o["C4_mark_valid"] = W(f"SELECT row_id, cep, {valid('cep')} AS is_valid FROM raw_codes", "raw_codes")
    o["C5_is_code_length"] = W(f"SELECT row_id, cep, {codelen('cep')} AS is_code_length FROM raw_codes", "raw_codes")
    o["C6_format_code"] = W(f"""SELECT row_id, cep, {hyph('cep')} AS hyphenated, replace({hyph('cep')}, '-', '') AS digits
  FROM f1""", "raw_codes", ctes=F1)
    o["C7_page_links"] = f"SELECT page_id, {decode('h')} AS href FROM (SELECT page_id, unnest(regexp_extract_all(html, '{A_HREF}', 1)) AS h FROM pages)"
    o["C8_page_table_codes"] = W("SELECT page_id, cep FROM u1_table", "code_pages", ctes=U1)
    o["C9_page_href_codes"] = W("SELECT page_id, cep FROM u1_link", "code_pages", ctes=U1)
    o["C10_page_text_codes"] = W("SELECT page_id, cep FROM u1_text", "code_pages", ctes=U1)
    o["C11_is_area_link"] = W(f"SELECT page_id, href, {area_link('href')} AS is_area_link FROM hrefs", "area_pages", ctes=HREFS)
    o["C12_resolve_url"] = W(f"SELECT page_id, href, {resolve('href', SITE)} AS url FROM hrefs", "area_pages", ctes=HREFS)
    o["C13_same_host"] = W(f"""SELECT page_id, url, {same_host('url', SITE)} AS same_host FROM
  (SELECT page_id, {resolve('href', SITE)} AS url FROM hrefs)""", "area_pages", ctes=HREFS)
    o["C14_to_address_row"] = W(f"SELECT code, {', '.join(c14_cols('body'))} FROM responses WHERE {status('body')} = 'ok'", "responses")
    o["C15_to_export_row"] = W(f"SELECT {fields}, {iso('created_at')} AS created_at, {iso('updated_at')} AS updated_at FROM addresses",
                               "responses", ctes=ADDRESSES)
    o["C16_is_valid_response"] = W(f"""SELECT code, coalesce(CASE WHEN {jt('body')} = 'OBJECT' THEN NOT {erro('body')}
  AND list_contains(json_keys(body), 'cep') AND list_contains(json_keys(body), 'localidade')
  AND list_contains(json_keys(body), 'uf') END, false) AS is_valid_response FROM responses""", "responses")
    o["C17_classify_error"] = W(f"SELECT seq, cep, {classify('error_message')} AS error_type FROM failures", "failures")
    o["C18_error_context"] = W(f"SELECT seq, {context(status_code='status_code', retry_attempt='attempt')} AS context FROM attempts", "attempts")
    o["C18_validation_errors"] = W(f"""SELECT row_id, cep, 'validation_error' AS error_type, 'Invalid CEP: ' || coalesce(cep, '') AS error_message,
  '{{"validation_rule":"eight_digits"}}' AS context FROM raw_codes WHERE NOT {valid('cep')}""", "raw_codes")
    o["G2_crawl_pages"] = """WITH RECURSIVE reach(page_id, depth) AS (SELECT CAST(1 AS BIGINT), 0
  UNION ALL SELECT c.c_custkey, depth + 1 FROM reach JOIN customer c ON c.c_custkey > 1 AND (c.c_custkey + 8) // 10 = reach.page_id)
SELECT page_id, depth FROM reach"""
    o["C19_retry_backoff"] = W(f"SELECT seq, cep, attempt, {backoff('attempt', 'error_message')} AS backoff FROM attempts", "attempts")
    o["C20_is_connection_error"] = W(f"SELECT seq, {conn_err('error_message')} AS is_connection_error FROM failures", "failures")
    head = "split_part(url, '@', 1)"
    o["C21_mask_url"] = W(f"""SELECT page_id, CASE WHEN contains(url, '@') AND contains({head}, '://') AND contains({head}, ':')
  THEN regexp_replace({head}, ':[^:]*$', '') || ':***@' || substr(url, length({head}) + 2) ELSE url END AS masked_url
  FROM db_urls""", "db_urls")
    o["C22_request_status"] = W(f"""SELECT row_id, cep,
  CASE WHEN NOT {codelen('cep')} THEN 400 WHEN r.status = 'ok' THEN 200 ELSE 404 END AS status_code,
  CASE WHEN NOT {codelen('cep')} THEN '{{"error": "Invalid CEP format. Must be 8 digits."}}'
       WHEN r.status = 'ok' THEN r.body ELSE '{{"error": "CEP not found"}}' END AS body
  FROM raw_codes LEFT JOIN (SELECT code, body, {status('body')} AS status FROM responses) r
  ON replace(replace(cep, '-', ''), ' ', '') = r.code""", "raw_codes", "responses")
    # ---- filters
    o["F1_valid_codes"] = W("SELECT row_id, cep FROM f1", "raw_codes", ctes=F1)
    o["F2_invalid_codes"] = W(f"SELECT row_id, {clean('cep')} AS cep FROM raw_codes WHERE NOT {valid('cep')}", "raw_codes")
    o["F3_load_and_validate"] = W(f"SELECT CAST(row_id AS VARCHAR) AS row_id, cep, {valid('cep')} AS is_valid FROM raw_codes", "raw_codes")
    point = POINT_CODE.replace("-", "").replace(" ", "")
    o["F4_address_by_code"] = W(f"SELECT * FROM addresses WHERE cep = '{point}' LIMIT 1", "responses", ctes=ADDRESSES)
    o["F5_addresses_by_uf"] = W(f"SELECT * FROM addresses WHERE uf = '{STATE.upper()}'", "responses", ctes=ADDRESSES)
    o["F6_addresses_by_city"] = W(f"SELECT * FROM addresses WHERE localidade = '{CITY}'", "responses", ctes=ADDRESSES)
    o["F7_errors_filtered"] = W(f"SELECT * FROM elog WHERE error_type = '{ERROR_TYPE}'", "attempts", ctes=ELOG)
    o["F8_drop_bad_messages"] = W("SELECT * FROM kept", "messages", ctes=KEPT)
    # ---- joins
    o["J1_enrich_codes"] = W("SELECT * FROM j1", "raw_codes", "responses", ctes=",\n".join([F1, PARSED, ENRICH]))
    o["J2_process_codes"] = W(f"""SELECT {', '.join(c14_cols('body'))}, {TS_NOW} AS created_at, {TS_NOW} AS updated_at
  FROM responses WHERE {status('body')} = 'ok' AND code IN (SELECT cep FROM f1)""", "raw_codes", "responses", ctes=F1)
    def text(template, **fixed):
        head, tail = template.format(cep="\0", **fixed).split("\0")
        return f"'{head}' || cep || '{tail}'"
    msg = (f"(CASE WHEN status = 'not_found' THEN {text(MSG_NOT_FOUND)} "
           f"WHEN status = 'not_object' THEN {text(MSG_NOT_OBJECT)} "
           f"WHEN status = 'malformed' THEN {text(MSG_MALFORMED)} "
           f"ELSE {text(MSG_HTTP_404, url=DEFAULT_SERVICE_URL)} END)")
    sc_ = "(CASE WHEN status = 'not_found' THEN 200 WHEN status = 'absent' THEN 404 END)"
    ra = "(CASE WHEN status IN ('malformed', 'absent') THEN 3 END)"
    o["J3_not_found_codes"] = W(f"""SELECT cep, {classify(msg)} AS error_type, {msg} AS error_message,
  {context(status_code=sc_, retry_attempt=ra)} AS context FROM j1 WHERE NOT found""",
                                "raw_codes", "responses", ctes=",\n".join([F1, PARSED, ENRICH]))
    o["J4_new_codes"] = W("""SELECT DISTINCT cep FROM u1_codes WHERE page_id % 2 = 1
  AND cep NOT IN (SELECT cep FROM u1_codes WHERE page_id % 2 = 0)""", "code_pages", ctes=U1)
    o["J5_frontier_links"] = W("""SELECT DISTINCT dst FROM links WHERE src IN (SELECT node FROM visited)
  AND dst NOT IN (SELECT node FROM visited)""", "links",
                               ctes="visited AS (SELECT dst AS node FROM links WHERE src = 'base' UNION SELECT 'base')")
    tagged = "tagged AS (SELECT a.*, d.c_custkey FROM addresses a JOIN directory d ON a.cep = d.code)"
    o["J6_split_insert_update"] = W("""SELECT i.cep, CASE WHEN t.cep IS NOT NULL THEN 'update' ELSE 'insert' END AS action
  FROM (SELECT cep FROM addresses) i LEFT JOIN (SELECT cep FROM tagged WHERE c_custkey % 2 = 0) t
  ON i.cep = t.cep""", "responses", "directory", ctes=",\n".join([ADDRESSES, tagged]))
    # ---- aggregations
    o["A1_code_stats"] = W(f"""SELECT count(*) AS total, count(*) FILTER (WHERE {valid('cep')}) AS valid,
  count(*) FILTER (WHERE NOT {valid('cep')}) AS invalid FROM raw_codes""", "raw_codes")
    o["A2_count_addresses"] = W("SELECT count(*) AS total FROM addresses", "responses", ctes=ADDRESSES)
    o["A3_count_errors"] = W(f"SELECT count(*) AS error_count FROM elog WHERE error_type = '{ERROR_TYPE}'", "attempts", ctes=ELOG)
    o["A4_error_summary"] = W("""SELECT CASE WHEN grouping(error_type) = 0 THEN 'by_type' WHEN grouping(cep) = 0 THEN 'by_cep'
  ELSE 'total' END AS level, error_type, cep, count(*) AS errors, count(DISTINCT cep) AS distinct_ceps
  FROM elog GROUP BY GROUPING SETS ((error_type), (cep), ())""", "attempts", ctes=ELOG)
    s2 = "s2 AS (SELECT row_id, replace(cep, '-', '') AS cep FROM raw_codes WHERE cep IS NOT NULL AND cep <> '')"
    w1 = "w1 AS (SELECT row_id, cep, (row_number() OVER (ORDER BY row_id) - 1) // 120 AS batch FROM s2)"
    o["A5_batch_stats"] = W("""SELECT batch, count(*) FILTER (WHERE found) AS processed, count(*) FILTER (WHERE NOT found) AS errors,
  count(*) AS total FROM (SELECT batch, coalesce(cep IN (SELECT code FROM okc), false) AS found FROM w1)
  GROUP BY ROLLUP (batch)""", "raw_codes", "responses", ctes=",\n".join([s2, w1, OKCODES]))
    rows = "rr AS (SELECT cep, coalesce(cep IN (SELECT code FROM okc), false) AS found FROM f1)"
    o["A6_run_summary"] = W("""SELECT 200 AS status_code, 'Processing completed' AS message,
  count(*) FILTER (WHERE found) AS processed, count(*) FILTER (WHERE NOT found) AS errors FROM rr""",
                            "raw_codes", "responses", ctes=",\n".join([F1, OKCODES, rows]))
    o["A7_workflow_summary"] = W("""SELECT count(*) AS attempted, count(*) FILTER (WHERE found) AS succeeded,
  count(*) FILTER (WHERE NOT found) AS failed, count(DISTINCT CASE WHEN found THEN cep END) AS total_stored FROM rr""",
                                 "raw_codes", "responses", ctes=",\n".join([F1, OKCODES, rows]))
    o["A6_code_results"] = W("SELECT cep, found AS success, CASE WHEN NOT found THEN 'CEP not found' END AS error FROM rr",
                             "raw_codes", "responses", ctes=",\n".join([F1, OKCODES, rows]))
    queue = "queue AS (SELECT '{\"cep\": \"' || cep || '\"}' AS value FROM f1)"
    o["A8_publish_reconcile"] = W("""SELECT valid, published, valid = published AS complete, valid - published AS missing
  FROM (SELECT (SELECT count(*) FROM raw_codes WHERE """ + valid("cep") + """) AS valid,
               (SELECT count(*) FROM queue WHERE json_extract_string(value, '$.cep') IS NOT NULL) AS published)""",
                                  "raw_codes", ctes=",\n".join([F1, queue]))
    o["A9_distinct_codes"] = W("SELECT DISTINCT cep FROM u1_codes", "code_pages", ctes=U1)
    # ---- windows
    o["W1_number_batches"] = W("SELECT * FROM w1", "raw_codes", ctes=",\n".join([s2, w1]))
    g_codes = page_code_ctes("gpages", "g")
    o["W2_collection_progress"] = W("SELECT page_id, depth, new_codes, running_total FROM g_kept", "links", "code_pages",
                                    ctes=",\n".join([REACH, GRAPH_PAGES, g_codes, PROGRESS]), recursive=True)
    o["W3_latest_per_code"] = W("SELECT code, max(seq) AS seq, arg_max(body, seq) AS body FROM responses_versions GROUP BY code",
                                "responses_versions")
    o["W4_failure_streaks"] = W("""SELECT seq, consumer, ok, k, CAST(CASE WHEN ok THEN 0 ELSE ((k - 1) % 3) + 1 END AS INTEGER) AS streak,
  (NOT ok AND k % 3 = 0) AS paused FROM streaks""", "messages", ctes=",\n".join([KEPT, STREAKS]))
    pause = "CASE WHEN ok THEN 1.0 ELSE greatest(1.5, least(pow(2.0, floor(k / 3)), 10.0)) * 1.0 END"
    o["W5_pacing_schedule"] = W(f"""SELECT seq, consumer, ok, k, pause, sum(pause) OVER (PARTITION BY consumer ORDER BY seq
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - pause AS start FROM (SELECT *, {pause} AS pause FROM streaks)""",
                                "messages", ctes=",\n".join([KEPT, STREAKS]))
    outcome = (f"(CASE WHEN error_message IS NULL THEN 'success' WHEN contains(lower(error_message), 'timeout') THEN 'timeout' "
               f"WHEN starts_with(error_message, 'CEP ') AND contains(lower(error_message), 'not found') THEN 'not_found' "
               f"WHEN starts_with(error_message, 'Invalid response format') THEN 'not_object' "
               f"WHEN {conn_err('error_message')} THEN 'connection_error' ELSE 'http_error' END)")
    term = "('success', 'not_found', 'not_object')"
    w6 = f"""a AS (SELECT cep, attempt, error_message, {outcome} AS outcome FROM attempts WHERE attempt <= 3),
f AS (SELECT cep, coalesce(min(attempt) FILTER (WHERE outcome IN {term}), max(attempt)) AS final_attempt FROM a GROUP BY cep),
j AS (SELECT a.*, f.final_attempt FROM a JOIN f USING (cep)),
r AS (SELECT cep, final_attempt, max(outcome) FILTER (WHERE attempt = final_attempt) AS fo,
   max(error_message) FILTER (WHERE attempt = final_attempt) AS fm,
   coalesce(sum(CASE WHEN attempt < final_attempt AND outcome NOT IN {term} THEN {backoff('attempt', 'error_message')} END), 0.0) AS waited
   FROM j GROUP BY cep, final_attempt)"""
    o["W6_resolve_attempts"] = W(f"""SELECT cep, final_attempt AS attempts, CASE WHEN fo IN {term} THEN fo ELSE 'failed' END AS outcome,
  fm AS error_message, CASE WHEN fm IS NOT NULL THEN {classify('fm')} END AS error_type, waited FROM r""", "attempts", ctes=w6)
    # ---- sorts / limits
    o["L1_cap_codes"] = W(f"SELECT cep FROM (SELECT DISTINCT cep FROM u1_codes) ORDER BY cep LIMIT {MAX_CODES}", "code_pages", ctes=U1)
    o["L2_sort_codes"] = W("SELECT DISTINCT cep FROM u1_codes ORDER BY cep", "code_pages", ctes=U1)
    o["L3_page_addresses"] = W(f"SELECT * FROM addresses ORDER BY cep LIMIT {PAGE_LIMIT} OFFSET {PAGE_OFFSET}", "responses", ctes=ADDRESSES)
    o["L4_process_limit"] = W(f"SELECT * FROM kept ORDER BY seq LIMIT {PROCESS_LIMIT}", "messages", ctes=KEPT)
    inv = f"inv AS (SELECT row_id, cep FROM raw_codes WHERE NOT {valid('cep')})"
    o["L5_sample_invalid"] = W("""SELECT row_id, cep, (SELECT count(*) FROM inv) AS invalid_count FROM inv ORDER BY row_id LIMIT 5""",
                               "raw_codes", ctes=inv)
    # ---- set operations
    o["U1_page_codes"] = W("SELECT page_id, cep FROM c_codes", "crawl_pages", ctes=page_code_ctes("crawl_pages", "c"))
    o["U2_area_links"] = W(f"""SELECT DISTINCT page_id, url FROM (SELECT page_id, {resolve('href', SITE)} AS url FROM hrefs
  WHERE {area_link('href')}) WHERE {same_host('url', SITE)}""", "area_pages", ctes=HREFS)
    o["U3_merge_collections"] = W("SELECT DISTINCT cep FROM u1_codes", "code_pages", ctes=U1)
    # ---- graph
    o["G1_reach_pages"] = W("SELECT node, depth FROM reached", "links", ctes=REACH, recursive=True)
    o["G2_collect_codes"] = W(f"""SELECT cep FROM (SELECT DISTINCT cep FROM g_codes WHERE page_id IN (SELECT page_id FROM g_kept))
  ORDER BY cep LIMIT {MAX_CODES}""", "links", "code_pages",
                              ctes=",\n".join([REACH, GRAPH_PAGES, g_codes, PROGRESS]), recursive=True)
    # ---- messages and the address table
    o["K13_publish_messages"] = W("""SELECT row_id, '{"cep": "' || cep || '"}' AS value FROM f1""", "raw_codes", ctes=F1)
    o["K14_backlog"] = W(f"""SELECT count(*) AS backlog FROM messages WHERE seq >
  (SELECT max(seq) FROM (SELECT seq FROM kept ORDER BY seq LIMIT {PROCESS_LIMIT}))""", "messages", ctes=KEPT)
    upd = "TIMESTAMP '2024-02-01 00:00:00'"
    src_cols = ", ".join("'Updated ' || logradouro AS logradouro" if f == "logradouro" else f for f in ADDRESS_FIELDS)
    o["K9_upsert_addresses"] = W(_merge("(SELECT * FROM tagged WHERE c_custkey % 2 = 0)",
                                        f"(SELECT {src_cols} FROM addresses)", upd),
                                 "responses", "directory", ctes=",\n".join([ADDRESSES, tagged]))
    versions = f"""ver AS (SELECT seq, {', '.join(c14_cols('body'))} FROM responses_versions WHERE {status('body')} = 'ok'),
latest AS (SELECT cep, {', '.join(f'arg_max({f}, seq) AS {f}' for f in ADDRESS_FIELDS[1:])} FROM ver GROUP BY cep)"""
    o["K10_upsert_batch"] = W(_merge("addresses", "latest", upd), "responses", "responses_versions",
                              ctes=",\n".join([ADDRESSES, versions]))
    from postalspark.plans.sink_queries import sink_oracles
    from postalspark.plans.stream_queries import stream_oracles
    from postalspark.plans.workflow import workflow_oracles
    for more in (sink_oracles, stream_oracles, workflow_oracles):
        o.update(more(o))
    return o
