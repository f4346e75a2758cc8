"""Registered queries: one per operator of the inventory, over the driver tables.

Each entry takes (spark, sf_dir) and returns a DataFrame. Inputs are the
derived views of ``postalspark.fixtures`` (plain SQL over the parquet tables);
the work is done by the library operators. Parameters are fixed here once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postalspark import fixtures as fx
from postalspark.functions import codes as C
from postalspark.functions import errors as E
from postalspark.functions import links as L
from postalspark.functions import responses as R
from postalspark.functions.text import iso_timestamp, mask_url
from postalspark.operators import codes as oc
from postalspark.operators import errors as oe
from postalspark.operators import graph as og
from postalspark.operators import lookup as ol
from postalspark.operators import messages as om
from postalspark.operators import pages as op
from postalspark.operators import store as os_
from postalspark.schemas import ADDRESS, ADDRESS_FIELDS, EXPORT_FIELDS
from postalspark.session import scratch_dir
from postalspark.sinks.table import AddressTable
from postalspark.sources import codes as sc
from postalspark.sources import envelopes as se
from postalspark.sources import pages as sp
from postalspark.sources import responses as sr
from postalspark.sources import store as ss

# Fixed parameters of the registered queries.
NOW = "2024-01-01 00:00:00"
SITE = "https://codes.example/pt-br/brasil/sp/sao-paulo/"
POINT_CODE = "00065-537"
STATE = "sp"
CITY = "NATION_2"
ERROR_TYPE = "api_timeout"
GLUE_RATE = 2.0
MAX_CODES = 100
PROCESS_LIMIT = 500
PAGE_OFFSET, PAGE_LIMIT = 100, 500

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def V(spark, sf, name):  # noqa: N802 - short alias for a fixture view
    return fx.view(spark, sf, name)


def addresses(spark, sf) -> DataFrame:
    return os_.stored_addresses(V(spark, sf, "responses"), NOW)


def stored(spark, sf) -> DataFrame:
    """The address table as files: state folders, sorted by city and code inside, so reads prune and skip.

    Written once per application and scale folder below the shared scratch folder.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORED:
        path = scratch_dir(spark, "addresses")
        (addresses(spark, sf).select(*EXPORT_FIELDS).repartitionByRange("uf", "localidade", "cep")
         .sortWithinPartitions("uf", "localidade", "cep").write.partitionBy("uf").parquet(path))
        _STORED[key] = path
    return spark.read.schema(ADDRESS).parquet(_STORED[key]).select(*EXPORT_FIELDS)


def stored_table(spark, sf) -> AddressTable:
    """The same rows as the versioned address table; small files, so that pages and point reads have files to leave out."""
    key = (spark.sparkContext.applicationId, sf, "table")
    if key not in _STORED:
        _STORED[key] = scratch_dir(spark, "address_table")
        AddressTable(spark, _STORED[key], leaf_rows=1_000).commit(addresses(spark, sf))
    return AddressTable(spark, _STORED[key])


_STORED: dict[tuple[str, ...], str] = {}


def node_pages(spark, sf) -> DataFrame:
    """Code pages attached to the supplier nodes of the crawl graph."""
    return V(spark, sf, "code_pages").select("page_id", F.concat(F.lit("s"), F.col("page_id").cast("string")).alias("node"), "html")


# ---------------------------------------------------------------- sources
@query("S1_scan_codes_csv")
def s1(spark, sf):
    from postalspark.sinks.files import write_csv
    path = write_csv(V(spark, sf, "raw_codes"), "raw_codes_csv")
    return sc.read_codes_csv(spark, path)


@query("S2_scan_codes_unvalidated")
def s2(spark, sf):
    return sc.scan_codes_unvalidated(V(spark, sf, "raw_codes"))


@query("S3_scan_pages")
def s3(spark, sf):
    return sp.scan_pages(fx.table(spark, sf, "pages"))


@query("S4_parse_responses")
def s4(spark, sf):
    return sr.parse_responses(V(spark, sf, "responses"))


@query("S5_scan_addresses")
def s5(spark, sf):
    return ss.scan_addresses(stored(spark, sf))


@query("S6_scan_error_log")
def s6(spark, sf):
    from postalspark.sinks.files import append_errors
    path = append_errors(oe.error_log(V(spark, sf, "attempts")).drop("seq"), None)
    return ss.read_error_log(spark, path)


@query("S9_explode_envelope")
def s9(spark, sf):
    return se.explode_envelope(V(spark, sf, "envelopes"))


@query("S10_route_events")
def s10(spark, sf):
    return se.route_events(V(spark, sf, "handler_events"))


# ---------------------------------------------------------------- scalar functions
@query("C1_extract_codes")
def c1(spark, sf):
    return op.extracted_codes(V(spark, sf, "code_pages"))


@query("C2_clean_code")
def c2(spark, sf):
    return V(spark, sf, "raw_codes").select("row_id", C.clean_code("cep").alias("cep"))


@query("C3_is_valid_regional")
def c3(spark, sf):
    return V(spark, sf, "raw_codes").select("row_id", "cep", C.is_valid_regional("cep").alias("is_valid_regional"))


@query("C4_mark_valid")
def c4(spark, sf):
    return oc.mark_valid(V(spark, sf, "raw_codes"))


@query("C5_is_code_length")
def c5(spark, sf):
    return V(spark, sf, "raw_codes").select("row_id", "cep", C.is_code_length("cep").alias("is_code_length"))


@query("C6_format_code")
def c6(spark, sf):
    v = oc.valid_codes(V(spark, sf, "raw_codes"))
    h = C.hyphenate("cep")
    return v.select("row_id", "cep", h.alias("hyphenated"), C.dehyphenate(h).alias("digits"))


@query("C7_page_links")
def c7(spark, sf):
    return op.page_links(fx.table(spark, sf, "pages"))


@query("C8_page_table_codes")
def c8(spark, sf):
    return op.table_codes(V(spark, sf, "code_pages"))


@query("C9_page_href_codes")
def c9(spark, sf):
    return op.link_codes(V(spark, sf, "code_pages"))


@query("C10_page_text_codes")
def c10(spark, sf):
    return op.text_codes(V(spark, sf, "code_pages"))


@query("C11_is_area_link")
def c11(spark, sf):
    return op.page_links(V(spark, sf, "area_pages")).select("page_id", "href", L.is_area_link("href").alias("is_area_link"))


@query("C12_resolve_url")
def c12(spark, sf):
    return L.resolve_links(op.page_links(V(spark, sf, "area_pages")), "href", SITE, "url")


@query("C13_same_host")
def c13(spark, sf):
    links = L.resolve_links(op.page_links(V(spark, sf, "area_pages")), "href", SITE, "url").select("page_id", "url")
    return links.select("page_id", "url", L.same_host("url", SITE).alias("same_host"))


@query("C14_to_address_row")
def c14(spark, sf):
    p = sr.parse_responses(V(spark, sf, "responses")).where(F.col("status") == R.OK)
    return p.select("code", *R.address_columns(F.struct(*[F.col(f) for f in ADDRESS_FIELDS])))


@query("C15_to_export_row")
def c15(spark, sf):
    a = stored(spark, sf)
    return a.select(*ADDRESS_FIELDS, iso_timestamp("created_at").alias("created_at"),
                    iso_timestamp("updated_at").alias("updated_at"))


@query("C16_is_valid_response")
def c16(spark, sf):
    return V(spark, sf, "responses").select("code", R.is_valid_response("body").alias("is_valid_response"))


@query("C17_classify_error")
def c17(spark, sf):
    return V(spark, sf, "failures").select("seq", "cep", E.classify_error("error_message").alias("error_type"))


@query("C18_error_context")
def c18(spark, sf):
    a = V(spark, sf, "attempts")
    return a.select("seq", E.error_context(status_code=F.col("status_code"), retry_attempt=F.col("attempt")).alias("context"))


@query("C18_validation_errors")
def c18_validation(spark, sf):
    bad = oc.mark_valid(V(spark, sf, "raw_codes")).where(~F.col("is_valid"))
    text = F.concat(F.lit("Invalid CEP: "), F.coalesce("cep", F.lit("")))
    return oe.validation_errors(bad.select("row_id", "cep", text.alias("error_message")), "eight_digits")


@query("C19_retry_backoff")
def c19(spark, sf):
    a = V(spark, sf, "attempts")
    return a.select("seq", "cep", "attempt", E.retry_backoff("attempt", "error_message").alias("backoff"))


@query("C20_is_connection_error")
def c20(spark, sf):
    return V(spark, sf, "failures").select("seq", E.is_connection_error("error_message").alias("is_connection_error"))


@query("C21_mask_url")
def c21(spark, sf):
    return V(spark, sf, "db_urls").select("page_id", mask_url("url").alias("masked_url"))


@query("C22_request_status")
def c22(spark, sf):
    return ol.request_status(V(spark, sf, "raw_codes"), V(spark, sf, "responses"))


# ---------------------------------------------------------------- filters
@query("F1_valid_codes")
def f1(spark, sf):
    return oc.valid_codes(V(spark, sf, "raw_codes"))


@query("F2_invalid_codes")
def f2(spark, sf):
    return oc.invalid_codes(V(spark, sf, "raw_codes"))


@query("F3_load_and_validate")
def f3(spark, sf):
    from postalspark.sinks.files import write_csv
    path = write_csv(V(spark, sf, "raw_codes"), "raw_codes_csv")
    return oc.load_and_validate(spark, path)


@query("F4_address_by_code")
def f4(spark, sf):
    return stored_table(spark, sf).lookup(POINT_CODE).select(*EXPORT_FIELDS)


@query("F5_addresses_by_uf")
def f5(spark, sf):
    return os_.addresses_by_uf(stored(spark, sf), STATE)


@query("F6_addresses_by_city")
def f6(spark, sf):
    return os_.addresses_by_city(stored(spark, sf), CITY)


@query("F7_errors_filtered")
def f7(spark, sf):
    return ss.filter_errors(oe.error_log(V(spark, sf, "attempts")), error_type=ERROR_TYPE)


@query("F8_drop_bad_messages")
def f8(spark, sf):
    return om.drop_bad_messages(V(spark, sf, "messages"))


# ---------------------------------------------------------------- joins
def _valid(spark, sf):
    return oc.valid_codes(V(spark, sf, "raw_codes"))


@query("J1_enrich_codes")
def j1(spark, sf):
    return ol.enrich_codes(_valid(spark, sf), V(spark, sf, "responses"))


@query("J2_process_codes")
def j2(spark, sf):
    return ol.process_codes(_valid(spark, sf), V(spark, sf, "responses"), NOW)


@query("J3_not_found_codes")
def j3(spark, sf):
    return ol.not_found_codes(_valid(spark, sf), V(spark, sf, "responses"))


@query("J4_new_codes")
def j4(spark, sf):
    codes = op.page_codes(V(spark, sf, "code_pages"))
    collected = codes.where(F.col("page_id") % 2 == 0)
    return op.new_codes(codes.where(F.col("page_id") % 2 == 1), collected)


@query("J5_frontier_links")
def j5(spark, sf):
    links = V(spark, sf, "links")
    visited = (links.where(F.col("src") == "base").select(F.col("dst").alias("node"))
               .unionByName(spark.range(1).select(F.lit("base").alias("node"))).dropDuplicates())
    return og.frontier_links(links, visited)


@query("J6_split_insert_update")
def j6(spark, sf):
    a = addresses(spark, sf)
    d = V(spark, sf, "directory").select(F.col("code").alias("cep"), "c_custkey")
    # the table holds the even customers' codes; every stored code comes in again
    target = a.join(d, "cep").where(F.col("c_custkey") % 2 == 0).drop("c_custkey")
    return os_.split_insert_update(target, a.select("cep"))


# ---------------------------------------------------------------- aggregations
@query("A1_code_stats")
def a1(spark, sf):
    return oc.code_stats(V(spark, sf, "raw_codes"))


@query("A2_count_addresses")
def a2(spark, sf):
    return os_.count_addresses(stored(spark, sf))


@query("A3_count_errors")
def a3(spark, sf):
    return oe.count_errors(oe.error_log(V(spark, sf, "attempts")), error_type=ERROR_TYPE)


@query("A4_error_summary")
def a4(spark, sf):
    return oe.error_summary(oe.error_log(V(spark, sf, "attempts")))


def _batched_results(spark, sf):
    codes = sc.scan_codes_unvalidated(V(spark, sf, "raw_codes"))
    batched = oc.number_batches(codes, oc.batch_size_for(GLUE_RATE))
    # one lookup per distinct code (read before numbering); per-row results keep their
    # batch via a join on the code
    answers = ol.enrich_codes(codes, V(spark, sf, "responses")).select("cep", "found")
    return batched.join(answers, "cep", "left").withColumn("found", F.coalesce("found", F.lit(False)))


@query("A5_batch_stats")
def a5(spark, sf):
    return om.batch_stats(_batched_results(spark, sf))


def _row_results(spark, sf):
    """Per-row lookup results of the valid codes of an uploaded file (not distinct)."""
    v = _valid(spark, sf)
    answers = ol.enrich_codes(v, V(spark, sf, "responses")).select("cep", "found")
    return v.join(answers, "cep", "left")


@query("A6_run_summary")
def a6(spark, sf):
    return om.run_summary(_row_results(spark, sf))


@query("A7_workflow_summary")
def a7(spark, sf):
    return om.workflow_summary(_row_results(spark, sf))


@query("A8_publish_reconcile")
def a8(spark, sf):
    from postalspark.sinks.files import write_messages
    valid = _valid(spark, sf)
    queue = write_messages(om.publish_messages(valid), scratch_dir(spark, "a8_queue"))
    return om.publish_reconcile(valid, spark.read.text(queue))


@query("A6_code_results")
def a6_codes(spark, sf):
    return om.code_results(_row_results(spark, sf))


@query("A9_distinct_codes")
def a9(spark, sf):
    return oc.distinct_codes(op.page_codes(V(spark, sf, "code_pages")))


# ---------------------------------------------------------------- windows
@query("W1_number_batches")
def w1(spark, sf):
    codes = sc.scan_codes_unvalidated(V(spark, sf, "raw_codes"))
    return oc.number_batches(codes, oc.batch_size_for(GLUE_RATE))


def _reached_pages(spark, sf):
    reached = og.reach_pages(V(spark, sf, "links"))
    return node_pages(spark, sf).join(reached, "node").select("page_id", "depth", "html")


@query("W2_collection_progress")
def w2(spark, sf):
    pages = _reached_pages(spark, sf)
    return og.collection_progress(op.page_codes(pages), pages.select("page_id", "depth"), MAX_CODES)


@query("W3_latest_per_code")
def w3(spark, sf):
    return ol.latest_per_code(V(spark, sf, "responses_versions"), key="code", seq="seq")


@query("W4_failure_streaks")
def w4(spark, sf):
    kept = om.drop_bad_messages(V(spark, sf, "messages")).select("seq", "consumer", "ok")
    return om.failure_streaks(kept)


@query("W5_pacing_schedule")
def w5(spark, sf):
    kept = om.drop_bad_messages(V(spark, sf, "messages")).select("seq", "consumer", "ok")
    return om.pacing_schedule(kept).select("seq", "consumer", "ok", "k", "pause", "start")


@query("W6_resolve_attempts")
def w6(spark, sf):
    return ol.resolve_attempts(V(spark, sf, "attempts"))


# ---------------------------------------------------------------- sorts / limits
@query("L1_cap_codes")
def l1(spark, sf):
    return oc.cap_codes(op.page_codes(V(spark, sf, "code_pages")), MAX_CODES)


@query("L2_sort_codes")
def l2(spark, sf):
    return oc.sort_codes(op.page_codes(V(spark, sf, "code_pages")))


@query("L3_page_addresses")
def l3(spark, sf):
    return stored_table(spark, sf).page(PAGE_LIMIT, PAGE_OFFSET).select(*EXPORT_FIELDS)


@query("L4_process_limit")
def l4(spark, sf):
    return om.process_limit(om.drop_bad_messages(V(spark, sf, "messages")), PROCESS_LIMIT)


@query("L5_sample_invalid")
def l5(spark, sf):
    return oc.sample_invalid(V(spark, sf, "raw_codes"))


# ---------------------------------------------------------------- set operations
@query("U1_page_codes")
def u1(spark, sf):
    return op.page_codes(V(spark, sf, "crawl_pages"))


@query("U2_area_links")
def u2(spark, sf):
    return op.area_links(V(spark, sf, "area_pages"), SITE)


@query("U3_merge_collections")
def u3(spark, sf):
    codes = op.page_codes(V(spark, sf, "code_pages"))
    return op.merge_collections(codes.where(F.col("page_id") % 2 == 0), codes.where(F.col("page_id") % 2 == 1))


# ---------------------------------------------------------------- graph
@query("G1_reach_pages")
def g1(spark, sf):
    return og.reach_pages(V(spark, sf, "links"))


@query("G2_crawl_pages")
def g2_crawl(spark, sf):
    """Edges come from the pages' own links; every page is reached from the first."""
    reached = og.crawl(V(spark, sf, "site_pages"), SITE + "p1/")
    return reached.select("page_id", F.col("depth").cast("int").alias("depth"))


@query("G2_collect_codes")
def g2(spark, sf):
    return og.collect_codes(V(spark, sf, "links"), node_pages(spark, sf), MAX_CODES)


# ---------------------------------------------------------------- message sinks / counts
@query("K13_publish_messages")
def k13(spark, sf):
    return om.publish_messages(_valid(spark, sf)).select("row_id", "value")


@query("K14_backlog")
def k14(spark, sf):
    m = V(spark, sf, "messages")
    handled = om.consumed_until(m, om.drop_bad_messages(m), PROCESS_LIMIT)
    return om.backlog(m, handled)


@query("K9_upsert_addresses")
def k9(spark, sf):
    a = addresses(spark, sf)
    d = V(spark, sf, "directory").select(F.col("code").alias("cep"), "c_custkey")
    target = a.join(d, "cep").where(F.col("c_custkey") % 2 == 0).drop("c_custkey")
    # every stored code arrives again with a changed street: updates and inserts
    source = a.select(*[F.concat(F.lit("Updated "), F.col(f)).alias(f) if f == "logradouro" else F.col(f)
                        for f in ADDRESS_FIELDS])
    table = AddressTable(spark, scratch_dir(spark, "k9_table"))
    table.commit(target)
    table.upsert(source, "2024-02-01 00:00:00")
    return table.read().select(*ADDRESS_FIELDS, iso_timestamp("created_at").alias("created_at"),
                         iso_timestamp("updated_at").alias("updated_at"))


@query("K10_upsert_batch")
def k10(spark, sf):
    target = addresses(spark, sf)
    versions = sr.parse_responses(V(spark, sf, "responses_versions")).where(F.col("status") == R.OK)
    source = versions.select("seq", *R.address_columns(F.struct(*[F.col(f) for f in ADDRESS_FIELDS])))
    table = AddressTable(spark, scratch_dir(spark, "k10_table"))
    table.commit(target)
    table.upsert(source, "2024-02-01 00:00:00")
    return table.read().select(*ADDRESS_FIELDS, iso_timestamp("created_at").alias("created_at"),
                         iso_timestamp("updated_at").alias("updated_at"))


def registered() -> dict[str, Query]:
    # sinks, streams and plans register themselves on import
    import importlib
    for mod in ("postalspark.plans.sink_queries", "postalspark.plans.stream_queries", "postalspark.plans.workflow"):
        importlib.import_module(mod)
    return dict(QUERIES)
