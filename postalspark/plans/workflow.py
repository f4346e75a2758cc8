"""End-to-end plans: the flagship query, the full workflow (P1), the batch job
(P2) and the export-only job (P3). Each is a composition of library operators;
the only driver-side values are counts and file paths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postalspark import fixtures as fx
from postalspark.operators import codes as oc
from postalspark.operators import graph as og
from postalspark.operators import lookup as ol
from postalspark.operators import messages as om
from postalspark.operators.joins import broadcast_if_small
from postalspark.plans.catalog import NOW, V, addresses, node_pages, query
from postalspark.schemas import DEFAULT_MAX_CODES
from postalspark.session import scratch_dir
from postalspark.sinks import files as sf_
from postalspark.sinks.table import AddressTable
from postalspark.sources import codes as sc


def codes_by_state(codes: DataFrame, responses: DataFrame) -> DataFrame:
    """Flagship: valid codes enriched by the directory, counted per state.

    One equi-join of every valid code row with the found answers (broadcast when
    their estimated size is within the bound, else sort-merge with AQE's skew
    split), then a two-phase aggregate per state.
    """
    valid = oc.valid_codes(codes).select("cep")
    found = ol.lookup_table(responses).where(F.col("status") == "ok").select(F.col("code").alias("cep"), "uf")
    return (valid.join(broadcast_if_small(found), "cep")
            .groupBy("uf").agg(F.count(F.lit(1)).alias("codes"), F.count_distinct("cep").alias("distinct_codes")))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes_by_state(fx.view(spark, sf_dir, "raw_codes"), fx.view(spark, sf_dir, "responses"))


@dataclass
class WorkflowConfig:
    """Switches of the full workflow."""
    collect: bool = True
    max_codes: int = 10000
    process_limit: int | None = None
    export_json: bool = True
    export_xml: bool = True
    csv_path: str | None = None
    work_dir: str | None = None
    now: str = NOW


def full_workflow(spark: SparkSession, links: DataFrame, pages: DataFrame, responses: DataFrame,
                  cfg: WorkflowConfig) -> DataFrame | None:
    """collect? -> validate -> publish -> process(limit) -> export -> summary.

    Returns None where the original stops: no code file, or no valid code. Zero
    processed codes is not a stop.
    """
    work = cfg.work_dir or scratch_dir(spark, "workflow")
    if cfg.collect:
        csv_path = sf_.write_codes_csv(og.collect_codes(links, pages, cfg.max_codes), f"{work}/codes_csv")
    else:
        csv_path = cfg.csv_path
        if not csv_path or not sc.path_exists(spark, csv_path):
            return None
    valid = oc.valid_codes(oc.load_and_validate(spark, csv_path))
    published = om.publish_messages(valid.withColumn("seq", F.monotonically_increasing_id()))
    published.select("seq", "value").write.mode("overwrite").parquet(f"{work}/queue")
    queue = spark.read.parquet(f"{work}/queue")
    sent = om.publish_reconcile(valid, queue).first()
    if not sent["published"] or not sent["complete"]:
        return None
    responses = ol.parsed_answers(responses)
    msgs = queue.select("seq", F.get_json_object("value", "$.cep").alias("cep"))
    taken = om.process_limit(msgs, cfg.process_limit)
    answers = ol.enrich_codes(taken, responses).select("cep", "found")
    per_message = taken.join(answers, "cep", "left")
    table = AddressTable(spark, f"{work}/ceps")
    table.upsert(ol.process_codes(taken, responses, cfg.now).drop("created_at", "updated_at"), cfg.now)
    sf_.append_errors(ol.not_found_codes(taken, responses), f"{work}/errors", F.lit(cfg.now).cast("timestamp_ntz"))
    stored = table.read()
    if cfg.export_json:
        sf_.export_json(stored, f"{work}/export_json", cfg.now)
    if cfg.export_xml:
        sf_.export_xml(stored, f"{work}/export_xml", cfg.now)
    summary = om.workflow_summary(per_message.withColumn("found", F.coalesce("found", F.lit(False))))
    # codes in the table after the run (the table may hold earlier runs too)
    return summary.withColumn("total_stored", F.lit(stored.count()).cast("long"))


def batch_job(spark: SparkSession, codes: DataFrame, responses: DataFrame, out_path: str,
              rate_per_second: float = 2.0, now: str = NOW, table: AddressTable | None = None,
              errors_path: str | None = None) -> DataFrame:
    """Codes -> lookups in batches -> table -> Parquet of the whole table -> per-batch and job totals.

    ``codes`` needs ``cep``; without ``row_id`` rows count in input order. Hits are upserted into ``table`` (a new one
    beside the output by default), failures go to the error log, and the Parquet output holds the whole table.
    """
    cleaned = sc.scan_codes_unvalidated(codes)
    if "row_id" not in cleaned.columns:
        cleaned = cleaned.withColumn("row_id", F.monotonically_increasing_id())
    batched = oc.number_batches(cleaned, oc.batch_size_for(rate_per_second))
    answers = ol.last_answer(ol.lookup_table(responses).select("code", "seq", "status"), "code")
    results = batched.join(answers, batched["cep"] == answers["code"], "left").withColumn("found", F.coalesce(F.col("status") == "ok", F.lit(False)))
    table = table or AddressTable(spark, f"{out_path}-table")
    table.upsert(ol.process_codes(cleaned, responses, now).drop("created_at", "updated_at"), now)
    sf_.append_errors(ol.not_found_codes(cleaned, responses), errors_path or f"{out_path}-errors", F.lit(now).cast("timestamp_ntz"))
    sf_.write_parquet(table.read(), out_path)
    return om.batch_stats(results)


def export_only(spark: SparkSession, table: DataFrame, work: str, export_date: str) -> DataFrame:
    """Table -> JSON and XML exports; one row with what each export holds."""
    ok_json = sf_.export_json(table, f"{work}/json", export_date)
    ok_xml = sf_.export_xml(table, f"{work}/xml", export_date)
    if not (ok_json and ok_xml):
        return spark.createDataFrame([], "json_rows long, xml_rows long")
    json_rows = spark.read.json(f"{work}/json/ceps").count()
    xml_rows = sf_.read_xml_export(spark, f"{work}/xml").count()
    return spark.range(1).select(F.lit(json_rows).cast("long").alias("json_rows"),
                                 F.lit(xml_rows).cast("long").alias("xml_rows"))


# ---------------------------------------------------------------- registered plans
@query("P0_codes_by_state")
def p0(spark, sf):
    return flagship(spark, sf)


@query("P1_full_workflow")
def p1(spark, sf):
    # every code of the code file
    path = sf_.write_csv(V(spark, sf, "raw_codes"), "p1_codes")
    cfg = WorkflowConfig(collect=False, csv_path=path)
    return full_workflow(spark, V(spark, sf, "links"), node_pages(spark, sf), V(spark, sf, "responses"), cfg)


@query("P1_collecting_workflow")
def p1_collecting(spark, sf):
    """The form that collects its codes from the crawled pages first (G2, up to the default target)."""
    cfg = WorkflowConfig(collect=True, max_codes=DEFAULT_MAX_CODES)
    return full_workflow(spark, V(spark, sf, "links"), node_pages(spark, sf), V(spark, sf, "responses"), cfg)


@query("P2_batch_job")
def p2(spark, sf):
    return batch_job(spark, V(spark, sf, "raw_codes"), V(spark, sf, "responses"), scratch_dir(spark, "p2_parquet"))


@query("P3_export_only")
def p3(spark, sf):
    return export_only(spark, addresses(spark, sf), scratch_dir(spark, "p3"), "2024-01-01T00:00:00+00:00")


def workflow_oracles(o: dict[str, str]) -> dict[str, str]:
    from postalspark.fixtures import with_views as W
    from postalspark.plans import oracles as q
    ok = f"ok AS (SELECT code, json_extract_string(body, '$.uf') AS uf FROM responses WHERE {q.status('body')} = 'ok')"
    return {
        "P0_codes_by_state": W("""SELECT ok.uf, count(*) AS codes, count(DISTINCT f1.cep) AS distinct_codes
  FROM f1 JOIN ok ON f1.cep = ok.code GROUP BY ok.uf""", "raw_codes", "responses", ctes=",\n".join([q.F1, ok])),
        "P1_full_workflow": W("""SELECT count(*) AS attempted, count(*) FILTER (WHERE found) AS succeeded,
  count(*) FILTER (WHERE NOT found) AS failed, count(DISTINCT cep) FILTER (WHERE found) AS total_stored
  FROM (SELECT cep, coalesce(cep IN (SELECT code FROM okc), false) AS found FROM f1)""",
                              "raw_codes", "responses", ctes=",\n".join([q.F1, q.OKCODES])),
        "P1_collecting_workflow": W(f"""SELECT count(*) AS attempted, count(*) FILTER (WHERE found) AS succeeded,
  count(*) FILTER (WHERE NOT found) AS failed, count(DISTINCT cep) FILTER (WHERE found) AS total_stored
  FROM (SELECT replace(cep, '-', '') AS cep, coalesce(replace(cep, '-', '') IN (SELECT code FROM okc), false) AS found
   FROM (SELECT cep FROM (SELECT DISTINCT cep FROM g_codes WHERE page_id IN (SELECT page_id FROM g_all)) ORDER BY cep LIMIT {DEFAULT_MAX_CODES}))""",
                                    "links", "code_pages", "responses", recursive=True,
                                    ctes=",\n".join([q.REACH, q.GRAPH_PAGES, q.page_code_ctes("gpages", "g"),
                                                     q.progress("g_all", DEFAULT_MAX_CODES), q.OKCODES])),
        "P2_batch_job": o["A5_batch_stats"],
        "P3_export_only": W("SELECT count(*) AS json_rows, count(*) AS xml_rows FROM addresses", "responses",
                            ctes=q.ADDRESSES),
    }
