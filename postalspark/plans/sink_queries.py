"""Registered sink queries: write with the library writers, read the result back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from postalspark.fixtures import with_views as W
from postalspark.operators import messages as om
from postalspark.operators import pages as op
from postalspark.operators.lookup import not_found_codes
from postalspark.plans.catalog import V, _valid, addresses, query
from postalspark.schemas import ADDRESS_FIELDS, EXPORT_FIELDS, PARQUET_FIELDS
from postalspark.session import scratch_dir
from postalspark.sinks import documents as sd
from postalspark.sinks import files as sf_
from postalspark.sinks import single
from postalspark.sinks import table as st
from postalspark.sources.store import read_error_log

EXPORT_DATE = "2024-01-01T00:00:00+00:00"
EXPORT_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in EXPORT_FIELDS])
RECORDED_AT = "2024-01-01 12:00:00.5"


@query("K1_write_codes_csv")
def k1(spark, sf):
    path = sf_.write_codes_csv(op.page_codes(V(spark, sf, "code_pages")))
    return spark.read.option("header", True).schema("cep string").csv(path)


@query("K2_export_json")
def k2(spark, sf):
    path = scratch_dir(spark, "export_json")
    if not sf_.export_json(addresses(spark, sf), path, EXPORT_DATE):
        raise RuntimeError("nothing exported")
    return spark.read.schema(EXPORT_SCHEMA).json(f"{path}/ceps")


@query("K2_json_document_file")
def k2_document(spark, sf):
    """The table as one JSON document; its rows and its metadata, read back line by line."""
    path = scratch_dir(spark, "json_document") + "/ceps.json"
    if not single.write_json_document(addresses(spark, sf), path, EXPORT_DATE, pretty=False):
        raise RuntimeError("nothing exported")
    lines = spark.read.text(path)
    head = lines.where(F.col("value").startswith('{"metadata"')).select(
        F.from_json(F.concat("value", F.lit("]}")), "metadata struct<export_date string, total_ceps long, limit int, offset int>").alias("m"))
    rows = lines.where(F.col("value").rlike('^,?\\{"cep"')).select(F.from_json(F.ltrim("value", F.lit(",")), EXPORT_SCHEMA).alias("r"))
    return rows.crossJoin(F.broadcast(head)).select("r.*", "m.metadata.*")      # one header row


@query("K5_xml_document_file")
def k5_document(spark, sf):
    """The table as one XML document; its rows, read back by row tag."""
    path = scratch_dir(spark, "xml_document")
    if not single.write_xml_document(addresses(spark, sf), f"{path}/ceps", EXPORT_DATE, pretty=False):
        raise RuntimeError("nothing exported")
    return sf_.read_xml_export(spark, path)


@query("K3_export_json_rows")
def k3(spark, sf):
    path = scratch_dir(spark, "export_json_rows")
    rows = addresses(spark, sf).where(F.col("uf") == "SP")
    if not sf_.export_json_rows(rows, path, EXPORT_DATE):
        raise RuntimeError("nothing exported")
    return spark.read.schema(EXPORT_SCHEMA).json(f"{path}/ceps")


@query("K4_json_document")
def k4(spark, sf):
    rows = sf_.export_rows(addresses(spark, sf))
    return rows.select("cep", sd.json_document(rows).alias("document"))


@query("K5_export_xml")
def k5(spark, sf):
    path = scratch_dir(spark, "export_xml")
    if not sf_.export_xml(addresses(spark, sf), path, EXPORT_DATE):
        raise RuntimeError("nothing exported")
    return sf_.read_xml_export(spark, path)


@query("K6_export_xml_rows")
def k6(spark, sf):
    path = scratch_dir(spark, "export_xml_rows")
    rows = addresses(spark, sf).where(F.col("localidade") == "NATION_2")
    if not sf_.export_xml_rows(rows, path, EXPORT_DATE):
        raise RuntimeError("nothing exported")
    return sf_.read_xml_export(spark, path)


@query("K7_xml_document")
def k7(spark, sf):
    rows = sf_.export_rows(addresses(spark, sf))
    return rows.select("cep", sd.xml_document(rows).alias("document"))


@query("K8_write_parquet")
def k8(spark, sf):
    path = sf_.write_parquet(addresses(spark, sf), scratch_dir(spark, "result_parquet"))
    return spark.read.parquet(path)


def _errors(spark, sf):
    return not_found_codes(_valid(spark, sf), V(spark, sf, "responses"))


@query("K11_append_errors")
def k11(spark, sf):
    ts = F.lit(RECORDED_AT).cast("timestamp_ntz")
    path = sf_.append_errors(_errors(spark, sf), None, ts)
    sf_.append_errors(_errors(spark, sf), path, ts)
    return read_error_log(spark, path)


@query("K12_clear_errors")
def k12(spark, sf):
    path = sf_.append_errors(_errors(spark, sf), None, F.lit(RECORDED_AT).cast("timestamp_ntz"))
    sf_.clear_errors(spark, path)
    # the cleared log takes rows again: only those must be there
    later = _errors(spark, sf).where(F.col("error_type") == "api_error")
    sf_.append_errors(later, path, F.lit(RECORDED_AT).cast("timestamp_ntz"))
    return read_error_log(spark, path)


@query("K15_purge_backlog")
def k15(spark, sf):
    m = V(spark, sf, "messages")
    first = m.where(F.col("seq") % 4 != 0)
    handled_path = scratch_dir(spark, "handled")
    om.consumed_until(first, om.drop_bad_messages(first), 500).write.parquet(handled_path)
    # purge: every published message counts as handled from now on; then the rest of the messages arrives
    first.select("seq").write.mode("overwrite").parquet(handled_path)
    return om.backlog(m, spark.read.parquet(handled_path))


@query("K16_declare_tables")
def k16(spark, sf):
    """Declared and bucketed, loaded, merged twice (K9), dropped; the rows that the table's files hold."""
    name, place = f"ceps_{uuid.uuid4().hex[:10]}", scratch_dir(spark, "ceps_table")
    st.declare_tables(spark, name, place, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    a = addresses(spark, sf)
    st.load_table(a.where(~F.col("cep").endswith("7")), name)
    renamed = a.withColumn("logradouro", F.concat(F.lit("Updated "), F.col("logradouro")))
    st.merge_into_declared(spark, name, renamed.where(F.col("cep").endswith("1")), "2024-02-01 00:00:00")
    st.merge_into_declared(spark, name, a.where(F.col("cep").endswith("7")), "2024-03-01 00:00:00")
    table = spark.table(name)
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r.col_name}
    st.drop_tables(spark, name)  # the name goes; the table's files stay at their place
    return spark.read.schema(table.schema).parquet(info["Location"]).select(*ADDRESS_FIELDS, "created_at", "updated_at")


def sink_oracles(o: dict[str, str]) -> dict[str, str]:
    from postalspark.plans import oracles as q
    fields = ", ".join(ADDRESS_FIELDS)
    export = f"SELECT {fields}, {q.iso('created_at')} AS created_at, {q.iso('updated_at')} AS updated_at FROM addresses"
    out = {
        "K1_write_codes_csv": W("SELECT DISTINCT replace(cep, '-', '') AS cep FROM u1_codes", "code_pages", ctes=q.U1),
        "K2_export_json": W(export, "responses", ctes=q.ADDRESSES),
        "K3_export_json_rows": W(export + " WHERE uf = 'SP'", "responses", ctes=q.ADDRESSES),
        "K5_export_xml": W(export, "responses", ctes=q.ADDRESSES),
        "K6_export_xml_rows": W(export + " WHERE localidade = 'NATION_2'", "responses", ctes=q.ADDRESSES),
        "K8_write_parquet": W(f"SELECT {', '.join(PARQUET_FIELDS)} FROM addresses", "responses", ctes=q.ADDRESSES),
        "K2_json_document_file": W(f"""SELECT *, '{EXPORT_DATE}' AS export_date, (SELECT count(*) FROM addresses) AS total_ceps,
  CAST(NULL AS INTEGER) AS "limit", 0 AS "offset" FROM ({export})""", "responses", ctes=q.ADDRESSES),
        "K5_xml_document_file": W(export, "responses", ctes=q.ADDRESSES),
        "K15_purge_backlog": W("SELECT count(*) AS backlog FROM messages WHERE seq % 4 = 0", "messages"),
        "K16_declare_tables": W("SELECT " + ", ".join(
            "CASE WHEN cep LIKE '%1' THEN 'Updated ' || logradouro ELSE logradouro END AS logradouro" if f == "logradouro" else f for f in ADDRESS_FIELDS)
            + """, CASE WHEN cep LIKE '%7' THEN TIMESTAMP '2024-03-01 00:00:00' ELSE created_at END AS created_at,
  CASE WHEN cep LIKE '%7' THEN TIMESTAMP '2024-03-01 00:00:00' WHEN cep LIKE '%1' THEN TIMESTAMP '2024-02-01 00:00:00' ELSE updated_at END AS updated_at
  FROM addresses""", "responses", ctes=q.ADDRESSES),
    }
    struct = ", ".join(f"'{f}': {f}" for f in EXPORT_FIELDS)
    out["K4_json_document"] = W(f"SELECT cep, CAST(to_json({{{struct}}}) AS VARCHAR) AS document FROM ({export})",
                                "responses", ctes=q.ADDRESSES)

    def esc(x):
        return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    xml = " || ".join(f"coalesce('<{f}>' || {esc(f)} || '</{f}>', '')" for f in EXPORT_FIELDS)
    out["K7_xml_document"] = W(f"SELECT cep, '<cep>' || {xml} || '</cep>' AS document FROM ({export})",
                               "responses", ctes=q.ADDRESSES)
    j3 = o["J3_not_found_codes"]
    stamp = q.iso(f"TIMESTAMP '{RECORDED_AT}'")
    out["K12_clear_errors"] = (f"SELECT cep, error_type, error_message, {stamp} AS timestamp, context FROM ({j3}) "
                               f"WHERE error_type = 'api_error'")
    out["K11_append_errors"] = (f"SELECT cep, error_type, error_message, {stamp} AS timestamp, context FROM ({j3}) "
                                f"UNION ALL SELECT cep, error_type, error_message, {stamp} AS timestamp, context FROM ({j3})")
    return out

