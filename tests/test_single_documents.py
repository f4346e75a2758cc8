import json
import os
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from postalspark.session import scratch_dir
from postalspark.sinks import single

DATE = "2024-01-01T00:00:00+00:00"
FIELDS = ["cep", "logradouro", "complemento", "bairro", "localidade", "uf", "ibge", "gia", "ddd", "siafi", "created_at", "updated_at"]


def table(spark, n, parts=4):
    name = F.when(F.col("id") % 5 == 0, F.lit(None)).when(F.col("id") % 5 == 1, F.lit('a "b" \\ <c> & é\nü\t')).otherwise(F.concat(F.lit("Rua "), F.col("id").cast("string")))
    rows = spark.range(n).repartition(parts).select(F.lpad(F.col("id").cast("string"), 8, "0").alias("cep"), name.alias("logradouro"),
                                                    *[F.lit(None).cast("string").alias(f) if f == "gia" else F.lit(f).alias(f) for f in FIELDS[2:10]],
                                                    F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"), F.lit("2024-01-01 00:00:00.5").cast("timestamp_ntz").alias("updated_at"))
    return rows


def plain(n):
    def street(i):
        return None if i % 5 == 0 else 'a "b" \\ <c> & é\nü\t' if i % 5 == 1 else f"Rua {i}"
    return [{"cep": f"{i:08d}", "logradouro": street(i)} | {f: None if f == "gia" else f for f in FIELDS[2:10]}
            | {"created_at": "2024-01-01T00:00:00", "updated_at": "2024-01-01T00:00:00.500000"} for i in range(n)]


@pytest.mark.parametrize("pretty", [True, False])
@pytest.mark.parametrize("n,limit,offset", [(103, None, 0), (103, 10, 0), (103, 7, 90), (1, None, 0)])
def test_json_document(spark, pretty, n, limit, offset):
    path = scratch_dir(spark, "one") + "/out.json"
    assert single.write_json_document(table(spark, n), path, DATE, limit, offset, pretty)
    text = open(path, encoding="utf-8").read()
    got = json.loads(text)
    want = plain(n)[offset:offset + limit if limit else n]
    assert got == {"metadata": {"export_date": DATE, "total_ceps": len(want), "limit": limit, "offset": offset}, "ceps": want}
    assert list(got["ceps"][0]) == FIELDS and ("é" in text) == any(r["logradouro"] and "é" in r["logradouro"] for r in want)
    if pretty:
        # as an indenting writer gives it, but for commas on lines of their own
        assert text.rstrip("\n").replace("\n,\n", ",\n") == json.dumps(got, indent=2, ensure_ascii=False)
    assert os.listdir(os.path.dirname(path)) in (["out.json"], [".out.json.crc", "out.json"], ["out.json", ".out.json.crc"])


def test_json_bare_array_and_row_set(spark):
    path = scratch_dir(spark, "one") + "/rows.json"
    assert single.write_json_document(table(spark, 20), path, DATE, include_metadata=False)
    assert json.load(open(path)) == plain(20)
    assert single.write_json_document(table(spark, 20), path, DATE, with_paging=False, pretty=False)     # takes the place of the old one
    assert json.load(open(path))["metadata"] == {"export_date": DATE, "total_ceps": 20}


def test_an_empty_table_is_refused(spark):
    folder = scratch_dir(spark, "one")
    assert not single.write_json_document(table(spark, 0), folder + "/a.json", DATE)
    assert not single.write_xml_document(table(spark, 5), folder + "/a.xml", DATE, limit=3, offset=9)
    assert not os.path.exists(folder + "/a.json") and not os.path.exists(folder + "/a.xml")


@pytest.mark.parametrize("pretty", [True, False])
@pytest.mark.parametrize("limit,offset,root", [(None, 0, "ceps"), (10, 0, "ceps"), (7, 90, "enderecos")])
def test_xml_document(spark, pretty, limit, offset, root):
    path = scratch_dir(spark, "one") + "/out.xml"
    assert single.write_xml_document(table(spark, 103), path, DATE, limit, offset, pretty, root_element_name=root)
    text = open(path, encoding="utf-8", newline="").read()
    assert text.startswith("<?xml") == pretty
    doc = ET.fromstring(text)
    want = plain(103)[offset:offset + limit if limit else 103]
    meta = {"export_date": DATE, "total_ceps": str(len(want))} | ({"limit": str(limit)} if limit is not None else {}) | ({"offset": str(offset)} if offset else {})
    assert doc.tag == root and [e.tag for e in doc] == ["metadata", "ceps_list"]
    assert {e.tag: e.text for e in doc[0]} == meta
    assert [{e.tag: e.text for e in cep} for cep in doc[1]] == [{k: v for k, v in r.items() if v is not None} for r in want]
    bare = scratch_dir(spark, "one") + "/bare.xml"
    assert single.write_xml_document(table(spark, 4), bare, DATE, pretty=pretty, include_metadata=False)
    assert [e.tag for e in ET.parse(bare).getroot()] == ["ceps_list"]


def test_the_body_is_written_by_many_tasks(spark, monkeypatch):
    found = []
    join = single._Files.join
    monkeypatch.setattr(single._Files, "join", lambda self, parts, target: found.append(parts) or join(self, parts, target))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = scratch_dir(spark, "one") + "/out.json"
        assert single.write_json_document(table(spark, 400), path, DATE)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum("/body/" in p for p in found[0]) >= 3 and json.load(open(path))["ceps"] == plain(400)
