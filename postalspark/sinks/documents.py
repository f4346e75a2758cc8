"""Export documents as values (K4 JSON, K7 XML), per row, plus per-group files.

A whole-table document is not built in one task: per-row values are
computed in place, and per-group documents are written as one folder per
group by the partitioned writer (each group spread over many tasks).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postalspark.schemas import EXPORT_FIELDS

XML_PROLOG = '<?xml version="1.0" ?>\n'


def _row(rows: DataFrame) -> Column:
    return F.struct(*[F.col(c) for c in EXPORT_FIELDS if c in rows.columns])


def json_document(rows: DataFrame, pretty: bool = False) -> Column:
    """K4: the row as a JSON object, NULL fields kept, non-ASCII text kept."""
    opts = {"ignoreNullFields": "false"}
    if pretty:
        opts["pretty"] = "true"
    return F.to_json(_row(rows), opts)


def xml_document(rows: DataFrame, pretty: bool = False) -> Column:
    """K7: the row as ``<cep>…</cep>`` with NULL fields left out; pretty adds a prolog."""
    x = F.to_xml(_row(rows), {"rowTag": "cep"})
    if pretty:
        return F.concat(F.lit(XML_PROLOG), x)
    return F.regexp_replace(x, r">\n\s*<", "><")


def write_json_by_group(rows: DataFrame, path: str, group: str = "uf") -> str:
    """K4 per group: one folder per group value, JSON Lines inside, NULL fields kept."""
    # range partitions on (group, cep): a dominant group is written by many tasks
    (rows.repartitionByRange(group, "cep").write.mode("overwrite").partitionBy(group)
     .option("ignoreNullFields", False).json(path))
    return path
