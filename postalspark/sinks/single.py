"""One JSON or XML document of a whole table (K2/K3, K5/K6): fragments written by many tasks, joined on the file system.

Rows are range partitioned by code and sorted; each task writes its rows as text, so the part files in name order are the
document's body in code order. Header, separators and footer are small fragments of their own. The parts become one file by the file
system: by its own concatenation where it has one (no byte is copied), else by copying the parts' bytes one after
another in the driver's JVM (a single file has a single writer there). No row is parsed or held outside the tasks. The document appears
under its name whole, by a rename.
"""

from __future__ import annotations

import json
import uuid
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postalspark.sinks.documents import XML_PROLOG
from postalspark.sinks.files import export_rows
from postalspark.sources.store import scan_addresses

#: schemes whose file system joins files without copying them
CONCATENATES = ("hdfs", "viewfs")
#: spaces before a row and before its fields in pretty documents
ROW_INDENT, FIELD_INDENT = 4, 6


class _Files:
    """The file system of a document, through the session's Hadoop configuration."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.at(path).getFileSystem(self.conf)

    def at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def put(self, path: str, text: str) -> None:
        out = self.fs.create(self.at(path), True)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()

    def parts(self, folder: str) -> list[str]:
        """Part files that hold something, in name order."""
        found = [f for f in self.fs.listStatus(self.at(folder)) if f.getPath().getName().startswith("part-") and f.getLen() > 0]
        return sorted(f"{folder}/{f.getPath().getName()}" for f in found)

    def join(self, parts: list[str], target: str) -> None:
        """One file of the parts' bytes, in order; the parts may be used up."""
        if self.fs.getScheme() in CONCATENATES:
            array = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Path"), len(parts) - 1)
            for i, p in enumerate(parts[1:]):
                array[i] = self.at(p)
            self.fs.concat(self.at(parts[0]), array)
            self.fs.rename(self.at(parts[0]), self.at(target))
            return
        out = self.fs.create(self.at(target), True)
        try:
            for p in parts:
                stream = self.fs.open(self.at(p))
                try:
                    self.jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
                finally:
                    stream.close()
        finally:
            out.close()


def _assemble(rows: DataFrame, line: Column, path: str, between: str, ends) -> int:
    """Write ``line`` of each row in code order and join them: ``ends(n)`` gives the text before and after; the number of rows.

    Nothing is written for no rows.
    """
    spark, work = rows.sparkSession, f"{path}.parts-{uuid.uuid4().hex}"
    files, seen = _Files(spark, path), Observation()
    ordered = rows.repartitionByRange("cep").sortWithinPartitions("cep")
    # within a part every row but the first follows a separator; between parts it is a fragment of its own
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    text = F.when(position == 0, line).otherwise(F.concat(F.lit(between), line))
    counted = ordered.observe(seen, F.count(F.lit(1)).alias("n")).select(text.alias("value"))
    try:
        counted.write.option("lineSep", "\n").text(f"{work}/body")
        n = int(seen.get["n"])
        if not n:
            return 0
        before, after = ends(n)
        files.put(f"{work}/0", before)
        files.put(f"{work}/9", after)
        parts = [f"{work}/0"]
        for i, p in enumerate(files.parts(f"{work}/body")):
            if i and between:
                files.put(f"{work}/between-{i}", between)
                parts.append(f"{work}/between-{i}")
            parts.append(p)
        draft = f"{work}/document"
        files.join([*parts, f"{work}/9"], draft)
        target = files.at(path)
        if target.getParent() is not None:
            files.fs.mkdirs(target.getParent())
        files.fs.delete(target, False)
        if not files.fs.rename(files.at(draft), target):
            raise OSError(f"{path} could not be put in place")
        return n
    finally:
        files.fs.delete(files.at(work), True)


def _indented(text: Column, spaces: int) -> Column:
    """``text`` with its lines after the first moved in."""
    return F.regexp_replace(text, r"\n", "\n" + " " * spaces)


def _json_value(column: str) -> Column:
    """A text as JSON: quoted and escaped, or null."""
    quoted = F.to_json(F.struct(F.col(column).alias("v")), {"ignoreNullFields": "false"})
    return F.substring(quoted, 6, 2 ** 31 - 1).substr(F.lit(1), F.length(quoted) - 6)


def _pretty_row(rows: DataFrame) -> Column:
    pad, inner = " " * ROW_INDENT, " " * FIELD_INDENT
    fields = [F.concat(F.lit(f'{inner}"{c}": '), _json_value(c)) for c in rows.columns]
    return F.concat(F.lit(pad + "{\n"), F.concat_ws(",\n", *fields), F.lit("\n" + pad + "}"))


def write_json_document(addresses: DataFrame, path: str, export_date: str, limit: int | None = None, offset: int = 0, pretty: bool = True,
                        include_metadata: bool = True, with_paging: bool = True) -> bool:
    """K2 as one document: ``{"metadata": {...}, "ceps": [...]}`` or the bare array; False (and no file) when empty.

    NULL fields are written as null, limit and offset always (`with_paging`; a given row set, K3, has neither), non-ASCII text as it is.
    ``pretty`` indents by two spaces.
    """
    rows = export_rows(scan_addresses(addresses, limit, offset) if limit or offset else addresses)
    compact = F.to_json(F.struct(*[F.col(c) for c in rows.columns]), {"ignoreNullFields": "false"})

    def ends(n: int) -> tuple[str, str]:
        if not include_metadata:
            return "[\n", "]\n"
        metadata = {"export_date": export_date, "total_ceps": n} | ({"limit": limit, "offset": offset} if with_paging else {})
        if pretty:
            text = json.dumps(metadata, indent=2, ensure_ascii=False).replace("\n", "\n  ")
            return f'{{\n  "metadata": {text},\n  "ceps": [\n', "  ]\n}\n"
        return f'{{"metadata": {json.dumps(metadata, ensure_ascii=False)}, "ceps": [\n', "]}\n"

    return _assemble(rows, _pretty_row(rows) if pretty else compact, path, ",\n" if pretty else ",", ends) > 0


def _xml_row(rows: DataFrame, pretty: bool) -> Column:
    """``<cep>`` with its fields that are not NULL."""
    def text(c: str) -> Column:
        clean = F.col(c).cast("string")
        for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            clean = F.replace(clean, F.lit(a), F.lit(b))
        return clean

    indent = ("\n" + " " * FIELD_INDENT) if pretty else ""
    fields = [F.coalesce(F.concat(F.lit(f"{indent}<{c}>"), text(c), F.lit(f"</{c}>")), F.lit("")) for c in rows.columns]
    start, end = (" " * ROW_INDENT + "<cep>", "\n" + " " * ROW_INDENT + "</cep>") if pretty else ("<cep>", "</cep>")
    return F.concat(F.lit(start), *fields, F.lit(end))


def write_xml_document(addresses: DataFrame, path: str, export_date: str, limit: int | None = None, offset: int = 0, pretty: bool = True,
                       include_metadata: bool = True, root_element_name: str = "ceps", with_paging: bool = True) -> bool:
    """K5 as one document: root, ``metadata`` and ``ceps_list`` with a ``cep`` per row; False (and no file) when empty.

    NULL fields are left out, the metadata holds limit only if set and offset only if above 0; ``pretty`` adds the prolog and indents.
    """
    rows = export_rows(scan_addresses(addresses, limit, offset) if limit or offset else addresses)
    gap = "\n" if pretty else ""

    def ends(n: int) -> tuple[str, str]:
        def element(name: str, value) -> str:
            return f"{'    ' if pretty else ''}<{name}>{escape(str(value))}</{name}>{gap}"

        pad = "  " if pretty else ""
        head = f"{XML_PROLOG if pretty else ''}<{root_element_name}>{gap}"
        if include_metadata:
            head += f"{pad}<metadata>{gap}" + element("export_date", export_date) + element("total_ceps", n)
            if with_paging and limit is not None:
                head += element("limit", int(limit))
            if with_paging and offset > 0:
                head += element("offset", int(offset))
            head += f"{pad}</metadata>{gap}"
        return f"{head}{pad}<ceps_list>{gap}", f"{pad}</ceps_list>{gap}</{root_element_name}>\n"

    return _assemble(rows, _xml_row(rows, pretty), path, "", ends) > 0
