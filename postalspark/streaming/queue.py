"""A stored message queue whose stream offset is a row position.

Messages lie in Parquet files in the order of arrival. Each arrival is one numbered file (put if absent) that lists its data files with
their row counts, so a message's position is the rows before it, whatever the files hold. The stream source
plans batches by position: at most ``cap`` rows are admitted per trigger, from the middle of one file to the middle of
another if need be. A stream that only works off what is stored may grow its batches: with ``growth`` a batch also takes as many rows
as that share of the rows before it, so a backlog is drained in as many batches as its logarithm, and a sink that rewrites
files with each batch rewrites a bounded multiple of what it holds. Offsets are the query's own checkpointed offsets; a replayed batch reads the same positions.

Executors read the files through pyarrow's file systems (local or mounted folders, hdfs, s3, gs, abfs).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from postalspark.sinks.commits import CommitConflict, Folder
from postalspark.streaming.sources import MESSAGE_FILE

ARRIVALS, DATA = "arrivals", "data"
#: most rows that one task of a micro-batch reads
SLICE_ROWS = 100_000
#: bytes of a row group, the least that a task decodes: a small slice must not read a large file's rows
GROUP_BYTES = 1 << 20
#: bytes that a reader carries to its tasks: what follows a message shorter than a loopback segment (64 KB) waits 40 ms in the socket
#: to the Python worker until the worker's delayed acknowledgement, once a micro-batch
FILL_BYTES = 70_000


def append_messages(messages: DataFrame, root: str, order: str = "seq", tries: int = 20) -> int:
    """One arrival: ``messages`` in ``order``, written by many tasks; returns the rows now in the queue.

    The rows are range partitioned and sorted; file names follow the ranges. Of two writers, the one whose number is
    taken comes after the other.
    """
    spark, root = messages.sparkSession, root.rstrip("/")
    run = uuid.uuid4().hex
    place = f"{root}/{DATA}/{run}"
    messages.repartitionByRange(order).sortWithinPartitions(order).write.option("parquet.block.size", GROUP_BYTES).parquet(place)
    sizes = (spark.read.schema(messages.select(order).schema).parquet(place)
             .groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count("*").alias("n")).collect())   # a row per file
    files = [[f"{run}/{r['name']}", r["n"]] for r in sorted(sizes, key=lambda r: r["name"])]
    arrivals = Folder(spark, f"{root}/{ARRIVALS}")
    for _ in range(tries):
        last = max(arrivals.numbers(), default=0)
        first = json.loads(arrivals.text(last))["end"] if last else 0
        end = first + sum(n for _, n in files)
        try:
            arrivals.put(last + 1, json.dumps({"first": first, "end": end, "files": files}))
            return end
        except CommitConflict:
            continue
    raise CommitConflict(f"{root}: {tries} arrivals by others came first")


def _store(where: str):
    """(pyarrow file system, path in it)"""
    import pyarrow.fs as pafs
    return pafs.FileSystem.from_uri(where) if ":/" in where else (pafs.LocalFileSystem(), where)


@dataclass
class Slice(InputPartition):
    """Rows ``start`` to ``stop`` of a data file."""

    path: str
    start: int
    stop: int


class QueueReader(DataSourceStreamReader):
    def __init__(self, root: str, cap: int, schema: StructType, growth: float = 0.0):
        self.root, self.cap, self.schema, self.growth = root.rstrip("/"), cap, schema, growth
        self.seen = 0                       # where the last planned batch ended
        self.arrivals: dict[str, dict] = {}
        self.fill = bytes(FILL_BYTES)

    def _known(self) -> list[dict]:
        from pyarrow.fs import FileSelector
        store, folder = _store(f"{self.root}/{ARRIVALS}")
        for f in store.get_file_info(FileSelector(folder, allow_not_found=True)):
            if f.base_name.isdigit() and f.base_name not in self.arrivals:
                with store.open_input_stream(f.path) as stream:
                    self.arrivals[f.base_name] = json.loads(stream.read())
        return [self.arrivals[k] for k in sorted(self.arrivals)]

    def initialOffset(self) -> dict:  # noqa: N802 - Spark's name
        return {"row": 0}

    def latestOffset(self) -> dict:  # noqa: N802 - Spark's name
        known = self._known()
        end = known[-1]["end"] if known else 0
        most = max(self.cap, int(self.seen * self.growth)) if self.cap else end
        return {"row": max(self.seen, min(self.seen + most, end))}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        # also called with (last, last) when a query restarts
        a, b = start["row"], end["row"]
        self.seen = b
        out: list[Slice] = []
        for arrival in self._known() if a < b else []:
            at = arrival["first"]
            for path, n in arrival["files"]:
                first, last = max(a - at, 0), min(b - at, n)
                out += [Slice(path, s, min(s + SLICE_ROWS, last)) for s in range(first, last, SLICE_ROWS)]
                at += n
        return out

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema
        wanted = to_arrow_schema(self.schema)
        store, path = _store(f"{self.root}/{DATA}/{partition.path}")
        with store.open_input_file(path) as source:
            file, at = pq.ParquetFile(source), 0
            for group in range(file.num_row_groups):
                n = file.metadata.row_group(group).num_rows
                if at < partition.stop and at + n > partition.start:
                    place = at
                    for batch in file.iter_batches(row_groups=[group], columns=wanted.names):
                        if place >= partition.stop:
                            break
                        first, last = max(partition.start - place, 0), min(partition.stop - place, len(batch))
                        if first < last:
                            part = batch.slice(first, last - first).select(wanted.names)
                            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(part.columns, wanted, strict=True)], schema=wanted)
                        place += len(batch)
                at += n


class QueueSource(DataSource):
    """``readStream.format("message_queue")`` with options ``root``, ``cap`` (rows per trigger; 0: all that arrived) and ``growth``."""

    @classmethod
    def name(cls) -> str:
        return "message_queue"

    def schema(self) -> StructType:
        return MESSAGE_FILE

    def streamReader(self, schema: StructType) -> QueueReader:  # noqa: N802 - Spark's name
        return QueueReader(self.options["root"], int(self.options.get("cap", 0)), schema, float(self.options.get("growth", 0)))


def stream_queue(spark: SparkSession, root: str, cap: int = 0, schema: StructType = MESSAGE_FILE, growth: float = 0.0) -> DataFrame:
    """The stored queue as a stream that admits at most ``cap`` rows per trigger (0: no cap), in queue order.

    With ``growth`` above zero a trigger may also take that share of the rows before it, if this is more than ``cap``.
    """
    spark.dataSource.register(QueueSource)
    return (spark.readStream.format("message_queue").schema(schema).option("root", root)
            .option("cap", int(cap)).option("growth", float(growth)).load())
