"""The address table on plain Parquet: sorted files of disjoint code ranges, versioned by numbered commits.

A commit is one small numbered file that lists every data file of the table with its row count and its least and
greatest code (the manifest), sorted by code. It is put only if its number is free, and the highest number
wins: there is never a moment without a current commit, and a crash before the file leaves the table as it was. Because
the files' code ranges are disjoint and sorted,

* a point read opens one file, a page opens only the files in which its rows lie (by their counts),
* an upsert reads and writes only files in whose range an incoming code falls,
* a writer that loses the race for a number merges again only what the other one replaced.

Codes have eight places, so a table has at most 10^8 rows and a manifest a few hundred files of `LEAF_ROWS` rows.

A commit also records each stream's progress (by checkpoint location) and names the error rows and dead letters
written with it; they are read through the commits, so a micro-batch shows all of its outcomes or none.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postalspark.operators.store import last_rows, merge_addresses
from postalspark.schemas import ADDRESS, ADDRESS_DDL
from postalspark.session import remove_path
from postalspark.sinks.commits import CommitConflict, Folder

COMMITS, ROLLUPS, DATA, ATTACHED = "commits", "rollups", "data", "attached"
#: most rows of a data file
LEAF_ROWS = 1_000_000
#: tries of a writer that keeps losing the race for a number
TRIES = 20


@dataclass(frozen=True)
class Leaf:
    """A data file: its place below the data folder, its rows, and its least and greatest code."""

    path: str
    rows: int
    low: str
    high: str


@dataclass(frozen=True)
class Progress:
    """What a stream has done: its last micro-batch, up to which ``seq`` (None: all of it), and messages handled so far."""

    batch: int = -1
    upto: int | None = None
    handled: int = 0

    def covers(self, batch_id: int) -> bool:
        return batch_id < self.batch or (batch_id == self.batch and self.upto is None)


@dataclass(frozen=True)
class State:
    """A commit: number, leaves in code order, progress by stream, and what was attached."""

    number: int = 0
    leaves: list[Leaf] = field(default_factory=list)
    streams: dict[str, Progress] = field(default_factory=dict)
    attached: dict[str, str] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"leaves": [[f.path, f.rows, f.low, f.high] for f in self.leaves],
                           "streams": {s: [p.batch, p.upto, p.handled] for s, p in self.streams.items()}, "attached": self.attached})

    @staticmethod
    def parse(number: int, text: str) -> State:
        got = json.loads(text)
        return State(number, [Leaf(*f) for f in got["leaves"]], {s: Progress(*p) for s, p in got["streams"].items()}, got["attached"])


class AddressTable:
    def __init__(self, spark: SparkSession, root: str, leaf_rows: int = LEAF_ROWS):
        self.spark, self.root, self.leaf_rows = spark, root.rstrip("/"), leaf_rows
        self._commits = Folder(spark, f"{self.root}/{COMMITS}")
        self._rollups = Folder(spark, f"{self.root}/{ROLLUPS}")

    # -- commits ----------------------------------------------------------------
    def state(self, number: int | None = None) -> State:
        """The commit of that number (default: the current one; number 0 before the first)."""
        if number is None:
            number = max(self._commits.numbers(), default=0)
        return State.parse(number, self._commits.text(number)) if number else State()

    def current_version(self) -> int:
        return max(self._commits.numbers(), default=0)

    def progress(self, stream: str) -> Progress:
        return self.state().streams.get(stream, Progress())

    def _publish(self, before: State, leaves: list[Leaf], stream: str | None = None, progress: Progress | None = None,
                 attached: dict[str, str] | None = None) -> int:
        streams = before.streams | ({stream: progress} if stream is not None and progress is not None else {})
        made = State(before.number + 1, sorted(leaves, key=lambda f: f.low), streams, attached or {})
        self._commits.put(made.number, made.text())
        return made.number

    # -- reads ------------------------------------------------------------------
    def _open(self, leaves: list[Leaf]) -> DataFrame:
        if not leaves:
            return self.spark.createDataFrame([], ADDRESS)
        return self.spark.read.schema(ADDRESS).parquet(*[f"{self.root}/{DATA}/{f.path}" for f in leaves])

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a commit (default: the current one)."""
        return self._open(self.state(version).leaves)

    def count(self) -> int:
        """Rows, from the manifest alone."""
        return sum(f.rows for f in self.state().leaves)

    def lookup(self, code: str) -> DataFrame:
        """the row of a code (hyphens and blanks removed first); opens the one file whose range holds it."""
        clean = code.replace("-", "").replace(" ", "")
        return self._open([f for f in self.state().leaves if f.low <= clean <= f.high]).where(F.col("cep") == F.lit(clean)).limit(1)

    def page(self, limit: int | None = None, offset: int = 0) -> DataFrame:
        """L3: rows ``offset`` to ``offset + limit`` in code order (limit 0 or None: to the end).

        The manifest's counts give the files; inside them rows are picked by their place in the sorted file. Nothing is numbered or sorted
        but the page itself.
        """
        state, offset = self.state(), max(0, int(offset or 0))
        end = offset + int(limit) if limit else sum(f.rows for f in state.leaves)
        opened, first, before = [], {}, 0
        for f in state.leaves:
            if before < end and before + f.rows > offset:
                opened.append(f)
                first[f.path.rsplit("/", 1)[-1]] = before
            before += f.rows
        if not opened:
            return self._open([])
        starts = F.create_map(*[F.lit(x) for pair in first.items() for x in pair])
        at = F.element_at(starts, F.col("_metadata.file_name")).cast("long") + F.col("_metadata.row_index")
        rows = self._open(opened).where((at >= offset) & (at < end))
        return rows.orderBy("cep")

    # -- writes -----------------------------------------------------------------
    @staticmethod
    def _leaf_of(leaves: list[Leaf]) -> Column:
        """Index of the leaf that a code falls in: the last whose least code is not above it, else the first."""
        if not leaves:
            return F.lit(0)
        lows = F.array(*[F.lit(f.low) for f in leaves])
        return F.greatest(F.size(F.filter(lows, lambda low: low <= F.col("cep"))) - 1, F.lit(0))

    def _write(self, rows: DataFrame, part: Column) -> dict[int, list[Leaf]]:
        """Write rows as sorted files per ``part`` (a number per disjoint code range); the files made for each."""
        run = uuid.uuid4().hex
        out = f"{self.root}/{DATA}/{run}"
        (rows.select(*ADDRESS.fieldNames(), part.cast("int").alias("r")).repartitionByRange("r", "cep").sortWithinPartitions("r", "cep")
         .write.option("maxRecordsPerFile", self.leaf_rows).partitionBy("r").parquet(out))
        stored = self.spark.read.schema("cep string, r int").parquet(out)
        sizes = (stored.groupBy("r", F.col("_metadata.file_name").alias("name"))
                 .agg(F.count("*").alias("n"), F.min("cep").alias("low"), F.max("cep").alias("high")).collect())   # a row per file
        made: dict[int, list[Leaf]] = {}
        for s in sizes:
            made.setdefault(s["r"], []).append(Leaf(f"{run}/r={s['r']}/{s['name']}", s["n"], s["low"], s["high"]))
        return made

    def commit(self, rows: DataFrame) -> int:
        """Replace the whole table; returns the commit's number."""
        before = self.state()
        return self._publish(before, [f for made in self._write(rows, F.lit(0)).values() for f in made])

    def _merge(self, state: State, latest: DataFrame, now: str) -> list[tuple[list[Leaf], list[Leaf]]]:
        """Merge rows into the leaves that they fall in: (leaves replaced, leaves made) per run of adjacent leaves."""
        leaf = self._leaf_of(state.leaves)
        touched = sorted(r["leaf"] for r in latest.groupBy(leaf.alias("leaf")).count().collect())   # at most a row per leaf
        if not touched:
            return []
        run, runs = {}, []
        for i in touched:
            if not runs or i != runs[-1][-1] + 1:
                runs.append([])
            runs[-1].append(i)
            run[i] = len(runs) - 1
        old = [[state.leaves[i] for i in some] if state.leaves else [] for some in runs]
        merged = merge_addresses(self._open([f for some in old for f in some]), latest, now)
        part = F.element_at(F.create_map(*[F.lit(x) for pair in run.items() for x in pair]), leaf)
        made = self._write(merged, part)
        return [(old[i], made.get(i, [])) for i in range(len(runs))]

    def upsert(self, source: DataFrame, now: str, batch_id: int | None = None, stream: str = "",
               progress: Progress | None = None, attached: dict[str, str] | None = None) -> int:
        """Merge ``source`` (cep + address fields, optional ``seq``) and commit; returns the distinct codes written.

        A micro-batch of ``stream`` (its checkpoint location) that the table has seen is skipped. ``progress`` and ``attached`` (see
        `attach`) are part of the same commit. Where another writer commits first, its commit is read
        and only rows in files that it replaced are merged again.
        """
        before = self.state()
        if batch_id is not None and before.streams.get(stream, Progress()).covers(batch_id):
            return 0
        if batch_id is not None and progress is None:
            progress = Progress(batch_id, None, before.streams.get(stream, Progress()).handled)
        latest = last_rows(source).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            total, todo, done = latest.count(), latest, []
            for _ in range(TRIES):
                done += [(before, *m) for m in self._merge(before, todo, now)]
                gone = {f.path for _, old, _ in done for f in old}
                leaves = [f for f in before.leaves if f.path not in gone] + [f for _, _, made in done for f in made]
                try:
                    self._publish(before, leaves, stream if batch_id is not None else None, progress, attached)
                    return total
                except CommitConflict:
                    before = self.state()
                    if batch_id is not None and before.streams.get(stream, Progress()).covers(batch_id):
                        return 0
                    there = {f.path for f in before.leaves}
                    stands = [bool(old) and all(f.path in there for f in old) or not old and not before.leaves for _, old, _ in done]
                    lost = [(base, old) for (base, old, _), ok in zip(done, stands, strict=True) if not ok]
                    done = [d for d, ok in zip(done, stands, strict=True) if ok]
                    todo = latest.where(self._in_any(lost)) if lost else latest.limit(0)
            raise CommitConflict(f"{self.root}: {TRIES} commits by others came first")
        finally:
            latest.unpersist()

    def _in_any(self, lost: list[tuple[State, list[Leaf]]]) -> Column:
        """Whether a code falls in one of the given runs of leaves of the given commits."""
        out = F.lit(False)
        for base, old in lost:
            if not old:
                return F.lit(True)
            at = {f.path: i for i, f in enumerate(base.leaves)}
            out = out | self._leaf_of(base.leaves).isin(*[at[f.path] for f in old])
        return out

    # -- rows that belong to a commit ---------------------------------------------
    def attach(self, rows: DataFrame) -> str:
        """Write rows that a commit will name; returns the name. Unnamed folders are nobody's."""
        name = uuid.uuid4().hex
        rows.write.parquet(f"{self.root}/{ATTACHED}/{name}")
        return name

    def attached(self, kind: str, schema: str | StructType) -> DataFrame:
        """All rows of a kind ("errors", "dead") that commits name."""
        rolled = max(self._rollups.numbers(), default=0)
        names = json.loads(self._rollups.text(rolled)).get(kind, []) if rolled else []
        later = [n for n in self._commits.numbers() if n > rolled]
        if later:
            texts = self.spark.read.option("wholetext", True).text([self._commits.file(n) for n in later])
            names += [r[0] for r in texts.select(F.get_json_object("value", f"$.attached.{kind}")).collect() if r[0]]   # a name per commit
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{ATTACHED}/{n}" for n in names])

    # -- upkeep -------------------------------------------------------------------
    def remove_old(self, keep_commits: int = 2) -> list[str]:
        """Delete data files that none of the last ``keep_commits`` commits lists, and older commit files.

        What older commits attached stays: their names go to a roll-up first. Call it when no reader uses an older commit and no writer is at
        work (the grace time is the caller's).
        """
        numbers = self._commits.numbers()
        kept, old = numbers[-keep_commits:], numbers[:-keep_commits]
        if not old:
            return []
        live = {f.path for k in kept for f in self.state(k).leaves}
        rolled = max(self._rollups.numbers(), default=0)
        names: dict[str, list[str]] = json.loads(self._rollups.text(rolled)) if rolled else {}
        gone = set()
        for k in old:
            state = self.state(k)
            gone |= {f.path for f in state.leaves} - live
            if k > rolled:
                for kind, name in state.attached.items():
                    names.setdefault(kind, []).append(name)
        if old[-1] > rolled:
            self._rollups.put(old[-1], json.dumps(names))
        for f in sorted(gone):
            remove_path(self.spark, f"{self.root}/{DATA}/{f}")
        for k in old:
            self._commits.remove(k)
        return sorted(gone)


# -- the table as a catalog table (K16) ---------------------------------------------
def declare_tables(spark: SparkSession, name: str, location: str, buckets: int | None = None) -> None:
    """Create the address table (declared lengths, key NOT NULL, partitioned by uf).

    With ``buckets`` the rows are also bucketed and sorted by ``cep``, so a sort-merge
    join on the code reads the table without shuffling it.
    """
    clustered = f" CLUSTERED BY (cep) SORTED BY (cep) INTO {int(buckets)} BUCKETS" if buckets else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ADDRESS_DDL}) USING parquet PARTITIONED BY (uf)"
              f"{clustered} LOCATION '{location}'")


def drop_tables(spark: SparkSession, name: str) -> None:
    """Drop the address table."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _declared(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r.col_name}


def load_table(rows: DataFrame, name: str) -> None:
    """Insert rows into a declared table; the uf/localidade/created_at indexes become
    partition pruning on uf and min/max statistics from sorting inside files (files of a bucketed table are sorted by code).

    Rows of a bucketed table are dealt by bucket, so a task writes one bucket's file per uf; dealt otherwise, every task would write a
    file for each bucket, tasks times buckets in all.
    """
    spark = rows.sparkSession
    cols = [f.name for f in spark.table(name).schema.fields]
    buckets = int(_declared(spark, name).get("Num Buckets") or 0)
    dealt = (rows.select(*cols).repartition(buckets, "cep") if buckets else
             rows.select(*cols).repartitionByRange("uf", "localidade", "cep").sortWithinPartitions("uf", "localidade", "created_at"))
    dealt.write.insertInto(name)


def merge_into_declared(spark: SparkSession, name: str, source: DataFrame, now: str) -> str:
    """Merge ``source`` (as `AddressTable.upsert` takes it) into a declared, bucketed table; the place of the old files.

    The target is read by its stored buckets, so only the source moves: it is dealt by the same hash into as
    many parts. The merged rows go into a new table of the same declaration, bucket by bucket as they lie, and
    the names are swapped (two catalog steps; a swap that was cut off between them is finished first). Readers that began on the
    old files keep them: their place is returned, for the caller to remove.
    """
    old, new = f"{name}__old", f"{name}__new"
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(new):
        spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    for left in (old, new):
        drop_tables(spark, left)
    info = _declared(spark, name)
    buckets, place = int(info.get("Num Buckets") or 0), info["Location"]
    if not buckets:
        raise ValueError(f"{name} is not declared with buckets")
    latest = last_rows(source).repartition(buckets, "cep")
    merged = merge_addresses(spark.table(name), latest, now)
    declare_tables(spark, new, f"{place.rsplit('--', 1)[0]}--{uuid.uuid4().hex[:12]}", buckets)
    merged.select(*spark.table(new).columns).write.insertInto(new)
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    drop_tables(spark, old)
    return place
