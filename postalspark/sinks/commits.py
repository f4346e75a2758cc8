"""Numbered commit files: put if absent, on every kind of store that can do it."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

#: schemes whose rename is one step of the name service and refuses an existing target
RENAME_REFUSES = ("hdfs", "viewfs", "abfs", "abfss", "ofs")
#: schemes that take a conditional create (the writer sends "only if there is none")
CONDITIONAL = ("s3a", "s3")


class CommitConflict(RuntimeError):
    """Another writer made the commit that this one was about to make; read again and retry."""


class Folder:
    """A folder of small numbered text files, of which each number is written once."""

    def __init__(self, spark: SparkSession, where: str):
        self.spark, self.where = spark, where.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.fs = self.path(self.where).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, where: str):
        return self.jvm.org.apache.hadoop.fs.Path(where)

    def numbers(self) -> list[int]:
        if not self.fs.exists(self.path(self.where)):
            return []
        names = (f.getPath().getName() for f in self.fs.listStatus(self.path(self.where)))
        return sorted(int(n) for n in names if n.isdigit())

    def file(self, number: int) -> str:
        return f"{self.where}/{number:020d}"

    def text(self, number: int) -> str:
        stream = self.fs.open(self.path(self.file(number)))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write(self, stream, text: str) -> None:
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def put(self, number: int, text: str) -> None:
        """Write the file of ``number`` whole, or raise `CommitConflict` if the number is taken.

        A local file system takes the finished draft by a hard link, which fails if the name exists; name-service
        stores by their rename; object stores by a conditional create. Other schemes are refused: none of
        their calls is known to be one step.
        """
        place, scheme = self.path(self.file(number)), self.fs.getScheme()
        conflict = CommitConflict(f"{self.file(number)} exists already")
        if scheme in CONDITIONAL:
            builder = self.fs.createFile(place).overwrite(False).must("fs.option.create.conditional.overwrite", True)
            try:
                self._write(builder.build(), text)
            except Exception as error:
                if self.fs.exists(place):
                    raise conflict from error
                raise
            return
        if scheme != "file" and scheme not in RENAME_REFUSES:
            raise NotImplementedError(f"no put-if-absent is known for {scheme}:// ({self.where})")
        self.fs.mkdirs(self.path(self.where))
        draft = self.path(f"{self.where}/.{number:020d}-{uuid.uuid4().hex}")
        self._write(self.fs.create(draft, False), text)
        try:
            if scheme == "file":
                files, paths = self.jvm.java.nio.file.Files, self.jvm.java.nio.file.Paths
                try:
                    files.createLink(paths.get(place.toUri().getPath(), self._none()), paths.get(draft.toUri().getPath(), self._none()))
                except Exception as error:
                    if self.fs.exists(place):
                        raise conflict from error
                    raise
            elif not self.fs.rename(draft, place):
                raise conflict
        finally:
            self.fs.delete(draft, False)

    def _none(self):
        return self.spark.sparkContext._gateway.new_array(self.jvm.java.lang.String, 0)

    def remove(self, number: int) -> None:
        self.fs.delete(self.path(self.file(number)), False)
