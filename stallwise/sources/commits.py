"""Commit records: what makes written folders the table that readers see.

A record is one small file, `commits/N` below a root, created only if it is not
there, so two writers cannot make the same version. Folders become part of a
table by the record that names them; what no record names is not there. A record
whose writer died half way does not parse and commits nothing.
"""

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer committed the version; work again on top of it."""


class CommitLog:
    """The records below `root`, which may be on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def files(self):
        return self.path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """The numbers of all records, half-written ones included."""
        files, folder = self.files(), self.path("commits")
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(int(name) for name in names if name.isdigit())

    def read(self, number: int) -> dict | None:
        """The record, or None if its writer died while it wrote."""
        stream = self.files().open(self.path("commits", str(number)))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def last(self) -> dict | None:
        """The last record that is whole."""
        return next((found for n in reversed(self.numbers()) if (found := self.read(n)) is not None), None)

    def next_number(self) -> int:
        return max(self.numbers(), default=0) + 1

    def commit(self, number: int, record: dict) -> None:
        """Write the record of this version; raises CommitConflict if there is one."""
        try:
            out = self.files().create(self.path("commits", str(number)), False)
        except Py4JJavaError as error:
            if self.files().exists(self.path("commits", str(number))):
                raise CommitConflict(f"version {number} of {self.root} exists") from error
            raise
        try:
            out.write(bytearray(json.dumps(record).encode()))
        finally:
            out.close()

    def folders(self, kind: str) -> list[str]:
        """The names of the folders of a kind, committed or not."""
        files, folder = self.files(), self.path(kind)
        if not files.exists(folder):
            return []
        return [status.getPath().getName() for status in files.listStatus(folder) if status.isDirectory()]

    def delete(self, *parts: str) -> None:
        self.files().delete(self.path(*parts), True)
