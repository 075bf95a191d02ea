"""A log of numbered entries that readers trust: an entry is whole or it is not there.

An entry is written under a passing name and renamed last.  Where the file system renames atomically
(HDFS and the like) a reader sees all of it or nothing; object stores need a client with such a rename.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Conflict(Exception):
    """Another writer has published this number."""


class CommitLog:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _path(self, name: str = ""):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def _files(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """The published numbers, in order."""
        files = self._files()
        if not files.exists(self._path()):
            return []
        names = [status.getPath().getName() for status in files.listStatus(self._path())]
        return sorted(int(name) for name in names if name.isdigit())

    def read(self, number: int) -> list[str]:
        return [row.value for row in self.spark.read.text(f"{self.folder}/{number:020d}").collect()]

    def publish(self, number: int, lines: list[str]) -> None:
        files, target = self._files(), self._path(f"{number:020d}")
        if files.exists(target):
            raise Conflict(f"{self.folder} has entry {number} already")
        passing = self._path(f"tmp-{uuid.uuid4().hex}")
        out = files.create(passing, False)
        out.write(bytearray("".join(line + "\n" for line in lines).encode()))
        out.close()
        if not files.rename(passing, target):
            files.delete(passing, False)
            raise Conflict(f"{self.folder} has entry {number} already")

    def forget(self, number: int) -> None:
        self._files().delete(self._path(f"{number:020d}"), False)
