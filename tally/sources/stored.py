"""Stored tables that can be updated: changed files are written anew, a manifest is published last.

A version is a list of parquet files.  An update finds the files that hold changed keys, writes only
those again and publishes a list in which they are replaced.  Until then readers see the old list, so a killed
run costs nothing but files that no version names.  Files cover ranges of the key, so changes of
neighbouring keys meet in few files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.operators.changes import apply_updates, latest_per_key
from tally.operators.joins import join_dim
from tally.sources.commits import CommitLog
from tally.workspace import fresh_path


@dataclass
class Update:
    """What a write did: the version it made and how many files it wrote anew, kept and added."""

    version: int
    rewritten: int
    kept: int
    added: int


class StoredTable:
    """A versioned table in one folder: ``data`` holds files, ``log`` one manifest a version."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.log = CommitLog(spark, f"{self.folder}/log")

    @classmethod
    def create(cls, df: DataFrame, folder: str, key: str | Sequence[str], files: int | None = None) -> StoredTable:
        """Store ``df`` as version 0, in ``files`` ranges of ``key`` (by default as many as adaptive execution makes)."""
        made = cls(df.sparkSession, folder)
        if made.log.numbers():
            raise ValueError(f"{folder} holds a table already")
        key = [key] if isinstance(key, str) else list(key)
        added = made._write(df, key, files)
        made._publish(0, df.schema, key, added)
        return made

    def _publish(self, version: int, schema: T.StructType, key: Sequence[str], files: Sequence[str]) -> None:
        self.log.publish(version, [json.dumps({"schema": schema.json(), "key": list(key)}), *files])

    def _manifest(self, version: int | None = None) -> tuple[int, T.StructType, list[str], list[str]]:
        numbers = self.log.numbers()
        if not numbers:
            raise ValueError(f"{self.folder} holds no table")
        version = numbers[-1] if version is None else version
        head, *files = self.log.read(version)
        told = json.loads(head)
        return version, T.StructType.fromJson(json.loads(told["schema"])), told["key"], files

    def _write(self, df: DataFrame, key: Sequence[str], files: int | None) -> list[str]:
        """New files in key order; rows of one key may cross a border, so a hot key is split."""
        rest = [F.xxhash64(*df.columns)]
        ranged = df.repartitionByRange(*key, *rest) if files is None else df.repartitionByRange(files, *key, *rest)
        name = uuid.uuid4().hex
        ranged.sortWithinPartitions(*key).write.parquet(f"{self.folder}/data/{name}")
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/data/{name}")
        listed = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
        return sorted(f"{name}/{f.getPath().getName()}" for f in listed if f.getPath().getName().endswith(".parquet"))

    def _read(self, files: Sequence[str], schema: T.StructType) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/data/{f}" for f in files])

    def version(self) -> int:
        return self._manifest()[0]

    def files(self, version: int | None = None) -> list[str]:
        return self._manifest(version)[3]

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of ``version``, by default the latest."""
        _, schema, _, files = self._manifest(version)
        return self._read(files, schema)

    def append(self, df: DataFrame) -> Update:
        """Add rows in files of their own."""
        version, schema, key, files = self._manifest()
        added = self._write(df.select(*schema.names), key, None)
        self._publish(version + 1, schema, key, [*files, *added])
        return Update(version + 1, 0, len(files), len(added))

    def update(
        self, changes: DataFrame, cols: Sequence[str], order: Column | None = None, limit: int | None = None
    ) -> Update:
        """Take ``cols`` from the change of each key, as :func:`tally.operators.apply_updates` does.

        Only files with a changed key are written.  Changes that meet no row make no new version.  If another
        writer publishes in between, this one fails with ``Conflict`` and may be repeated.
        """
        version, schema, key, files = self._manifest()
        if not files:
            return Update(version, 0, 0, 0)
        if order is not None:
            changes = latest_per_key(changes, key, order)
        path = fresh_path(self.spark, "changes")  # read several times below
        changes.select(*dict.fromkeys([*key, *cols])).dropna(subset=key).write.parquet(path)
        changes = self.spark.read.parquet(path)
        wanted = changes.select(*key).distinct()
        low, high = wanted.agg(F.min(key[0]), F.max(key[0])).first()
        if low is None:
            return Update(version, 0, len(files), 0)

        # the span of the changes reaches the scan, so files and row groups outside are not read
        held = self._read(files, schema).select(*key, F.col("_metadata.file_path").alias("_file"))
        held = held.filter(F.col(key[0]).between(F.lit(low), F.lit(high)))
        found = join_dim(held, wanted, key, "left_semi", limit=limit).select("_file").distinct().collect()
        touched = {"/".join(row._file.split("/")[-2:]) for row in found}  # no more than there are files
        if not touched:
            return Update(version, 0, len(files), 0)
        kept = [f for f in files if f not in touched]
        new = apply_updates(self._read(sorted(touched), schema), changes, key, cols, limit=limit)
        added = self._write(new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]), key, len(touched))
        self._publish(version + 1, schema, key, [*kept, *added])
        return Update(version + 1, len(touched), len(kept), len(added))

    def vacuum(self, keep: int = 1) -> int:
        """Forget all but the last ``keep`` versions and delete files that none of these names.

        For times without writers: files of an update under way are not named yet.
        """
        numbers = self.log.numbers()
        for number in numbers[:-keep]:
            self.log.forget(number)
        named = {file for number in numbers[-keep:] for file in self.files(number)}
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/data")
        files, gone = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), 0
        for run in files.listStatus(folder):
            for file in files.listStatus(run.getPath()):
                name = file.getPath().getName()
                if name.endswith(".parquet") and f"{run.getPath().getName()}/{name}" not in named:
                    files.delete(file.getPath(), False)
                    gone += 1
        return gone
