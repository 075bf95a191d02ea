"""Counts kept beside a changing table and moved on by its changes.

A batch of changes becomes one file of sums per key, up for rows that came and down for rows that went, and counts
from the moment it is entered in a log.  What the table holds is the sum of the entries; ``compact`` adds them up
into one.  A batch is summed before it is shuffled, so a hot key is one row for each task, and a retried batch is
recognised by its number.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.sources.commits import CommitLog

COUNT = "n"


class KeptCounts:
    """Rows per key of a table that changes, in one folder; keys may be null."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType):
        """``schema``: names and types of the keys, the same each time the folder is opened."""
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.keys = schema.names
        self.schema = T.StructType([*schema, T.StructField(COUNT, T.LongType())])
        self.log = CommitLog(spark, f"{self.folder}/log")
        self.sums = CommitLog(spark, f"{self.folder}/sums")

    def _last(self) -> tuple[int, int]:
        """The last batch that counts, and the last that is summed up."""
        summed = max(self.sums.numbers(), default=-1)
        return max([summed, *self.log.numbers()]), summed

    def _write(self, df: DataFrame) -> str:
        name = uuid.uuid4().hex
        df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]).write.parquet(f"{self.folder}/data/{name}")
        return name

    def _added_up(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(F.sum(COUNT).alias(COUNT)).filter(F.col(COUNT) != 0)

    def apply(self, batch: int, came: DataFrame | None = None, went: DataFrame | None = None) -> bool:
        """Count the rows of a batch; False, and nothing done, if it counts already.

        A changed row is one that went and one that came.  Batches come in the order of their numbers.
        """
        if batch <= self._last()[0]:
            return False
        parts = [df.select(*self.keys, F.lit(sign).cast("long").alias(COUNT)) for df, sign in ((came, 1), (went, -1)) if df is not None]
        if not parts:
            parts = [self.spark.createDataFrame([], self.schema)]
        both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        self.log.publish(batch, [self._write(self._added_up(both))])
        return True

    def _names(self) -> list[str]:
        _, summed = self._last()
        names = self.sums.read(summed) if summed >= 0 else []
        return names + [name for number in self.log.numbers() if number > summed for name in self.log.read(number)]

    def read(self) -> DataFrame:
        """(keys, n) of all keys that have rows."""
        names = self._names()
        if not names:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/data/{name}" for name in names])
        return self._added_up(rows)

    def compact(self) -> None:
        """Add up all batches so far; readers see the entries or their sum, which are the same."""
        last, summed = self._last()
        if last > summed:
            self.sums.publish(last, [self._write(self.read())])
