"""Small helpers that several operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.workspace import fresh_path

#: Broadcasts are made only of frames that were measured and are no larger than this.
BROADCAST_BYTES = 16 * 1024 * 1024

#: Rows whose texts a Python task holds as objects at once.
ROWS_AT_ONCE = 128

#: White space of the word definition: the space and U+0009 to U+000D, and nothing else.
GAP = r"[\x20\x09-\x0D]+"

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")


def words(text: str) -> list[str]:
    """Runs of anything but space and U+0009-U+000D; str.split() where it means the same."""
    return _WORD.findall(text) if _OTHER_SPACE.search(text) else text.split()


def word_array(text: Column) -> Column:
    """The same words as a native array; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` computed once, kept as parquet in the cluster's shared folder and read back."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """The named columns of a batch as Python tuples, a few rows at a time in memory."""
    for start in range(0, batch.num_rows, ROWS_AT_ONCE):
        part = batch.slice(start, ROWS_AT_ONCE)
        yield from zip(*(part.column(name).to_pylist() for name in names))


def record_batch(schema: pa.Schema, data: list[tuple]) -> pa.RecordBatch:
    columns = zip(*data) if data else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)
