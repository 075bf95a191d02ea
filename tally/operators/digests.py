"""Comparing two images of a table by digests, so that only what differs is moved.

1. Each image is summed up by key range: row count and the exclusive or of 128 bits a row.  A task sends a few
   numbers for each range it holds.  A range whose sums agree is done with.
2. In the ranges that differ, every row sends its key and digest; keys whose digests agree are done with.
3. Only rows of the keys that are left move their columns.

The number of ranges is bounded whatever the table's size, and so is the list of those that differ.
Ranges of an integer key are stretches of it, so a table stored in key order sends one row for many; other keys are
dealt over the ranges by hash.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.operators.joins import join_dim
from tally.workspace import fresh_path

ROWS_PER_RANGE = 16
MOST_RANGES = 1 << 18  # 16 bytes each: a broadcast of at most 4 MB


def _digest(columns: Sequence[str]) -> list[Column]:
    """128 bits of all values and of which are missing."""
    values = [value for name in columns for value in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    return [F.xxhash64(*values).alias("_d1"), F.xxhash64(F.lit(1), *values).alias("_d2")]


def _key_range(before: DataFrame, after: DataFrame, keys: Sequence[str], rows_per_range: int, most: int) -> Column:
    integer = len(keys) == 1 and all(isinstance(df.schema[keys[0]].dataType, T.IntegralType) for df in (before, after))
    if not integer:
        rows = before.count() + after.count()
        return F.pmod(F.xxhash64(*keys), F.lit(min(most, rows // (2 * rows_per_range) + 1)))
    bounds = [F.min(keys[0]), F.max(keys[0]), F.count(keys[0])]
    found = [df.agg(*bounds).first() for df in (before, after)]
    lows, highs = [r[0] for r in found if r[0] is not None], [r[1] for r in found if r[1] is not None]
    if not lows:
        return F.lit(0).cast("long")
    ranges = min(most, max(r[2] for r in found) // rows_per_range + 1)
    width = max(1, -(-(max(highs) - min(lows) + 1) // ranges))
    # as decimals, for keys at both ends of the long range
    apart = F.col(keys[0]).cast("decimal(20,0)") - F.lit(Decimal(min(lows)))
    return F.call_function("div", apart, F.lit(Decimal(width)))


def differing(
    before: DataFrame,
    after: DataFrame,
    key: str | Sequence[str],
    rows_per_range: int = ROWS_PER_RANGE,
    most_ranges: int = MOST_RANGES,
    limit: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The rows of both images whose key is not the same in both; columns as in ``before``.

    Rows with a missing key part are always among them, as such keys are equal to none.  A key with several rows is
    among them unless its range agrees as a whole.  Both images are read three times, so give
    stored tables; two small results are kept in the shared folder.
    """
    keys = [key] if isinstance(key, str) else list(key)
    spark, columns = before.sparkSession, before.columns
    after = after.select(*columns)
    whole = F.lit(True)
    for name in keys:
        whole &= F.col(name).isNotNull()
    place = _key_range(before, after, keys, rows_per_range, most_ranges).alias("_range")

    def digests(df: DataFrame, sign: int) -> DataFrame:
        return df.filter(whole).select(*keys, place, *_digest(columns), F.lit(sign).alias("_sign"))

    def unlike(df: DataFrame, by: Sequence[str]) -> DataFrame:
        """Groups whose rows do not cancel out; a task adds up its own rows first."""
        sums = [F.bit_xor("_d1").alias("_x1"), F.bit_xor("_d2").alias("_x2"), F.sum("_sign").alias("_s"), F.count("*").alias("_n")]
        apart = (F.col("_x1") != 0) | (F.col("_x2") != 0) | (F.col("_s") != 0)
        if by == keys:
            apart |= F.col("_n") > 2
        return df.groupBy(*by).agg(*sums).filter(apart).select(*by)

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = fresh_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    both = digests(before, 1).unionByName(digests(after, -1))
    ranges = F.broadcast(kept(unlike(both, ["_range"]), "unlike-ranges"))  # at most ``most_ranges`` rows
    changed = kept(unlike(both.join(ranges, "_range", "left_semi"), keys), "unlike-keys")

    def rows(df: DataFrame) -> DataFrame:
        near = df.filter(whole).withColumn("_range", place).join(ranges, "_range", "left_semi").drop("_range")
        found = join_dim(near, changed, keys, "left_semi", spread_by=keys, limit=limit)
        return found.select(*columns).unionByName(df.filter(~whole))

    return rows(before), rows(after)
