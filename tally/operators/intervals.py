"""Semi-join of points with ranges: ranges are cut into bins, points meet the ranges of their bin only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.operators.joins import BROADCAST_BYTES, _cut, fits_broadcast, hot_keys

MOST_BINS = 1_000_000  # a range is cut into no more


def _number(df: DataFrame, name: str) -> Column:
    """A number that grows with the value; dates count in days, times in seconds."""
    kind, column = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return column.cast("timestamp").cast("double")
    if isinstance(kind, T.NumericType):
        return column.cast("double")
    raise TypeError(f"no bins for {kind.simpleString()}")


def semi_intervals(
    left: DataFrame,
    right: DataFrame,
    point: str,
    low: str,
    high: str,
    on: Sequence[str] = (),
    residual: Column | None = None,
    spread_by: Sequence[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Rows of ``left`` whose ``point`` lies in a range ``low`` to ``high`` of ``right``, once each.

    Both ends belong to the range and a missing end is open.  ``on`` names columns that must be equal besides; ``residual`` is
    a further condition.  The sides' other columns must differ in name.  A missing point is in no range.

    The bins are half as wide as the average range, so ranges become some three rows each, a long one at
    most ``MOST_BINS``; a join on bin (and ``on``) follows, never a loop over all ranges.  The ranges are
    broadcast if they measure small, otherwise bins that hold much of ``left`` are split.
    """
    on = list(on)
    first, last = left.agg(F.min(_number(left, point)), F.max(_number(left, point))).first()
    if first is None:
        return left.limit(0)
    numbered = right.withColumn("_low", F.greatest(F.coalesce(_number(right, low), F.lit(first)), F.lit(first)))
    numbered = numbered.withColumn("_high", F.least(F.coalesce(_number(right, high), F.lit(last)), F.lit(last)))
    reached = numbered.filter("_low <= _high")  # what lies outside the points meets none
    total, ranges = reached.agg(F.sum(F.col("_high") - F.col("_low")), F.count("*")).first()
    if not ranges:
        return left.limit(0)
    span = last - first
    width = max(total / (2 * ranges), span / MOST_BINS) or 1.0

    def place(number: Column) -> Column:
        return F.floor((number - F.lit(first)) / F.lit(width))

    names = {c: f"_on_{i}" for i, c in enumerate(on)}
    binned = reached.withColumn("_in_bin", F.explode(F.sequence(place(F.col("_low")), place(F.col("_high"))))).drop("_low", "_high")
    binned = binned.withColumnsRenamed(names)
    points = left.withColumn("_bin", place(_number(left, point)))
    left_keys, right_keys = [*on, "_bin"], [*names.values(), "_in_bin"]
    inside = (F.col(low).isNull() | (F.col(low) <= F.col(point))) & (F.col(high).isNull() | (F.col(point) <= F.col(high)))
    matched = inside if residual is None else inside & residual
    for mine, theirs in zip(left_keys, right_keys):
        matched = (F.col(mine) == F.col(theirs)) & matched
    if fits_broadcast(binned, BROADCAST_BYTES if limit is None else limit):
        return points.join(F.broadcast(binned), matched, "left_semi").drop("_bin")
    hot = hot_keys(points.select(*left_keys), left_keys)
    if not hot:
        return points.join(binned, matched, "left_semi").drop("_bin")
    split, repeated = _cut(points, binned, left_keys, right_keys, hot, spread_by)
    repeated = repeated.withColumnRenamed("_piece", "_own_piece")
    return split.join(repeated, matched & (F.col("_piece") == F.col("_own_piece")), "left_semi").drop("_piece", "_bin")
