"""Joins that hold when one key owns a large share of the rows.

Three ways, in order of preference:

* aggregate the fact to the join key first, so a hot key becomes one row per task
  (done by the reports themselves, followed by an ordinary join);
* broadcast the other side after measuring it;
* otherwise split only the hot keys, and only over as many tasks as they need.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
SMALLEST_HOT_SHARE = 1 / 2000  # at most 2000 keys can exceed it
TRACKED_KEYS = 16384
SKETCH_GROUPS = 256

_FIXED_WIDTH = 16

Hot = list[tuple[int, int]]  # (key hash, pieces)


def _names(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def fits_broadcast(df: DataFrame, limit: int) -> bool:
    """Measure ``df``: the row count first (file footers only, for a plain table), then its text."""
    plain = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    variable = [f.name for f in df.schema if not isinstance(f.dataType, plain)]
    fixed = _FIXED_WIDTH * (len(df.columns) + 1)
    rows = df.count()
    if rows * fixed > limit:
        return False
    if not variable or rows == 0:
        return True
    sizes = [F.sum(F.octet_length(F.col(f"`{name}`").cast("string"))) for name in variable]
    text = sum(size or 0 for size in df.agg(*[s.alias(f"s{i}") for i, s in enumerate(sizes)]).first())
    return rows * fixed + text <= limit


def hot_keys(df: DataFrame, on: str | Sequence[str], share: float | None = None) -> Hot:
    """(hash, pieces) of each key holding more than ``share`` of the rows.

    One pass with frequent-items sketches, merged in groups and then once more, so nothing is
    shuffled by key and no task merges the sketches of a whole table.  What comes back is
    bounded by 1 / ``share`` numbers.  The answer only decides how work is spread; a key that
    is missed is still joined in full.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = share if share is not None else max(2 / max(partitions, 8), SMALLEST_HOT_SHARE)
    tracked = F.lit(TRACKED_KEYS)
    found = (
        df.groupBy((F.spark_partition_id() % SKETCH_GROUPS).alias("_group"))
        .agg(
            F.count("*").alias("_rows"),
            F.call_function("approx_top_k_accumulate", F.xxhash64(*_names(on)), tracked).alias("_sketch"),
        )
        .groupBy(F.lit("all"))  # no rows, rather than an empty sketch, for an empty table
        .agg(
            F.sum("_rows").alias("rows"), F.call_function("approx_top_k_combine", "_sketch", tracked).alias("_sketch")
        )
        .select("rows", F.call_function("approx_top_k_estimate", "_sketch", F.lit(int(1 / share) + 1)).alias("top"))
        .first()
    )
    if found is None:
        return []
    shares = [(item["item"], item["count"] / found["rows"]) for item in found["top"]]
    return [(key, max(2, round(part * partitions) + 1)) for key, part in shares if part > share]


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    spread_by: Sequence[str] | None = None,
    share: float | None = None,
    hot_from: DataFrame | Callable[[], Hot] | None = None,
) -> DataFrame:
    """Shuffle join in which hot keys of ``left`` are split over several tasks.

    ``how`` keeps ``left`` whole (inner, left, left_semi, left_anti).  Rows of a hot key get
    a piece number from a hash of ``spread_by``, which is a function of the row and so the
    same on every retry; matching rows of ``right`` are repeated once per piece.  ``hot_from``
    is a cheaper frame to find the hot keys in when ``left`` is itself costly, or a function
    that knows them (from :func:`hot_keys` on keys of the same types).
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot split hot keys in a {how} join")
    keys = _names(on)
    if callable(hot_from):
        hot = hot_from()
    else:
        source = left if hot_from is None else hot_from
        hot = hot_keys(source.select(*[F.col(key).cast(left.schema[key].dataType) for key in keys]), keys, share)
    if not hot:
        return left.join(right, keys, how)

    split, repeated = _cut(left, right, keys, keys, hot, spread_by)
    return split.join(repeated, [*keys, "_piece"], how).drop("_piece")


def _cut(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    hot: Hot,
    spread_by: Sequence[str] | None,
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``_piece``: one per row of ``left``, all of its key's for ``right``."""
    pieces = F.broadcast(left.sparkSession.createDataFrame(hot, "_hot long, _pieces int"))
    left_hash = F.xxhash64(*[left[key] for key in left_keys])
    # equal keys of different types must hash alike
    right_hash = F.xxhash64(
        *[right[own].try_cast(left.schema[key].dataType) for key, own in zip(left_keys, right_keys)]
    )
    own = F.xxhash64(*[left[c] for c in (spread_by or left.columns)])
    split = left.join(pieces, left_hash == F.col("_hot"), "left").withColumn(
        "_piece", F.coalesce(F.pmod(own, F.col("_pieces")), F.lit(0)).cast("int")
    )
    repeated = right.join(pieces, right_hash == F.col("_hot"), "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1))
    )
    return split.drop("_hot", "_pieces"), repeated.drop("_hot", "_pieces")


def join_dim(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    spread_by: Sequence[str] | None = None,
    limit: int | None = None,
    hot_from: DataFrame | Callable[[], Hot] | None = None,
) -> DataFrame:
    """Row-preserving join to a keyed table: broadcast if it measures small, else split hot keys."""
    if fits_broadcast(dim, BROADCAST_BYTES if limit is None else limit):
        return fact.join(F.broadcast(dim), _names(on), how)
    return spread_join(fact, dim, on, how, spread_by, hot_from=hot_from)


def join_one(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    spread_by: Sequence[str] | None = None,
    limit: int | None = None,
    hot_from: DataFrame | Callable[[], Hot] | None = None,
) -> DataFrame:
    """Left join to at most one row of ``dim`` per key.

    A row of ``fact`` that meets two rows is an error, whatever is selected afterwards; keys that
    are double but unused are not.  ``dim`` is grouped by the join key, whose partitioning the
    join reuses; the test of the row count stands after the join and is never pruned.
    """
    keys = _names(on)
    known = dim.dropna(subset=keys)
    single = known.groupBy(*keys).agg(
        F.count("*").alias("_found"), *[F.any_value(F.col(name)).alias(name) for name in dim.columns if name not in keys]
    )
    if fits_broadcast(known, BROADCAST_BYTES if limit is None else limit):
        joined = fact.join(F.broadcast(single), keys, "left")
    else:
        joined = spread_join(fact, single, keys, "left", spread_by, hot_from=hot_from)
    return only_one(joined, "_found", keys)


def only_one(joined: DataFrame, count: str, keys: Sequence[str]) -> DataFrame:
    """``joined`` without ``count``; a row whose count is above 1 is an error."""
    second = F.raise_error(F.concat(F.lit("more than one row for "), F.to_json(F.struct(*keys))))
    return joined.filter(F.when(F.col(count) > 1, second.cast("boolean")).otherwise(True)).drop(count)


def lookup(
    df: DataFrame, dim: DataFrame, key: str, cols: dict[str, str], dim_key: str | None = None, limit: int | None = None
) -> DataFrame:
    """Fetch ``cols`` (dim column -> new name) by key; NULL without a match, an error with two."""
    picked = dim.select(
        F.col(dim_key or key).alias(key), *[F.col(source).alias(name) for source, name in cols.items()]
    )
    return join_one(df, picked, key, limit=limit)


def semi_theta(
    left: DataFrame,
    right: DataFrame,
    key: str,
    residual: Column,
    spread_by: Sequence[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Rows of ``left`` with a partner in ``right`` on ``key`` that also meets ``residual``.

    The sides' other columns must differ in name, so that ``residual`` can use both.  The range
    stays a residual of the hash or merge join on the key.
    """
    other = f"_{key}"
    renamed = right.withColumnRenamed(key, other)
    matched = (F.col(key) == F.col(other)) & residual
    if fits_broadcast(renamed, BROADCAST_BYTES if limit is None else limit):
        return left.join(F.broadcast(renamed), matched, "left_semi")
    hot = hot_keys(left.select(key), key)
    if not hot:
        return left.join(renamed, matched, "left_semi")
    split, repeated = _cut(left, renamed, [key], [other], hot, spread_by)
    repeated = repeated.withColumnRenamed("_piece", "_own_piece")
    return split.join(repeated, matched & (F.col("_piece") == F.col("_own_piece")), "left_semi").drop("_piece")
