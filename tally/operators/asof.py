"""Joining every row to the version of its key that is in force at the row's own time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.operators.joins import BROADCAST_BYTES, fits_broadcast, only_one
from tally.workspace import store

MOST_LISTED = 256  # versions of a key that a row looks through


def _versions(versions: DataFrame, keys: Sequence[str], start: str, end: str | None, cols: Mapping[str, str]) -> DataFrame:
    """(keys, _start, _found, _end, _row): one row a key and start."""
    until = F.col(end) if end is not None else F.lit(None).cast(versions.schema[start].dataType)
    known = versions.select(
        *keys, F.col(start).alias("_start"), until.alias("_end"), F.struct(*[F.col(c).alias(n) for c, n in cols.items()]).alias("_row")
    ).dropna(subset=[*keys, "_start"])
    return known.groupBy(*keys, "_start").agg(
        F.count("*").alias("_found"), F.any_value("_end").alias("_end"), F.any_value("_row").alias("_row")
    )


def _listed(fact: DataFrame, single: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """Each row looks through its key's versions, which come with it by broadcast."""
    version = F.struct("_start", "_found", "_end", "_row")
    lists = single.groupBy(*keys).agg(F.sort_array(F.collect_list(version)).alias("_versions"))
    begun = F.filter("_versions", lambda v: v["_start"] <= F.col(at))
    return fact.join(F.broadcast(lists), list(keys), "left").withColumn("_picked", F.try_element_at(begun, F.lit(-1))).drop("_versions")


def _carried(fact: DataFrame, single: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """Rows and versions in one order of key and time, cut into ranges; the last version is carried forward.

    Within a range by a window over the range, which is of bounded size however hot a key is; over the borders by
    the last version of each range, of which there is one row a range.
    """
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    own = [f"_k{i}" for i in range(len(keys))]
    version = F.struct("_start", "_found", "_end", "_row")
    none = single.select(version.alias("v")).schema["v"].dataType
    matched = F.lit(True)
    for name in [*keys, at]:
        matched &= F.col(name).isNotNull()
    whole = F.struct(*[F.col(c) for c in fact.columns])
    rows = fact.filter(matched).select(
        *named, F.col(at).alias("_time"), F.lit(1).alias("_kind"), F.xxhash64(*fact.columns).alias("_piece"),
        whole.alias("_fact"), F.lit(None).cast(none).alias("_version"),
    )
    starts = single.select(
        *named, F.col("_start").alias("_time"), F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_piece"),
        F.lit(None).cast(rows.schema["_fact"].dataType).alias("_fact"), version.alias("_version"),
    )
    order = [*own, "_time", "_kind", "_piece"]  # versions before rows; rows alike in key and time may be cut
    both = rows.unionByName(starts).repartitionByRange(*order).sortWithinPartitions(*order)
    both = store(both.withColumn("_part", F.spark_partition_id()))  # from here on a row's range is fixed

    last = F.struct(*own, "_version")
    within = F.last(F.when(F.col("_kind") == 0, last), ignorenulls=True).over(
        Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    ends = both.filter("_kind = 0").groupBy("_part").agg(F.max_by(last, F.struct(*own, "_time")).alias("_end"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = both.select("_part").distinct().join(ends, "_part", "left")
    parts = parts.select("_part", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    placed = both.withColumn("_within", within).filter("_kind = 1").join(F.broadcast(parts), "_part")  # one row a range
    latest = F.coalesce("_within", "_carried")
    same = F.lit(True)
    for name in own:
        same &= latest[name] == F.col(name)
    picked = placed.select("_fact.*", F.when(same, latest["_version"]).alias("_picked"))
    return picked.unionByName(fact.filter(~matched).withColumn("_picked", F.lit(None).cast(none)))


def join_asof(
    fact: DataFrame,
    versions: DataFrame,
    on: str | Sequence[str],
    at: str,
    start: str,
    cols: Mapping[str, str],
    end: str | None = None,
    limit: int | None = None,
    most_listed: int = MOST_LISTED,
) -> DataFrame:
    """Every row of ``fact`` with ``cols`` (column -> new name) of the version in force at its ``at``.

    In force is the key's version with the latest ``start`` not after ``at``, if its ``end`` is missing or not
    before ``at``; an earlier version does not come back where the latest has ended.  Without one the new columns are
    NULL, as for a missing key or time.  Two versions of a key with one start are an error for a row that
    meets them.  Versions that measure small are broadcast as a list a key, unless a key has very many.
    """
    keys = [on] if isinstance(on, str) else list(on)
    single = _versions(versions, keys, start, end, cols)
    small = fits_broadcast(versions.select(*dict.fromkeys([*keys, start, *([end] if end else []), *cols])), BROADCAST_BYTES if limit is None else limit)
    if small:
        most = single.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        small = most <= most_listed
    joined = (_listed if small else _carried)(fact, single, keys, at)
    joined = only_one(joined.withColumn("_found", F.col("_picked._found")), "_found", keys)
    in_force: Column = F.col("_picked._end").isNull() | (F.col("_picked._end") >= F.col(at))
    fetched = [F.when(in_force, F.col("_picked._row")[name]).alias(name) for name in cols.values()]
    return joined.select(*[F.col(f"`{c}`") for c in fact.columns], *fetched)
