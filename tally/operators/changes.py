"""Comparing two images of a table, logging the differences, and applying changes."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.operators.digests import differing
from tally.operators.joins import join_dim, only_one
from tally.schemas import AUDIT

INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"


def _key_list(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def pair_images(before: DataFrame, after: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Old and new image of each key side by side as structs ``before`` and ``after``.

    A side without the key is NULL; a key with a second row in an image is an error (take
    :func:`latest_per_key` first where one of several is meant).
    """
    keys = _key_list(key)
    columns = before.columns

    def image(df: DataFrame, name: str) -> DataFrame:
        whole = F.struct(*[F.col(c) for c in columns])
        return df.groupBy(*keys).agg(F.any_value(whole).alias(name), F.count("*").alias(f"_{name}"))

    joined = image(before, "before").join(image(after, "after"), keys, "full_outer")
    return only_one(only_one(joined, "_before", keys), "_after", keys)


def classify(paired: DataFrame) -> DataFrame:
    """Add ``operation``: INSERT, DELETE, UPDATE, or NULL for an unchanged row."""
    operation = (
        F.when(F.col("before").isNull(), INSERT)
        .when(F.col("after").isNull(), DELETE)
        .when(~F.col("before").eqNullSafe(F.col("after")), UPDATE)
    )
    return paired.withColumn("operation", operation)


def audit_changes(
    before: DataFrame,
    after: DataFrame,
    key: str | Sequence[str],
    cols: Sequence[str],
    table: str,
    user: str,
    station: str,
    at: datetime.datetime,
    batch: str = "0",
    digests: bool = False,
) -> DataFrame:
    """Audit rows for the difference of two images; see :func:`audit_pairs`.

    With ``digests`` the images are compared by digests first (:func:`differing`) and only rows that differ are
    paired: for large stored images of which little has changed.  A second row of a key is then found
    only where its range differs.
    """
    wanted = list(dict.fromkeys([*_key_list(key), *cols]))
    before, after = before.select(*wanted), after.select(*wanted)
    if digests:
        before, after = differing(before, after, key)
    paired = pair_images(before, after, key)
    return audit_pairs(paired, key, cols, table, user, station, at, batch)


def audit_pairs(
    paired: DataFrame,
    key: str | Sequence[str],
    cols: Sequence[str],
    table: str,
    user: str,
    station: str,
    at: datetime.datetime,
    batch: str | Column = "0",
) -> DataFrame:
    """One audit row per column of an inserted or deleted row and per changed column of an update.

    ``paired`` holds the key and the structs ``before`` and ``after``.  A change feed that
    carries both images needs no join, so this also runs as a plain streaming projection, with
    the feed's sequence as ``batch``.  Unchanged rows are dropped first, unchanged columns
    before anything is written.  ``aud_id`` is made of batch, table, key and column, so a rerun
    repeats it; a key of several columns is written as JSON.
    """
    keys = _key_list(key)
    changed = classify(paired).filter(F.col("operation").isNotNull())
    batch = batch.cast("string") if isinstance(batch, Column) else F.lit(batch)
    per_column = F.array(
        *[
            F.struct(
                F.lit(name).alias("aud_column"),
                F.col("before")[name].cast("string").alias("aud_before"),
                F.col("after")[name].cast("string").alias("aud_after"),
            )
            for name in cols
        ]
    )
    if len(keys) == 1:
        identifier = F.coalesce(F.col(keys[0]).cast("string"), F.lit("NULL"))
    else:  # parts stay apart and a missing one shows
        identifier = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    logged = (
        changed.select(
            batch.alias("_batch"), identifier.alias("aud_identifier_id"), "operation", F.inline(per_column)
        )
        .filter((F.col("operation") != UPDATE) | ~F.col("aud_before").eqNullSafe(F.col("aud_after")))
        .select(
            F.concat_ws(":", "_batch", F.lit(table), "aud_identifier_id", "aud_column").alias("aud_id"),
            F.lit(station).alias("aud_station"),
            F.col("operation").alias("aud_operation"),
            F.lit(at.date()).alias("aud_date"),
            F.lit(at.strftime("%H:%M:%S")).alias("aud_time"),
            F.lit(user).alias("aud_username"),
            F.lit(table).alias("aud_table"),
            "aud_identifier_id",
            "aud_column",
            "aud_before",
            "aud_after",
        )
    )
    return logged.select(*[F.col(field.name).cast(field.dataType) for field in AUDIT])


def latest_per_key(changes: DataFrame, key: str | Sequence[str], order: Column) -> DataFrame:
    """The last change of each key.

    Partial maxima, so a key with many changes stays cheap; equal ``order`` falls back to the
    row's values, so a rerun picks the same one.
    """
    keys = _key_list(key)
    rest = [name for name in changes.columns if name not in keys]
    newest = changes.groupBy(*keys).agg(F.max(F.struct(order.alias("_order"), *rest)).alias("_row"))
    return newest.select(*[F.col(name) if name in keys else F.col(f"_row.{name}") for name in changes.columns])


def apply_updates(
    target: DataFrame,
    changes: DataFrame,
    key: str | Sequence[str],
    cols: Sequence[str],
    order: Column | None = None,
    limit: int | None = None,
) -> DataFrame:
    """``target`` with ``cols`` taken from the matching change.

    The rows of ``target`` are those that come out, never more.  Several changes of one key need
    ``order``, of which the last counts; without it, a row that meets two changes is an error.  A
    change to NULL is a change.  Keys unknown to ``target`` are ignored.  Changes that measure small are
    broadcast, otherwise hot keys of ``target`` are split; :class:`tally.sources.StoredTable` updates stored files.
    """
    keys = _key_list(key)
    if order is not None:
        changes = latest_per_key(changes, keys, order)
    new = changes.groupBy(*keys).agg(F.any_value(F.struct(*cols)).alias("_new"), F.count("*").alias("_found"))
    joined = only_one(join_dim(target, new, keys, "left", limit=limit), "_found", keys)
    return joined.select(
        *[
            F.when(F.col("_new").isNotNull(), F.col("_new")[name]).otherwise(F.col(name)).alias(name)
            if name in cols
            else F.col(name)
            for name in target.columns
        ]
    )


def replay(before: DataFrame, audit: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Rebuild the new image from the old one and its audit rows (single-column key among ``cols``)."""
    logged = audit.groupBy("aud_identifier_id").agg(
        F.max("aud_operation").alias("_operation"),
        *[
            F.max(F.when(F.col("aud_column") == name, F.struct(F.col("aud_after").alias("v")))).alias(f"_{name}")
            for name in cols
        ],
    )
    joined = before.select(*cols).join(logged, F.col(key).cast("string") == F.col("aud_identifier_id"), "full_outer")
    types = {field.name: field.dataType for field in before.schema}
    return joined.filter(F.col("_operation").isNull() | (F.col("_operation") != DELETE)).select(
        *[
            F.when(F.col(f"_{name}").isNotNull(), F.col(f"_{name}.v").cast(types[name])).otherwise(F.col(name)).alias(name)
            for name in cols
        ]
    )
