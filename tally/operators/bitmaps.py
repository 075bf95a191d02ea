"""Uniqueness, references and distinct counts of integer ids by bitmaps.

32768 neighbouring ids are one bucket with a bitmap of 4 KB.  A task sends one row for each bucket it has
seen, whatever the number of its rows, and bitmaps of several tables or days can be merged.  Where a bucket's
counts show that something is wrong, its rows (and only they) are looked at one by one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.operators.joins import join_dim
from tally.operators.quality import check_references, check_unique


def _integer(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.IntegralType)


def _bucket(col: str) -> Column:
    return F.bitmap_bucket_number(F.col(col).cast("long"))


def id_bitmaps(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """(*by, bucket, bits, rows) of the ids in ``col``; missing ids are left out."""
    if not _integer(df, col):
        raise TypeError(f"{col} is no integer")
    present = df.filter(F.col(col).isNotNull())
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(F.col(col).cast("long")))
    return present.groupBy(*by, _bucket(col).alias("bucket")).agg(bits.alias("bits"), F.count("*").alias("rows"))


def merge_bitmaps(*tables: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Bitmaps of all ids that any of the tables holds."""
    every = reduce(DataFrame.unionByName, tables)
    return every.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("rows").alias("rows"))


def count_ids(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, ids): the number of distinct ids."""
    return bitmaps.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("ids"))


def check_unique_ids(df: DataFrame, col: str, limit: int | None = None) -> DataFrame:
    """:func:`check_unique` of one column.  Keys other than integers are checked by it."""
    if not _integer(df, col):
        return check_unique(df, [col])
    doubled = id_bitmaps(df, col).filter(F.col("rows") > F.bitmap_count("bits")).select("bucket")
    keyed = df.select(col).filter(F.col(col).isNotNull()).withColumn("bucket", _bucket(col))
    suspects = join_dim(keyed, doubled, "bucket", "left_semi", spread_by=[col], limit=limit).select(col)
    return check_unique(suspects.unionByName(df.select(col).filter(F.col(col).isNull())), [col])


def check_reference_ids(child: DataFrame, fk: str, parent: DataFrame, pk: str, limit: int | None = None) -> DataFrame:
    """:func:`check_references`.  Keys other than integers are checked by it."""
    if not (_integer(child, fk) and _integer(parent, pk)):
        return check_references(child, fk, parent, pk)
    used = id_bitmaps(child, fk).select("bucket", "bits", F.lit(None).cast("binary").alias("known"))
    known = id_bitmaps(parent, pk).select("bucket", "bits", F.col("bits").alias("known"))
    both = used.unionByName(known).groupBy("bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("all"),
        F.max(F.when(F.col("known").isNotNull(), F.bitmap_count("known"))).alias("known"),
    )
    beyond = both.filter(F.col("all") > F.coalesce("known", F.lit(0))).select("bucket")
    suspects = child.filter(F.col(fk).isNotNull()).select(fk).withColumn("bucket", _bucket(fk))
    suspects = join_dim(suspects, beyond, "bucket", "left_semi", spread_by=[fk], limit=limit).select(fk)
    near = parent.filter(F.col(pk).isNotNull()).select(pk).withColumn("bucket", _bucket(pk))
    near = join_dim(near, beyond, "bucket", "left_semi", spread_by=[pk], limit=limit).select(pk)
    return check_references(suspects, fk, near, pk)
