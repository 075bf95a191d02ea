"""Grouped counts used by several reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions import in_year, ratio
from tally.operators.joins import spread_join


def conditional_counts(
    df: DataFrame, key: str | Sequence[str], cases: Mapping[str, Column], weight: Column | None = None
) -> DataFrame:
    """One count per condition in a single pass; NULL, not 0, where nothing matches.

    ``weight`` is a partial count when ``df`` is aggregated already.
    """
    keys = [key] if isinstance(key, str) else list(key)
    one = weight if weight is not None else F.lit(1).cast("long")
    return df.groupBy(*keys).agg(*[F.sum(F.when(cond, one)).alias(name) for name, cond in cases.items()])


def presence_ratio(df: DataFrame, col: str, years: Sequence[int], year_col: str) -> DataFrame:
    """Rows with ``col`` over rows without it, per year, in one pass over the table.

    Every requested year gets a row; the ratio is NULL when no row lacks ``col``.
    """
    present, absent = F.col(col).isNotNull(), F.col(col).isNull()
    counts = []
    for year in years:
        inside = in_year(year_col, year)
        counts.append(F.count(F.when(inside & present, 1)).alias(f"_with_{year}"))
        counts.append(F.count(F.when(inside & absent, 1)).alias(f"_without_{year}"))
    rows = [
        F.struct(F.lit(year).alias("year"), ratio(f"_with_{year}", f"_without_{year}").alias("ratio"))
        for year in years
    ]
    return df.filter(in_year(year_col, *years)).agg(*counts).select(F.inline(F.array(*rows)))


def monthly_presence_ratio(df: DataFrame, col: str, years: Sequence[int], year_col: str) -> DataFrame:
    """Mean over the months of a year of the monthly ratio."""
    months = (
        df.filter(in_year(year_col, *years))
        .groupBy(F.year(year_col).alias("year"), F.month(year_col).alias("month"))
        .agg(F.count(col).alias("_with"), F.count(F.when(F.col(col).isNull(), 1)).alias("_without"))
    )
    return (
        months.withColumn("ratio", ratio("_with", "_without"))
        .groupBy("year")
        .agg(F.avg("ratio").cast("decimal(23,13)").alias("ratio"))
    )


def counts_per_outer(
    outer: DataFrame, inner: DataFrame, key: str, name: str, unique_outer: bool = True
) -> DataFrame:
    """For each row of ``outer`` the number of ``inner`` rows with its key, 0 when none.

    ``unique_outer=False`` says that ``key`` may repeat in ``outer``; hot keys are then split.
    """
    counted = inner.groupBy(key).agg(F.count("*").alias(name))
    joined = outer.join(counted, key, "left") if unique_outer else spread_join(outer, counted, key, "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("long")))
