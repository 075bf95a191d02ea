"""Batch checks: each returns the offending rows or a small table of counts.

All are one aggregation or one join over the table and run unchanged inside ``foreachBatch``.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions import trimmed_length
from tally.operators.asof import join_asof
from tally.operators.joins import Hot, join_dim, join_one

ACCEPTED, REJECTED, CLAMPED, UNPRICED, EMPTY = "accepted", "rejected", "clamped", "unpriced", "empty"


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def check_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key values that repeat or have a missing part, with their row count."""
    missing = _any([F.col(c).isNull() for c in cols])
    return df.groupBy(*cols).agg(F.count("*").alias("rows")).filter((F.col("rows") > 1) | missing)


def check_references(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Values of ``fk`` absent from the parent, with the number of rows using them.

    Counting before the anti join leaves one row per value, however often it occurs.
    """
    used = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias("orphan_rows"))
    return used.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """The child rows themselves."""
    keyed = child.filter(F.col(fk).isNotNull())
    return join_dim(keyed, parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def _long_counts(df: DataFrame, counts: Mapping[str, Column], name: str) -> DataFrame:
    """One pass over ``df``; one output row per named count."""
    aliases = {key: f"_c{i}" for i, key in enumerate(counts)}
    one_row = df.agg(*[counts[key].alias(alias) for key, alias in aliases.items()])
    rows = [F.struct(F.lit(key).alias(name), F.col(alias).alias("violations")) for key, alias in aliases.items()]
    return one_row.select(F.inline(F.array(*rows)))


def _times(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, violations) for required columns."""
    return _long_counts(df, {c: _times(F.col(c).isNull()) for c in cols}, "column")


def check_max_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """(column, violations) for declared text limits."""
    return _long_counts(df, {c: _times(F.length(c) > n) for c, n in limits.items()}, "column")


def check_columns(df: DataFrame, required: Sequence[str], limits: Mapping[str, int]) -> DataFrame:
    """(kind, column, violations) for required columns and text limits together, in one pass."""
    counts = {("required", c): _times(F.col(c).isNull()) for c in required}
    counts |= {("length", c): _times(F.length(c) > n) for c, n in limits.items()}
    named = {f"{kind} {column}": count for (kind, column), count in counts.items()}
    parts = F.split("label", " ")
    return _long_counts(df, named, "label").select(
        parts[0].alias("kind"), parts[1].alias("column"), "violations"
    )


def check_rules(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """(rule, violations) for named SQL conditions; an unknown result passes, as in CHECK."""
    return _long_counts(df, {name: _times(~F.expr(text)) for name, text in rules.items()}, "rule")


def fill_defaults(df: DataFrame, defaults: Mapping[str, Column | str | int | float | Decimal]) -> DataFrame:
    """Replace missing values; a Column default may use the row's other columns."""
    filled = {}
    for name, default in defaults.items():
        value = default if isinstance(default, Column) else F.lit(default)
        filled[name] = F.coalesce(F.col(name), value.cast(df.schema[name].dataType))
    return df.withColumns(filled)


def check_date_range(df: DataFrame, col: str, low: datetime.date, high: datetime.date) -> DataFrame:
    """Rows dated outside ``low``..``high`` (both allowed); a missing date is not a violation."""
    after = high + datetime.timedelta(days=1)
    return df.filter((F.col(col) < F.lit(low)) | (F.col(col) >= F.lit(after)))


def valid_on(df: DataFrame, day: Column | datetime.date, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Rows of a dated table in force on ``day``; an open end never lapses."""
    day = day if isinstance(day, Column) else F.lit(day)
    return df.filter((F.col(start) <= day) & (F.col(end).isNull() | (F.col(end) >= day)))


def judge_against_reference(
    changes: DataFrame,
    ref: DataFrame,
    keys: Sequence[str],
    value: str,
    ref_value: str,
    pct: Decimal,
    spread_by: Sequence[str] | None = None,
    limit: int | None = None,
    hot_from: DataFrame | Callable[[], Hot] | None = None,
) -> DataFrame:
    """Every change with its reference value and a ``verdict``.

    A second ``ref`` row for a key is an error (see :func:`check_unique`, :func:`valid_on`).
    """
    listed = ref.select(*keys, F.col(ref_value).alias("reference_value"))
    return _judged(join_one(changes, listed, keys, spread_by, limit, hot_from), value, pct)


def judge_as_of(
    changes: DataFrame,
    ref: DataFrame,
    keys: Sequence[str],
    value: str,
    ref_value: str,
    pct: Decimal,
    at: str,
    start: str = "start_date",
    end: str | None = "end_date",
    limit: int | None = None,
) -> DataFrame:
    """:func:`judge_against_reference` for dated references: each change meets the one in force at its own ``at``.

    See :func:`tally.operators.join_asof`; a change on a day without a reference is unpriced.
    """
    joined = join_asof(changes, ref, keys, at, start, {ref_value: "reference_value"}, end, limit)
    return _judged(joined, value, pct)


def _judged(joined: DataFrame, value: str, pct: Decimal) -> DataFrame:
    reference = F.col("reference_value")
    low, high = reference * F.lit(Decimal(1) - pct), reference * F.lit(Decimal(1) + pct)
    verdict = (
        F.when(reference.isNull(), UNPRICED)
        .when(F.col(value).isNull(), EMPTY)
        .when(F.col(value).between(low, high), ACCEPTED)
        .otherwise(CLAMPED)
    )
    return joined.withColumn("verdict", verdict)


def clamp_to_reference(
    changes: DataFrame,
    ref: DataFrame,
    keys: Sequence[str],
    value: str,
    ref_value: str,
    pct: Decimal = Decimal("0.20"),
    policy: str = "clamp_to_list",
    spread_by: Sequence[str] | None = None,
    limit: int | None = None,
    hot_from: DataFrame | Callable[[], Hot] | None = None,
) -> DataFrame:
    """Changes with ``validated`` = the value if within ±``pct`` of the reference.

    Otherwise ``clamp_to_list`` takes the reference value (also for a missing value) and
    ``reject`` leaves the row out.  Rows without a reference are dropped under both.
    """
    judged = judge_against_reference(changes, ref, keys, value, ref_value, pct, spread_by, limit, hot_from)
    return settle(judged, value, policy)


def settle(judged: DataFrame, value: str, policy: str = "clamp_to_list") -> DataFrame:
    """Judged changes with ``validated``; see :func:`clamp_to_reference`."""
    if policy == "reject":
        kept = judged.filter(F.col("verdict") == ACCEPTED)
    elif policy == "clamp_to_list":
        kept = judged.filter(F.col("verdict") != UNPRICED)
    else:
        raise ValueError(f"unknown policy {policy!r}")
    validated = F.when(F.col("verdict") == ACCEPTED, F.col(value)).otherwise(F.col("reference_value"))
    return kept.withColumn("validated", validated.cast(judged.schema[value].dataType))


def tolerance_summary(judged: DataFrame) -> DataFrame:
    """One row: how many changes were out of tolerance, out of how many."""
    return judged.agg(_times(F.col("verdict") == CLAMPED).alias("errors"), F.count("*").alias("total_rows"))


@dataclass
class Bounded:
    accepted: DataFrame
    rejected: DataFrame
    summary: DataFrame


def check_length_bounds(current: DataFrame, changes: DataFrame, col: str) -> Bounded:
    """Split changes by whether the text length lies within the lengths already present.

    The bounds are one aggregate row used as a scalar subquery.  New keys are judged like
    any other; a missing text is neither accepted nor rejected.
    """
    size = trimmed_length(col)
    bounds = current.agg(F.min(size).alias("shortest"), F.max(size).alias("longest"))
    shortest, longest = bounds.select("shortest").scalar(), bounds.select("longest").scalar()
    inside = size.between(shortest, longest)
    summary = changes.agg(_times(~inside).alias("errors"), F.count("*").alias("total_rows"))
    return Bounded(changes.filter(inside), changes.filter(~inside), summary)
