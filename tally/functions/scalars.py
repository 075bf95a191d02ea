"""Column helpers for the places where Spark's default differs from what the reports need."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def in_year(date: ColumnLike, *years: int) -> Column:
    """Calendar-year filter as plain ranges, so both bounds reach the parquet scan.

    ``year(d) = 2017`` only pushes ``d IS NOT NULL``.  Consecutive years become one range.
    """
    if not years:
        raise ValueError("in_year needs at least one year")
    runs: list[list[int]] = []
    for year in sorted(set(years)):
        if runs and year == runs[-1][1]:
            runs[-1][1] = year + 1
        else:
            runs.append([year, year + 1])
    date = _col(date)
    ranges = [
        (date >= F.lit(datetime.date(first, 1, 1))) & (date < F.lit(datetime.date(after, 1, 1)))
        for first, after in runs
    ]
    return reduce(lambda a, b: a | b, ranges)


def year_diff(earlier: ColumnLike, later: ColumnLike) -> Column:
    """Calendar-year boundaries crossed, not completed years."""
    return F.year(_col(later)) - F.year(_col(earlier))


def month_label(date: ColumnLike) -> Column:
    """``03 - March``: sorts by month, reads as a name."""
    date = _col(date)
    number = F.lpad(F.month(date).cast("string"), 2, "0")
    return F.concat(number, F.lit(" - "), F.date_format(date, "MMMM"))


def hour_of(time: ColumnLike) -> Column:
    """Hour of an ``HH:mm:ss`` string."""
    return F.substring(_col(time), 1, 2).cast("int")


def trimmed_length(text: ColumnLike) -> Column:
    """Length without trailing spaces."""
    return F.length(F.rtrim(_col(text)))


def int_div(dividend: ColumnLike, divisor: int) -> Column:
    """Whole-number division; ``/`` would give a double."""
    return F.call_function("div", _col(dividend), F.lit(divisor))


def ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Exact ratio of two counts; NULL when there is nothing to divide by."""
    wide = "decimal(20,2)"
    return F.try_divide(_col(numerator).cast(wide), _col(denominator).cast(wide)).cast("decimal(23,13)")


def band(value: ColumnLike, bands: Sequence[tuple[int, int, str]]) -> Column:
    """Label of the inclusive range ``value`` falls in, NULL outside all of them."""
    value = _col(value)
    (low, high, label), *rest = bands
    chosen = F.when(value.between(low, high), label)
    for low, high, label in rest:
        chosen = chosen.when(value.between(low, high), label)
    return chosen


def rank_label(position: ColumnLike, labels: Mapping[int, str]) -> Column:
    """Text attached to chosen ranks, NULL elsewhere."""
    position = _col(position)
    by_label: dict[str, list[int]] = {}
    for rank, label in labels.items():
        by_label.setdefault(label, []).append(rank)
    if not by_label:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(position.isin(ranks), label) for label, ranks in by_label.items()])


def full_name(first: ColumnLike, last: ColumnLike) -> Column:
    """``First Last``; NULL when either part is missing."""
    return F.concat(_col(first), F.lit(" "), _col(last))


def loosely(text: ColumnLike) -> Column:
    """Compare ignoring case and trailing spaces; comparisons are binary without this."""
    return F.collate(_col(text), "UTF8_LCASE_RTRIM")
