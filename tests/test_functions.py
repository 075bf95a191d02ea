import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tally.functions import (
    band,
    full_name,
    hour_of,
    in_year,
    int_div,
    loosely,
    month_label,
    rank_label,
    ratio,
    trimmed_length,
    year_diff,
)

D = datetime.date


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def day(text):
    return F.lit(text).cast("date")


@pytest.mark.parametrize(
    ("a", "b", "years"),
    [
        ("2000-12-31", "2001-01-01", 1),
        ("2000-01-01", "2000-12-31", 0),
        ("1985-06-15", "2001-06-14", 16),
        ("2001-01-01", "2000-12-31", -1),
    ],
)
def test_year_diff_counts_boundaries(spark, a, b, years):
    assert one(spark, year_diff(day(a), day(b))) == years


def test_year_diff_of_missing_date(spark):
    assert one(spark, year_diff(F.lit(None).cast("date"), day("2001-01-01"))) is None


def test_in_year_matches_year_and_merges_neighbours(spark):
    days = spark.sql("SELECT explode(sequence(DATE'1995-12-25', DATE'2000-01-05')) AS d")
    years = (1999, 1996, 1997)
    assert days.filter(in_year("d", *years)).count() == days.filter(F.year("d").isin(*years)).count()
    assert str(in_year("d", *years)).count(">=") == 2
    with pytest.raises(ValueError):
        in_year("d")


def test_in_year_on_timestamps_and_nulls(spark):
    at = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP_NTZ'1996-12-31 23:59:59'), (TIMESTAMP_NTZ'1997-01-01 00:00:00'), (NULL) t(at)"
    )
    assert [str(r.at) for r in at.filter(in_year("at", 1996)).collect()] == ["1996-12-31 23:59:59"]


def test_in_year_reaches_the_scan(spark, small_dir):
    plan = spark.read.parquet(f"{small_dir}/orders.parquet").filter(in_year("o_orderdate", 1996))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_month_label(spark):
    assert one(spark, month_label(day("2017-03-09"))) == "03 - March"
    assert one(spark, month_label(day("2017-12-01"))) == "12 - December"


def test_hour_of(spark):
    assert one(spark, hour_of(F.lit("06:45:00"))) == 6
    assert one(spark, hour_of(F.lit(None).cast("string"))) is None


def test_int_div_truncates(spark):
    assert one(spark, int_div(F.lit(13), 4)) == 3
    assert one(spark, int_div(F.lit(-7), 2)) == -3


def test_trimmed_length(spark):
    assert one(spark, trimmed_length(F.lit(" ab  "))) == 3
    assert one(spark, trimmed_length(F.lit("   "))) == 0


def test_full_name_needs_both_parts(spark):
    assert one(spark, full_name(F.lit("Ann"), F.lit("Lee"))) == "Ann Lee"
    assert one(spark, full_name(F.lit("Ann"), F.lit(None).cast("string"))) is None


def test_ratio(spark):
    assert one(spark, ratio(F.lit(10), F.lit(4))) == Decimal("2.5")
    assert one(spark, ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, ratio(F.lit(0), F.lit(3))) == 0


def test_band_edges(spark):
    bands = [(0, 25, "young"), (26, 40, "mid")]
    got = [one(spark, band(F.lit(n), bands)) for n in (-1, 0, 25, 26, 40, 41)]
    assert got == [None, "young", "young", "mid", "mid", None]


def test_rank_label(spark):
    labels = {1: "TOP 2", 2: "TOP 2", 12: "LOWEST"}
    assert [one(spark, rank_label(F.lit(n), labels)) for n in (1, 2, 3, 12)] == ["TOP 2", "TOP 2", None, "LOWEST"]
    assert one(spark, rank_label(F.lit(1), {})) is None


def test_loose_comparison(spark):
    assert one(spark, loosely(F.lit("Tampa ")) == loosely(F.lit("tampa")))
    assert not one(spark, F.lit("Tampa ") == F.lit("tampa"))
