"""The ticket rankings of a year from one scan."""

import re

import pytest
from booking import HandMade, d, money, tickets

from tally.plans import reports
from tally.plans.bindings import OrderTables
from tally.plans.reports import REPORTS, report_suite, ticket_counts

YEAR = 2017


@pytest.fixture(scope="module")
def sales(spark):
    """Missing keys, ties, a ticket of another year, hours that stand twice, lookups without tickets."""
    day, price = d("2017-03-01"), money("10.50")
    sold = tickets(
        (3, {"employee_id": 1, "cabin_type_id": 1, "payment_type_id": 2, "purchase_location_id": 1,
             "purchase_date": day, "purchase_time": "08:10:00", "final_price": price}),
        (2, {"employee_id": 2, "cabin_type_id": 2, "payment_type_id": 1, "purchase_date": d("2017-12-31"),
             "purchase_time": "23:59:59", "final_price": money("99.99")}),
        (2, {"employee_id": 3, "cabin_type_id": 2, "purchase_location_id": 2, "purchase_date": day,
             "purchase_time": "08:59:00"}),
        (1, {"employee_id": 9, "purchase_date": d("2017-01-01")}),
        (5, {"employee_id": 3, "cabin_type_id": 1, "payment_type_id": 1, "purchase_location_id": 2,
             "purchase_date": d("2016-12-31"), "purchase_time": "07:00:00", "final_price": price}),
        (1, {"employee_id": 1, "final_price": price}),
    )
    names = {
        "cabin_types": ("cabin_type_id", 3),
        "locations": ("location_id", 2),
        "payment_types": ("payment_type_id", 2),
    }
    lookups = {t: [{key: i, "name": f"{t} {i}"} for i in range(1, n + 1)] for t, (key, n) in names.items()}
    staff = [{"employee_id": i, "first_name": "F", "last_name": f"L{i}"} for i in range(1, 5)]
    return HandMade(spark, tickets=sold, employees=staff, **lookups)


@pytest.mark.parametrize("key", ["r10", "r11", "r12", "r14", "r15", "r16"])
def test_same_rows_as_the_report_alone(sales, key):
    alone = REPORTS[key](sales, year=YEAR)
    found = report_suite(sales, YEAR)[key]
    assert found.schema.simpleString() == alone.schema.simpleString()
    assert found.collect() == alone.collect() and alone.count() > 1


def test_a_year_without_tickets(sales):
    assert all(df.count() == 0 for df in report_suite(sales, 1999).values())


def test_tickets_are_scanned_once(spark, small_dir, monkeypatch):
    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df.checkpoint()

    monkeypatch.setattr(reports, "store", kept)

    class Timed(OrderTables):
        def _tickets(self, columns):
            from pyspark.sql import functions as F

            return super()._tickets(tuple(c for c in columns if c != "purchase_time")).withColumn("purchase_time", F.lit("08:00:00"))

    found = report_suite(Timed(spark, small_dir), 1997)
    assert len(plans) == 1
    assert len(re.findall(r"Location: \w+ ?\[[^\]]*lineitem", plans[0])) == 1 or plans[0].count("lineitem.parquet") == 1
    assert any("LessThan(" in f for f in re.findall(r"PushedFilters: \[([^\]]*)", plans[0]))
    for df in found.values():
        assert "lineitem" not in df._jdf.queryExecution().executedPlan().toString()


def test_counts_by_key(sales):
    by = {}
    for row in ticket_counts(sales, YEAR).collect():
        by.setdefault(row["by"], {})[row[row["by"]]] = (row["total"], row["revenue"])
    assert by["cabin_type_id"] == {1: (3, money("31.50")), 2: (4, money("199.98")), None: (1, None)}
    assert by["hour"] == {8: (5, money("31.50")), 23: (2, money("199.98")), None: (1, None)}
