import datetime

import pytest
from booking import CITIES, HandMade, d, money
from frames import rows
from pyspark.sql import functions as F

from tally.operators.quality import (
    check_date_range,
    check_length_bounds,
    check_max_length,
    check_not_null,
    check_references,
    check_rules,
    check_unique,
    clamp_to_reference,
    fill_defaults,
    judge_against_reference,
    orphans,
    tolerance_summary,
    valid_on,
)
from tally.plans.integrity import declared_checks
from tally.plans.rules import RULES, rule_report, with_defaults
from tally.schemas import MAX_LENGTHS, PRIMARY_KEYS, REFERENCES, REQUIRED, TABLES

LOW, HIGH = d("2016-01-01"), d("2019-12-31")


def test_date_range_edges(spark):
    days = ["2015-12-31", "2016-01-01", "2019-12-31", "2020-01-01", None]
    df = spark.createDataFrame([(x and d(x),) for x in days], "date date")
    assert rows(check_date_range(df, "date", LOW, HIGH)) == [(d("2015-12-31"),), (d("2020-01-01"),)]


def test_date_range_keeps_the_last_day_of_timestamps(spark):
    at = [datetime.datetime(2019, 12, 31, 23, 59), datetime.datetime(2020, 1, 1)]
    df = spark.createDataFrame([(x,) for x in at], "date timestamp_ntz")
    assert rows(check_date_range(df, "date", LOW, HIGH)) == [(at[1],)]


@pytest.fixture
def prices(spark):
    asked = ["80.00", "79.99", "120.00", "120.01", "1400.00", None, "100.00"]
    data = [(i, 1, 1 if i < 6 else 9, a and money(a)) for i, a in enumerate(asked)]
    changes = spark.createDataFrame(data, "ticket_id int, route_id int, cabin_type_id int, final_price decimal(10,2)")
    listed = spark.createDataFrame([(1, 1, money("100.00"))], "route_id int, cabin_type_id int, price decimal(10,2)")
    return changes, listed


KEYS = ["route_id", "cabin_type_id"]


def test_clamp_to_list(prices):
    got = clamp_to_reference(*prices, KEYS, "final_price", "price").select("ticket_id", "validated")
    # out of tolerance and missing prices become the list price; the unpriced row is dropped
    assert rows(got) == [
        (0, money("80.00")),
        (1, money("100.00")),
        (2, money("120.00")),
        (3, money("100.00")),
        (4, money("100.00")),
        (5, money("100.00")),
    ]


def test_clamp_reject(prices):
    got = clamp_to_reference(*prices, KEYS, "final_price", "price", policy="reject").select("ticket_id")
    assert rows(got) == [(0,), (2,)]
    with pytest.raises(ValueError):
        clamp_to_reference(*prices, KEYS, "final_price", "price", policy="ignore")


def test_tolerance_summary_counts_all_changes(prices):
    judged = judge_against_reference(*prices, KEYS, "final_price", "price", money("0.20"))
    assert rows(tolerance_summary(judged)) == [(3, 7)]


def test_two_prices_of_a_key_show_up_and_dates_settle_them(spark):
    listed = spark.createDataFrame(
        [(1, 1, money("90.00"), d("2012-01-01"), d("2015-12-31")), (1, 1, money("100.00"), d("2016-01-01"), None)],
        "route_id int, cabin_type_id int, price decimal(10,2), start_date date, end_date date",
    )
    assert rows(check_unique(listed, KEYS)) == [(1, 1, 2)]
    changes = spark.createDataFrame([(7, 1, 1, money("95.00"))], "ticket_id int, route_id int, cabin_type_id int, final_price decimal(10,2)")
    with pytest.raises(Exception, match="more than one row for"):
        clamp_to_reference(changes, listed, KEYS, "final_price", "price").collect()
    dated = valid_on(listed, d("2016-06-01"))
    assert clamp_to_reference(changes, dated, KEYS, "final_price", "price").first()["validated"] == money("95.00")
    assert [r.price for r in valid_on(listed, d("2016-06-01")).collect()] == [money("100.00")]
    assert [r.price for r in valid_on(listed, d("2015-12-31")).collect()] == [money("90.00")]
    assert valid_on(listed, d("2011-01-01")).count() == 0


def test_length_bounds(spark):
    current = spark.createDataFrame([(1, "Bo"), (2, "Robert"), (3, None), (4, "Ann   ")], "customer_id int, first_name string")
    data = [(1, "X"), (2, "Al  "), (3, None), (4, "Rosalind"), (99, "Cleo")]
    changes = spark.createDataFrame(data, "customer_id int, first_name string")
    found = check_length_bounds(current, changes, "first_name")
    assert [r.customer_id for r in found.accepted.orderBy("customer_id").collect()] == [2, 99]
    assert [r.customer_id for r in found.rejected.orderBy("customer_id").collect()] == [1, 4]
    assert rows(found.summary) == [(2, 5)]


def test_unique_reports_repeats_and_missing_parts(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3)], "a int, b int")
    assert rows(check_unique(df, ["a", "b"])) == [(None, 3, 1), (1, 1, 2)]


def test_references(spark):
    child = spark.createDataFrame([(1, 10), (2, 10), (3, 20), (4, None), (5, 30)], "id int, fk int")
    parent = spark.createDataFrame([(20,), (40,)], "pk int")
    assert rows(check_references(child, "fk", parent, "pk")) == [(10, 2), (30, 1)]
    assert sorted(r.id for r in orphans(child, "fk", parent, "pk").collect()) == [1, 2, 5]


def test_self_reference(spark):
    staff = spark.createDataFrame([(1, None), (2, 1), (3, 9)], "employee_id int, boss int")
    assert rows(check_references(staff, "boss", staff, "employee_id")) == [(9, 1)]


def test_orphans_and_matches_make_up_the_rest(spark):
    child = spark.range(500).select(F.when(F.col("id") % 9 != 0, F.col("id") % 40).alias("fk"))
    parent = spark.range(25).select(F.col("id").alias("pk"))
    orphan_rows = check_references(child, "fk", parent, "pk").agg(F.sum("orphan_rows")).first()[0]
    matched = child.join(parent, F.col("fk") == F.col("pk")).count()
    assert orphan_rows + matched == child.filter("fk IS NOT NULL").count()


def test_counts_per_column(spark):
    df = spark.createDataFrame([("abc", None), ("abcd", "x"), (None, None)], "a string, b string")
    assert rows(check_not_null(df, ["a", "b"])) == [("a", 1), ("b", 2)]
    assert rows(check_max_length(df, {"a": 3, "b": 1})) == [("a", 1), ("b", 0)]


def test_rules_pass_when_unknown(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "n int")
    assert rows(check_rules(df, {"positive": "n > 0", "small": "n < 100"})) == [("positive", 1), ("small", 0)]


def test_defaults(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", money("1.00"))], "id int, s string, m decimal(10,2)")
    got = fill_defaults(df, {"s": F.concat(F.lit("no. "), F.col("id").cast("string")), "m": 5})
    assert rows(got) == [(1, "no. 1", money("5.00")), (2, "x", money("1.00"))]
    assert got.schema["m"].dataType.simpleString() == "decimal(10,2)"


def test_rule_numbers_per_table():
    assert {table: len(rules) for table, rules in RULES.items()} == {
        "employees": 8,
        "customers": 6,
        "tickets": 6,
        "locations": 3,
        "planes": 3,
        "flights": 3,
        "routes": 3,
        "discounts": 3,
    }


def test_rule_reports_run_on_every_table(spark):
    t = HandMade(
        spark,
        employees=[
            {"employee_id": 1, "gender": "M", "email": "a@b.co", "ssn": "123-45-6789", "employee_id_reports_to": 1},
            {"employee_id": 2, "gender": "X", "email": "a@b.co", "ssn": "1234", "birth_date": d("1990-01-01"), "hire_date": d("1980-01-01")},
        ],
        tickets=[{"ticket_id": 1, "final_price": money("-1.00"), "purchase_time": "25:00:00"}, {"ticket_id": 2}],
        planes=[{"plane_id": 1}],
    )
    got = dict(rows(rule_report(t, "employees")))
    assert got == {
        "gender is M or F": 1,
        "hired after birth": 1,
        "nobody reports to themselves": 1,
        "email has an @": 0,
        "ssn is 3-2-4 digits": 1,
        "ssn is unique": 0,
        "email is unique": 1,
    }
    assert dict(rows(rule_report(t, "tickets")))["purchase time is a time"] == 1
    assert with_defaults(t, "planes", d("2021-01-01")).first()["capacity"] == 16
    assert with_defaults(t, "tickets", d("2021-01-01")).first()["purchase_date"] == d("2021-01-01")
    for table in RULES:
        rule_report(t, table).collect()
        with_defaults(t, table, d("2021-01-01")).collect()


def test_schema_counts():
    assert len(TABLES) == 22
    assert len(PRIMARY_KEYS) == 22
    assert len(REFERENCES) == 32
    assert sum(len(schema) for schema in TABLES.values()) == 121
    assert REQUIRED["planes_maintenances"] == ["plane_maintenance_id", "plane_id", "maintenance_id"]
    assert MAX_LENGTHS["job_positions"] == {"name": 50, "description": 800}


def test_declared_checks(spark):
    t = HandMade(
        spark,
        cities_states=[*CITIES, CITIES[0]],
        states=[{"state_id": 1, "name": "x" * 51}],
        zipcodes=[],
    )
    got = {(r.kind, r.table, r.column): r.violations for r in declared_checks(t, ["cities_states", "states", "zipcodes"]).collect()}
    assert got[("primary key", "cities_states", "city_state_id")] == 2
    assert got[("reference", "cities_states", "state_id -> states")] == 1
    assert got[("length", "states", "name")] == 1
    assert got[("required", "cities_states", "city_state_id")] == 0
    assert got[("reference", "zipcodes", "state_id -> states")] == 0
