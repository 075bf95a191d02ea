"""From INSERT text to stored tables to every report, on the declared schema."""

import datetime

import pytest
from booking import CITIES, WEEKDAYS, d, money
from frames import rows
from pyspark.sql import functions as F

from tally.plans.integrity import declared_checks
from tally.plans.reports import REPORTS
from tally.schemas import TABLES
from tally.sources import ParquetTables, append, import_dump, save, write_insert_dump


def generated(spark):
    """A few hundred tickets made by Spark, and the small tables by hand."""
    n = spark.range(600)
    i = F.col("id")
    day = F.date_add(F.lit(d("2016-01-01")), (i * 37 % 731).cast("int"))
    made = {
        "tickets": n.select(
            (i + 1).cast("int").alias("ticket_id"),
            F.when(i % 3 == 0, 7).otherwise(i % 80).cast("int").alias("flight_id"),
            F.when(i % 10 != 0, i % 25).cast("int").alias("customer_id"),
            (i % 6).cast("int").alias("employee_id"),
            day.alias("purchase_date"),
            F.format_string("%02d:30:00", i % 24).alias("purchase_time"),
            day.alias("boarding_date"),
            F.lit("23:00:00").alias("boarding_time"),
            (i % 2 + 1).cast("int").alias("purchase_location_id"),
            (i % 2 + 1).cast("int").alias("cabin_type_id"),
            F.lit(None).cast("int").alias("discount_id"),
            (i % 90 + 60).cast("decimal(10,2)").alias("final_price"),
            (i % 3 + 1).cast("int").alias("payment_type_id"),
        ),
        "flights": spark.range(80).select(
            i.cast("int").alias("flight_id"),
            F.date_add(F.lit(d("2016-01-01")), (i * 9).cast("int")).alias("date"),
            F.format_string("%02d:05:00", i % 3 + 6).alias("start_time_actual"),
            F.format_string("%02d:15:00", i % 3 + 7).alias("end_time_actual"),
            (i % 14 + 1).cast("int").alias("route_id"),
            (i % 2 + 1).cast("int").alias("plane_id"),
        ),
        "routes": spark.range(14).select(
            (i + 1).cast("int").alias("route_id"),
            F.when(i < 7, 10).otherwise(20).alias("city_state_id_origin"),
            F.when(i < 7, 20).otherwise(10).alias("city_state_id_destination"),
            F.lit("06:00:00").alias("start_time"),
            F.lit("07:30:00").alias("end_time"),
            (i % 7 + 1).cast("int").alias("weekday_id"),
        ),
    }

    def small(name, data):
        schema = TABLES[name]
        return spark.createDataFrame([tuple(row.get(f.name) for f in schema) for row in data], schema)

    people = [
        {
            "customer_id": c,
            "first_name": f"First{c}",
            "last_name": f"O'Last{c}",
            "birth_date": datetime.date(1940 + 2 * c, 5, 5),
            "gender": "MF"[c % 2],
            "city_state_id": 10 + 10 * (c % 3),
            "zipcode_id": 1,
        }
        for c in range(25)
    ]
    staff = [{"employee_id": e, "first_name": "Ann", "last_name": f"Lee{e}", "zipcode_id": 1} for e in range(6)]
    hand = {
        "customers": people,
        "employees": staff,
        "planes": [{"plane_id": 1, "capacity": 40}, {"plane_id": 2, "capacity": 5}],
        "weekdays": WEEKDAYS,
        "cities_states": CITIES,
        "states": [{"state_id": 1, "name": "FL"}, {"state_id": 2, "name": "GA"}],
        "zipcodes": [{"zipcode_id": 1, "name": "33601", "state_id": 1}],
        "locations": [{"location_id": 1, "name": "Airport"}, {"location_id": 2, "name": "Web"}],
        "cabin_types": [{"cabin_type_id": 1, "name": "First"}, {"cabin_type_id": 2, "name": "Second"}],
        "payment_types": [{"payment_type_id": p, "name": f"Pay {p}"} for p in (1, 2, 3)],
        "discounts": [
            {"discount_id": 1, "name": "Student Discount", "percentage": money("0.20")},
            {"discount_id": 2, "name": "Elderly Discount", "percentage": money("0.15")},
        ],
    }
    return made | {name: small(name, data) for name, data in hand.items()}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Half of the tables come from text, the other half are saved directly."""
    folder = tmp_path_factory.mktemp("native")
    made = generated(spark)
    as_text = ["customers", "employees", "routes", "discounts", "flights", "states"]
    for name in as_text:
        write_insert_dump(made[name], f"{folder}/text/{name}", name)
    import_dump(spark, f"{folder}/text/*", f"{folder}/db", {name: TABLES[name] for name in as_text})
    for name in made:
        if name not in as_text:
            save(made[name], f"{folder}/db", name)
    return ParquetTables(spark, f"{folder}/db"), made


def test_stored_tables_equal_the_made_ones(stored):
    tables, made = stored
    for name, df in made.items():
        assert rows(tables(name)) == rows(df), name


@pytest.mark.parametrize("key", sorted(REPORTS))
def test_reports_run_on_stored_tables(stored, key):
    tables, made = stored
    dated = {"as_of": d("2021-12-31")} if key in ("v06", "v09") else {}

    def in_memory(name, *columns):
        return made[name].select(*columns) if columns else made[name]

    got = rows(REPORTS[key](tables, **dated))
    assert got and got == rows(REPORTS[key](in_memory, **dated))


def test_flattened_report_equals_nested_sums(stored):
    """Best route per weekday by summing level upon level, as one would nest queries."""
    t, _ = stored
    named = (
        t("flights", "flight_id", "route_id")
        .join(t("tickets", "flight_id"), "flight_id")
        .join(t("routes", "route_id", "weekday_id", "city_state_id_origin"), "route_id")
        .join(t("weekdays", "weekday_id", F.col("name").alias("weekday_name")), "weekday_id")
        .join(t("cities_states").toDF("city_state_id_origin", "city_state", "state_id"), "city_state_id_origin")
        .filter("city_state = 'Tampa'")
    )
    keys = ["route_id", "weekday_id", "weekday_name", "city_state"]
    level = named.groupBy(*keys, "flight_id").agg(F.count("*").alias("n"))
    for _ in range(2):
        level = level.groupBy(*keys).agg(F.sum("n").alias("n"))
    best = {}
    for r in level.collect():
        if r.weekday_id not in best or (-r.n, r.route_id) < (-best[r.weekday_id].n, best[r.weekday_id].route_id):
            best[r.weekday_id] = r
    want = sorted((r.weekday_id, r.route_id, r.n) for r in best.values())
    assert [(r.weekday_id, r.route_id, r.total_tickets) for r in REPORTS["r06"](t).collect()] == want


def test_declared_constraints_of_the_stored_tables(stored):
    tables, made = stored
    bad = declared_checks(tables, list(made)).filter("violations > 0").collect()
    assert {(r.kind, r.table, r.column) for r in bad} == set()


def test_audit_table_grows_by_appending(spark, tmp_path, stored):
    from tally.operators.changes import audit_changes

    tables, _ = stored
    before = tables("planes", "plane_id", "capacity")
    at = datetime.datetime(2021, 1, 1, 12, 0, 0)
    for batch, capacity in (("1", 20), ("2", 24)):
        after = before.withColumn("capacity", F.lit(capacity))
        log = audit_changes(before, after, "plane_id", ["plane_id", "capacity"], "planes", "u", "s", at, batch)
        append(log, str(tmp_path / "tb_audit"))
    logged = spark.read.parquet(str(tmp_path / "tb_audit"))
    assert rows(logged.select("aud_id", "aud_after")) == [
        ("1:planes:1:capacity", "20"),
        ("1:planes:2:capacity", "20"),
        ("2:planes:1:capacity", "24"),
        ("2:planes:2:capacity", "24"),
    ]
