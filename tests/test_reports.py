import datetime

import pytest
from booking import CITIES, WEEKDAYS, HandMade, d, money, tickets
from frames import rows
from pyspark.sql import functions as F

from tally.plans import reports
from tally.plans.reports import REPORTS


def plain(df):
    return [tuple(r) for r in df.collect()]


# --- load factor -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def loads(spark):
    """Capacity 12 and 13; flights at, above and below the thresholds, one empty, one in another year."""
    planes = [{"plane_id": 1, "capacity": 12}, {"plane_id": 2, "capacity": 13}]
    flight = [(1, 1), (2, 1), (3, 1), (4, 2), (5, 2), (6, 1), (8, 2), (9, None)]
    flights = [{"flight_id": f, "plane_id": p, "date": d("2016-06-01")} for f, p in flight]
    flights.append({"flight_id": 7, "plane_id": 1, "date": d("2017-01-01")})
    sold = tickets(
        (6, {"flight_id": 1}),
        (7, {"flight_id": 2}),
        (2, {"flight_id": 3}),
        (3, {"flight_id": 4}),
        (2, {"flight_id": 5}),
        (12, {"flight_id": 7}),
        (14, {"flight_id": 8}),
        (1, {"flight_id": 9}),
        (4, {"flight_id": None}),
    )
    return HandMade(spark, planes=planes, flights=flights, tickets=sold)


def test_above_half(loads):
    # 6 of 12 is not above half; 13 div 2 is 6
    assert plain(REPORTS["r01"](loads)) == [(8, 14, 13), (2, 7, 12)]


def test_below_a_quarter(loads):
    # 13 div 4 is 3, so three tickets do not count as below; the empty flight is missing
    assert plain(REPORTS["r02"](loads, year=2016)) == [(3, 2, 12), (5, 2, 13)]


def test_below_a_quarter_with_empty_flights(loads):
    assert plain(REPORTS["r02"](loads, year=2016, include_empty=True))[-1] == (6, 0, 12)


def test_justified_departures(loads):
    got = plain(REPORTS["r08"](loads, year=2016))
    # 3 of 12 is exactly a quarter of nothing here; 3 of 13 is below 3.25; an unknown plane is NO
    assert got == [
        (1, 2016, 8, 14, "YES"),
        (2, 2016, 2, 7, "YES"),
        (3, 2016, 1, 6, "YES"),
        (4, 2016, 4, 3, "NO"),
        (5, 2016, 3, 2, "NO"),
        (6, 2016, 5, 2, "NO"),
        (7, 2016, 9, 1, "NO"),
    ]


def test_exactly_a_quarter_depends_on_the_comparison(spark):
    t = HandMade(
        spark,
        planes=[{"plane_id": 1, "capacity": 16}],
        flights=[{"flight_id": 1, "plane_id": 1, "date": d("2017-05-05")}],
        tickets=tickets((4, {"flight_id": 1})),
    )
    assert plain(REPORTS["r08"](t))[0][-1] == "NO"
    assert plain(REPORTS["r08"](t, op=">="))[0][-1] == "YES"
    assert plain(REPORTS["r08"](t, only="YES")) == []


def test_full_flights(loads):
    got = plain(REPORTS["r13"](loads))
    # oversold flight 8 is not full; the rank puts NO before YES, the output YES first
    assert got[0] == (8, 2017, 7, 1, 12, "YES")
    assert [r[2] for r in got[1:]] == [1, 2, 3, 4, 5, 8, 9]
    assert [r[0] for r in got[1:]] == [1, 2, 3, 4, 5, 6, 7]


# --- revenue ---------------------------------------------------------------------------------


def test_route_extremes(spark):
    flights = [{"flight_id": f, "route_id": r, "date": d("2017-03-03")} for f, r in [(1, 5), (2, 4), (3, 6), (4, 7), (5, 9)]]
    t = HandMade(
        spark,
        routes=[{"route_id": r} for r in (4, 5, 6, 7)],
        flights=flights,
        tickets=tickets(
            (2, {"flight_id": 1, "final_price": money("50.25")}),
            (1, {"flight_id": 2, "final_price": money("100.50")}),
            (3, {"flight_id": 3, "final_price": money("10.00")}),
            (9, {"flight_id": 5, "final_price": money("999.00")}),
        ),
    )
    # routes 4 and 5 tie for most; route 7 sold nothing; route 9 is not a route
    assert plain(REPORTS["r03"](t)) == [
        (4, 2017, money("0.00"), money("100.50"), 1),
        (6, 2017, money("30.00"), money("0.00"), 3),
    ]


@pytest.fixture(scope="module")
def ages(spark):
    born = {1: "2001-12-31", 2: "2000-12-31", 3: "1993-01-01", 4: "1992-06-06", 5: "1952-12-31", 6: "1951-12-31", 7: None}
    customers = [{"customer_id": c, "birth_date": b and d(b)} for c, b in born.items()]
    sale = {"purchase_date": d("2016-01-01"), "final_price": money("100.10")}
    sold = tickets(*[(1, {**sale, "customer_id": c}) for c in [1, 2, 2, 3, 4, 5, 6, 7, None, 99]])
    rates = [
        {"discount_id": 1, "name": "Student Discount", "percentage": money("0.20")},
        {"discount_id": 2, "name": "Elderly Discount", "percentage": money("0.15")},
    ]
    return HandMade(spark, customers=customers, tickets=sold, discounts=rates)


def test_student_discount(ages):
    # differences 15, 16 (birthday to come), 23, 24: the second (two tickets) and third count
    df = REPORTS["r04a"](ages)
    assert df.columns == ["Student Discount count", "total_discount"]
    assert plain(df) == [(3, money("60.0600"))]


def test_elderly_discount(ages):
    assert plain(REPORTS["r04b"](ages)) == [(1, money("15.0150"))]


def test_discount_without_a_match(ages):
    assert plain(reports.eligible_discount(ages, "Student Discount", 200, 300)) == [(0, None)]


def test_discount_options(ages):
    assert plain(reports.eligible_discount(ages, "student discount ", 16, 23, ignore_case=True)) == [(3, money("60.0600"))]
    assert plain(reports.eligible_discount(ages, "Student Discount", 16, 23, since=2017)) == [(0, None)]
    assert plain(reports.eligible_discount(ages, "No Such Rate", 16, 23)) == [(3, None)]


def test_two_rates_of_one_name_are_an_error(spark, ages):
    doubled = HandMade(spark, **{**ages.tables, "discounts": ages.tables["discounts"] * 2})
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS|more than one row"):
        REPORTS["r04a"](doubled).collect()


def test_registered_ratio(spark):
    t = HandMade(
        spark,
        tickets=tickets(
            (3, {"customer_id": 1, "boarding_date": d("2016-02-01")}),
            (2, {"customer_id": None, "boarding_date": d("2016-12-31")}),
            (5, {"customer_id": 2, "boarding_date": d("2017-01-01")}),
            (1, {"customer_id": None, "boarding_date": d("2018-01-01")}),
        ),
    )
    assert plain(REPORTS["r05"](t)) == [(2016, money("1.5")), (2017, None)]
    assert plain(REPORTS["r05"](t, years=(2019,))) == [(2019, None)]


def test_monthly_registered_ratio(spark):
    t = HandMade(
        spark,
        tickets=tickets(
            (4, {"customer_id": 1, "boarding_date": d("2016-02-01")}),
            (2, {"customer_id": None, "boarding_date": d("2016-02-28")}),
            (3, {"customer_id": 1, "boarding_date": d("2016-03-01")}),
            (3, {"customer_id": None, "boarding_date": d("2016-03-02")}),
            (9, {"customer_id": 1, "boarding_date": d("2016-04-02")}),
        ),
    )
    # months 2.0 and 1.0; April has nothing to divide by
    assert plain(REPORTS["r05"](t, monthly=True)) == [(2016, money("1.5"))]


def test_revenue_by_date(spark):
    t = HandMade(
        spark,
        tickets=tickets(
            (2, {"purchase_date": d("2017-01-02"), "final_price": money("10.00")}),
            (1, {"purchase_date": d("2017-01-01"), "final_price": money("20.00")}),
            (1, {"purchase_date": d("2017-12-31"), "final_price": money("19.99")}),
            (9, {"purchase_date": d("2018-01-01"), "final_price": money("99.00")}),
        ),
    )
    assert plain(REPORTS["r15"](t)) == [
        (1, d("2017-01-01"), money("20.00"), 1, "TOP 1"),
        (2, d("2017-01-02"), money("20.00"), 2, None),
        (3, d("2017-12-31"), money("19.99"), 1, None),
    ]


# --- demand ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def network(spark):
    """Routes 1-3 leave Tampa (city 10), 4 leaves Orlando, 5 leaves the other Tampa (30)."""
    routes = [
        {"route_id": 1, "city_state_id_origin": 10, "city_state_id_destination": 20, "start_time": "06:00:00", "weekday_id": 6},
        {"route_id": 2, "city_state_id_origin": 10, "city_state_id_destination": 20, "start_time": "08:00:00", "weekday_id": 6},
        {"route_id": 3, "city_state_id_origin": 10, "city_state_id_destination": 30, "start_time": "08:00:00", "weekday_id": 7},
        {"route_id": 4, "city_state_id_origin": 20, "city_state_id_destination": 10, "start_time": "10:00:00", "weekday_id": 6},
        {"route_id": 5, "city_state_id_origin": 30, "city_state_id_destination": 20, "start_time": "12:00:00", "weekday_id": 1},
        {"route_id": 6, "city_state_id_origin": 20, "city_state_id_destination": 10, "start_time": "14:00:00", "weekday_id": 1},
    ]
    flights = [
        {"flight_id": 11, "route_id": 1, "date": d("2017-01-07"), "start_time_actual": "06:10:00"},
        {"flight_id": 12, "route_id": 1, "date": d("2017-01-14"), "start_time_actual": "06:00:00"},
        {"flight_id": 21, "route_id": 2, "date": d("2017-01-07"), "start_time_actual": None},
        {"flight_id": 31, "route_id": 3, "date": d("2017-01-08"), "start_time_actual": "08:00:00"},
        {"flight_id": 41, "route_id": 4, "date": d("2016-01-09"), "start_time_actual": "10:05:00"},
        {"flight_id": 42, "route_id": 4, "date": d("2017-01-09"), "start_time_actual": "10:45:00"},
        {"flight_id": 43, "route_id": 4, "date": d("2017-01-16"), "start_time_actual": None},
        {"flight_id": 51, "route_id": 5, "date": d("2017-01-02"), "start_time_actual": "12:00:00"},
        {"flight_id": 61, "route_id": 6, "date": d("2017-01-02"), "start_time_actual": "14:00:00"},
    ]
    b16, b17 = {"boarding_date": d("2016-07-01")}, {"boarding_date": d("2017-07-01")}
    sold = tickets(
        (2, {"flight_id": 11, **b16}),
        (1, {"flight_id": 12, **b17}),
        (3, {"flight_id": 21, **b17}),
        (1, {"flight_id": 31, "boarding_date": d("2018-07-01")}),
        (2, {"flight_id": 41, **b16}),
        (2, {"flight_id": 42, **b17}),
        (3, {"flight_id": 43, **b17}),
        (4, {"flight_id": 51, **b17}),
    )
    return HandMade(spark, routes=routes, flights=flights, tickets=sold, weekdays=WEEKDAYS, cities_states=CITIES)


def test_busiest_routes(network):
    # routes 1 and 2 tie on Saturday; both Tampas match the name
    assert plain(REPORTS["r06"](network)) == [
        (1, 5, 1, "Monday", "Tampa", 4),
        (1, 1, 6, "Saturday", "Tampa", 3),
        (1, 3, 7, "Sunday", "Tampa", 1),
    ]


def test_busiest_routes_with_destination_and_runner_up(network):
    got = plain(REPORTS["r06"](network, destination="Orlando", n=2))
    assert [(r[0], r[1], r[2]) for r in got] == [(1, 5, 1), (1, 1, 6), (2, 2, 6)]


def test_busiest_routes_of_a_loosely_written_city(network):
    assert plain(REPORTS["r06"](network, origin="tampa ")) == []
    assert plain(REPORTS["r06"](network, origin="tampa ", ignore_case=True)) == plain(REPORTS["r06"](network))


def test_busiest_times(network):
    # a missing departure time is a time like any other
    assert plain(REPORTS["r07"](network)) == [(1, None, 6, "Saturday", "Orlando", 3)]
    assert plain(REPORTS["r07"](network, hour=True)) == [(1, 10, 6, "Saturday", "Orlando", 4)]


def test_weekend_routes(network):
    assert plain(REPORTS["r20"](network)) == [
        (1, 2017, "Saturday", 4, "10:00:00", "Orlando", 5, "TOP 1"),
        (2, 2017, "Saturday", 1, "06:00:00", "Tampa", 3, None),
        (3, 2017, "Saturday", 2, "08:00:00", "Tampa", 3, None),
        (4, 2017, "Sunday", 3, "08:00:00", "Tampa", 1, None),
    ]


def test_top_routes_by_weekday(network):
    # flights without tickets count 0, boarding in 2018 does not count
    got = plain(REPORTS["v07"](network))
    assert got == [
        (1, 5, "Tampa", "Orlando", 1, "Monday", 4),
        (2, 6, "Orlando", "Tampa", 1, "Monday", 0),
        (1, 4, "Orlando", "Tampa", 6, "Saturday", 7),
        (2, 1, "Tampa", "Orlando", 6, "Saturday", 3),
        (3, 2, "Tampa", "Orlando", 6, "Saturday", 3),
        (1, 3, "Tampa", "Tampa", 7, "Sunday", 0),
    ]


def test_months(spark):
    """Eleven selling months: nothing is ranked 12, unless the last rank is asked for."""
    flights = [{"flight_id": m, "date": datetime.date(2017, m, 1)} for m in range(1, 13)]
    sold = tickets(*[(m, {"flight_id": m}) for m in range(2, 13)])
    t = HandMade(spark, flights=flights, tickets=sold)
    got = plain(REPORTS["r09"](t))
    assert got[0] == (1, 2017, "12 - December", 12, "HIGHEST")
    assert got[-1] == (11, 2017, "02 - February", 2, None)
    assert plain(REPORTS["r09"](t, mark_last=True))[-1][-1] == "LOWEST"
    full = HandMade(spark, flights=flights, tickets=sold + tickets((1, {"flight_id": 1})))
    assert plain(REPORTS["r09"](full))[-1] == (12, 2017, "01 - January", 1, "LOWEST")


def _sales(**fields):
    return {"purchase_date": d("2017-04-04"), **fields}


def test_employees(spark):
    t = HandMade(
        spark,
        employees=[
            {"employee_id": 1, "first_name": "Ann", "last_name": "Lee"},
            {"employee_id": 2, "first_name": "Ann", "last_name": "Lee"},
            {"employee_id": 3, "first_name": "Bo", "last_name": None},
            {"employee_id": 4, "first_name": "Cy", "last_name": "Day"},
        ],
        tickets=tickets(
            (2, _sales(employee_id=1)),
            (2, _sales(employee_id=2)),
            (3, _sales(employee_id=3)),
            (1, _sales(employee_id=4)),
            (9, _sales(employee_id=None)),
            (9, _sales(employee_id=77)),
            (9, {"employee_id": 4, "purchase_date": d("2016-12-31")}),
        ),
    )
    got = plain(REPORTS["r10"](t))
    assert got == [
        (1, 2017, 3, None, 3, "TOP 3"),
        (2, 2017, 1, "Ann Lee", 2, "TOP 3"),
        (3, 2017, 2, "Ann Lee", 2, "TOP 3"),
        (4, 2017, 4, "Cy Day", 1, None),
    ]
    assert plain(REPORTS["r10"](t, only_top=2)) == got[:2]


def test_lookup_rankings(spark):
    t = HandMade(
        spark,
        cabin_types=[{"cabin_type_id": 1, "name": "First"}, {"cabin_type_id": 2, "name": "Second"}],
        locations=[{"location_id": 1, "name": "Airport"}, {"location_id": 2, "name": "Web"}],
        payment_types=[{"payment_type_id": 1, "name": "Cash"}, {"payment_type_id": 2, "name": "Card"}],
        tickets=tickets(
            (1, _sales(cabin_type_id=1, purchase_location_id=2, payment_type_id=1)),
            (2, _sales(cabin_type_id=2, purchase_location_id=1, payment_type_id=1)),
        ),
    )
    assert plain(REPORTS["r11"](t)) == [(1, 2017, 2, "Second", 2), (2, 2017, 1, "First", 1)]
    # output ascending while the rank is descending
    assert plain(REPORTS["r12"](t, year=2017)) == [(2, 2017, 2, "Web", 1, None), (1, 2017, 1, "Airport", 2, "TOP 1")]
    assert plain(REPORTS["r14"](t)) == [(1, 2017, 1, "Cash", 3, "TOP 1")]
    assert REPORTS["r14"](t).columns[3] == "payment_type_name"


def test_hours(spark):
    t = HandMade(
        spark,
        tickets=tickets(
            (2, _sales(purchase_time="09:59:59")),
            (2, _sales(purchase_time=None)),
            (3, _sales(purchase_time="10:00:00")),
        ),
    )
    assert plain(REPORTS["r16"](t)) == [(1, 10, 3, "TOP 1"), (2, None, 2, None), (3, 9, 2, None)]


def test_residents(spark):
    t = HandMade(
        spark,
        cities_states=CITIES,
        customers=[{"customer_id": i, "city_state_id": c} for i, c in enumerate([10, 10, 30, 30, 20, None, 99])],
        zipcodes=[{"zipcode_id": 1, "name": "33601"}],
        employees=[{"employee_id": 1, "zipcode_id": 1}, {"employee_id": 2, "zipcode_id": None}],
    )
    # the two Tampas stay apart
    assert plain(REPORTS["r17"](t, top=2)) == [(1, "Tampa", 2, "TOP 2"), (2, "Tampa", 2, "TOP 2"), (3, "Orlando", 1, None)]
    assert plain(REPORTS["r18"](t)) == [(1, "33601", 1, "TOP 6")]


def test_customers_by_tickets(spark):
    people = [("Ann", "Lee"), ("Ann", "Lee"), ("Bo", None), ("Cy", "Day")]
    t = HandMade(
        spark,
        customers=[{"customer_id": i, "first_name": f, "last_name": l} for i, (f, l) in enumerate(people, 1)],
        tickets=tickets(*[(n, _sales(customer_id=c)) for c, n in [(1, 2), (2, 2), (3, 5), (4, 1), (None, 9)]]),
    )
    got = plain(REPORTS["r19"](t))
    assert got == [
        (1, 2017, None, 5, "TOP 3"),
        (2, 2017, "Ann Lee", 2, "TOP 3"),
        (3, 2017, "Ann Lee", 2, "TOP 3"),
        (4, 2017, "Cy Day", 1, None),
    ]
    assert plain(REPORTS["r19"](t, only_top=3)) == got[:3]


# --- people ----------------------------------------------------------------------------------


def test_youngest_customers(spark):
    born = ["2000-05-05", "2000-06-06", "2000-06-06", "1999-01-01", None]
    t = HandMade(
        spark,
        cities_states=CITIES,
        customers=[{"customer_id": i, "birth_date": b and d(b), "city_state_id": 10} for i, b in enumerate(born, 1)]
        + [{"customer_id": 9, "birth_date": d("2020-01-01"), "city_state_id": None}],
    )
    got = plain(REPORTS["v06"](t, as_of=d("2021-01-01")))
    # a missing birth date sorts first; nobody without a city
    assert [r[0] for r in got] == [5, 2, 3, 1, 4]
    assert [r[4] for r in got] == [None, 21, 21, 21, 22]
    assert len(plain(REPORTS["v06"](t, as_of=d("2021-01-01"), n=2))) == 2
    today = spark.sql("SELECT current_date()").first()[0]
    assert plain(REPORTS["v06"](t)) == plain(REPORTS["v06"](t, as_of=today))


@pytest.fixture(scope="module")
def travellers(spark):
    as_of = {1: 25, 2: 26, 3: 40, 4: 41, 5: 55, 6: 56, 7: 70, 8: 71, 9: 100, 10: 101}
    customers = [
        {
            "customer_id": c,
            "birth_date": datetime.date(2021 - age, 6, 1),
            "gender": {0: "M", 1: "F", 2: None}[c % 3],
            "city_state_id": [10, 20, 30][c % 3],
        }
        for c, age in as_of.items()
    ]
    customers.append({"customer_id": 11, "birth_date": d("1996-01-01"), "gender": "F", "city_state_id": 20})
    boarding = {"boarding_date": d("2016-03-03")}
    sold = tickets(
        *[(c, {"customer_id": c, "flight_id": 1, **boarding}) for c in range(1, 12)],
        (50, {"customer_id": 11, "flight_id": 1, "boarding_date": d("2015-12-31")}),
        (50, {"customer_id": 11, "flight_id": 404, **boarding}),
        (50, {"customer_id": None, "flight_id": 1, **boarding}),
        (50, {"customer_id": 2, "flight_id": None, **boarding}),
    )
    return HandMade(spark, customers=customers, tickets=sold, flights=[{"flight_id": 1}], cities_states=CITIES)


def test_city_gender_counts(travellers):
    # the Tampas (cities 10 and 30) merge: men 3+6+9, unknown 2+5+8; Orlando has women only
    assert plain(REPORTS["v08"](travellers)) == [("Orlando", None, 33, 33), ("Tampa", 18, None, 33)]
    assert len(plain(REPORTS["v08"](travellers, n=1))) == 1


def test_city_gender_counts_equal_three_unions(travellers):
    """The one-pass form against the union of three grouped branches."""
    t = travellers
    flown = (
        t("tickets")
        .filter(F.year("boarding_date").isin(2016, 2017))
        .join(t("flights", "flight_id"), "flight_id")
        .join(t("customers", "customer_id", "gender", "city_state_id"), "customer_id")
        .join(t("cities_states", "city_state_id", "name"), "city_state_id")
    )

    def branch(df, name):
        names = ["flights_gender_M", "flights_gender_F", "flights_total"]
        n = df.groupBy("name").agg(F.count("*").alias("n"))
        return n.select("name", *[(F.col("n") if c == name else F.lit(None).cast("long")).alias(c) for c in names])

    parts = [branch(flown.filter(f"gender = '{g}'"), f"flights_gender_{g}") for g in "MF"]
    whole = parts[0].union(parts[1]).union(branch(flown, "flights_total")).distinct().groupBy("name")
    want = whole.agg(F.sum("flights_gender_M"), F.sum("flights_gender_F"), F.sum("flights_total"))
    assert rows(REPORTS["v08"](t)) == rows(want)


def test_age_groups(travellers):
    got = plain(REPORTS["v09"](travellers, as_of=d("2021-12-31")))
    by_band = {}
    for position, city, group, people, flights in got:
        by_band.setdefault(group, []).append((position, city, people, flights))
    assert by_band == {
        None: [(1, "Orlando", 1, 10)],
        "00 - 25": [(1, "Orlando", 2, 12)],
        "26 - 40": [(1, "Tampa", 2, 5)],
        "41 - 55": [(1, "Orlando", 1, 4), (2, "Tampa", 1, 5)],
        "56 - 70": [(1, "Orlando", 1, 7), (2, "Tampa", 1, 6)],
        "71 - 100": [(1, "Tampa", 2, 17)],
    }
    older = [(0, 70, "up to 70"), (71, 200, "71 or older")]
    grouped = plain(REPORTS["v09"](travellers, as_of=d("2021-12-31"), bands=older))
    assert {r[2] for r in grouped} == {"up to 70", "71 or older"}
    by_flights = plain(REPORTS["v09"](travellers, as_of=d("2021-12-31"), by_flights=True))
    assert [r[1] for r in by_flights if r[2] == "41 - 55"] == ["Tampa", "Orlando"]


def test_every_report_is_listed():
    wanted = {f"r{i:02d}" for i in range(1, 21) if i != 4} | {"r04a", "r04b"} | {f"v{i:02d}" for i in range(6, 10)}
    assert set(REPORTS) == wanted


def test_views_answer_sql(spark, travellers):
    reports.register_views(HandMade(spark, **{**travellers.tables, "routes": [], "weekdays": WEEKDAYS}), d("2021-12-31"))
    got = spark.sql("SELECT city_name FROM top_cities_by_age_group WHERE age_group = '26 - 40'").collect()
    assert [r.city_name for r in got] == ["Tampa"]
    assert spark.sql("SELECT * FROM city_gender_counts").count() == 2
    assert spark.sql("SELECT * FROM youngest_customers").count() == 11
    assert spark.sql("SELECT * FROM top_routes_by_weekday").count() == 0
