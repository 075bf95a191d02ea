"""The booking reports.

Each takes ``tables``, a callable giving a named table with the asked columns
(``tally.sources.ParquetTables`` or any look-alike), and returns a DataFrame.

Shape shared by most of them: tickets are first counted per flight, customer or lookup id,
which turns a hot key into one row per task, and only then joined.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions import (
    band,
    full_name,
    hour_of,
    in_year,
    int_div,
    loosely,
    month_label,
    year_diff,
)
from tally.operators.aggregates import (
    conditional_counts,
    counts_per_outer,
    monthly_presence_ratio,
    presence_ratio,
)
from tally.operators.joins import BROADCAST_BYTES, fits_broadcast, join_dim, spread_join
from tally.operators.ranking import extremes, first_n, ranked, top_n_per_group
from tally.plans.counted import CountedTables
from tally.workspace import store

Tables = Callable[..., DataFrame]

MONEY = "decimal(20,2)"
DAYS_IN_YEAR = 366

# Ages and their labels in the age-group report.
AGE_BANDS = [
    (0, 25, "00 - 25"),
    (26, 40, "26 - 40"),
    (41, 55, "41 - 55"),
    (56, 70, "56 - 70"),
    (71, 100, "71 - 100"),
]

_COMPARE: dict[str, Callable[[Column, Column], Column]] = {
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    "==": lambda a, b: a == b,
}


def _count() -> Column:
    return F.count("*")


def _tickets_per_flight(tables: Tables, boarding_years: Sequence[int] = ()) -> DataFrame:
    if isinstance(tables, CountedTables):
        return tables.counts.per_flight(boarding_years)
    if boarding_years:
        tickets = tables("tickets", "flight_id", "boarding_date").filter(in_year("boarding_date", *boarding_years))
    else:
        tickets = tables("tickets", "flight_id")
    return tickets.groupBy("flight_id").agg(_count().alias("tickets"))


def _city(tables: Tables, key: str, name: str) -> DataFrame:
    return tables("cities_states", "city_state_id", "name").select(
        F.col("city_state_id").alias(key), F.col("name").alias(name)
    )


def _weekdays(tables: Tables) -> DataFrame:
    return tables("weekdays", "weekday_id", "name").withColumnRenamed("name", "weekday_name")


def _day(as_of: datetime.date | None) -> Column:
    """The given day, or today's in the session."""
    return F.current_date() if as_of is None else F.lit(as_of)


# --- load factor -----------------------------------------------------------------------------


def capacity_threshold(
    tables: Tables, year: int, op: str = ">", divisor: int = 2, include_empty: bool = False
) -> DataFrame:
    """Flights of ``year`` whose tickets compare with a whole fraction of the plane's capacity."""
    flights = tables("flights", "flight_id", "date", "plane_id").filter(in_year("date", year)).drop("date")
    sold = _tickets_per_flight(tables).withColumnRenamed("tickets", "cantidad")
    counted = flights.join(sold, "flight_id", "left" if include_empty else "inner")
    counted = counted.withColumn("cantidad", F.coalesce("cantidad", F.lit(0).cast("long")))
    return (
        join_dim(counted, tables("planes", "plane_id", "capacity"), "plane_id", spread_by=["flight_id"])
        .filter(_COMPARE[op](F.col("cantidad"), int_div("capacity", divisor)))
        .select("flight_id", "cantidad", "capacity")
        .orderBy(F.desc("cantidad"), F.asc("flight_id"))
    )


def _capacity_flags(tables: Tables, year: int | None, full: bool, op: str, fraction: str, flag: str) -> DataFrame:
    flights = tables("flights", "flight_id", "date", "plane_id")
    if year is not None:
        flights = flights.filter(in_year("date", year))
    flights = flights.select("flight_id", "plane_id", F.year("date").alias("year"))
    counted = flights.join(_tickets_per_flight(tables), "flight_id")
    # a missing plane leaves the comparison unknown and so the flag NO
    seats = join_dim(counted, tables("planes", "plane_id", "capacity"), "plane_id", "left", ["flight_id"])
    level = F.col("capacity") if full else F.col("capacity") * F.lit(fraction).cast("decimal(5,2)")
    met = _COMPARE[op](F.col("tickets"), level)
    return seats.withColumn(flag, F.when(met, "YES").otherwise("NO")).drop("capacity")


def departure_justified(
    tables: Tables,
    year: int,
    fraction: str = "0.25",
    op: str = ">",
    only: str | None = None,
    only_top: int | None = None,
) -> DataFrame:
    """Flights of a year ranked by tickets with a YES/NO flag for a capacity share.

    ``op=">="`` and ``only="NO"`` give the flights that should have stayed on the ground.
    """
    flagged = _capacity_flags(tables, year, False, op, fraction, "justify").drop("plane_id")
    if only is not None:
        flagged = flagged.filter(F.col("justify") == only)
    placed = ranked(flagged, [F.desc("tickets"), F.asc("flight_id")], only_top=only_top)
    return placed.select("orden", "year", "flight_id", "tickets", "justify")


def full_flights(tables: Tables, op: str = "==", only_top: int | None = None) -> DataFrame:
    """Every flight with a flag for a plane filled exactly.

    The ranks start with the flights that are not full, the rows with those that are.  A full rank
    sorts once, in the order of the rows, and moves the ranks of each part by the size of the other.
    """
    flagged = _capacity_flags(tables, None, True, op, "1", "full_capacity")
    by_key = F.asc("flight_id")
    if only_top is not None:
        placed = ranked(flagged, [F.asc("full_capacity"), by_key], only_top=only_top)
        placed = placed.orderBy(F.desc("full_capacity"), F.asc("orden"))
    else:
        placed = ranked(flagged, [F.desc("full_capacity"), by_key])
        full = F.col("full_capacity") == "YES"
        sizes = placed.agg(F.count_if(full).alias("full"), F.count_if(~full).alias("others"))
        moved = F.when(full, sizes.select("others").scalar()).otherwise(-sizes.select("full").scalar())
        placed = placed.withColumn("orden", (F.col("orden") + moved).cast("long"))
    return placed.select(
        "orden", "year", "flight_id", "plane_id", "tickets", F.col("full_capacity").alias("full capacity")
    )


# --- revenue ---------------------------------------------------------------------------------


def route_extremes(tables: Tables, year: int) -> DataFrame:
    """The routes with the most and the least revenue in a year."""
    sold = (
        tables("tickets", "flight_id", "final_price")
        .groupBy("flight_id")
        .agg(F.sum("final_price").alias("revenue"), _count().alias("flights"))
    )
    flights = tables("flights", "flight_id", "date", "route_id").filter(in_year("date", year))
    per_route = (
        flights.select("flight_id", "route_id")
        .join(sold, "flight_id")
        .groupBy("route_id")
        .agg(F.sum("revenue").cast(MONEY).alias("revenue"), F.sum("flights").alias("flights"))
        .join(tables("routes", "route_id"), "route_id")
        .withColumn("year", F.lit(year))
    )
    found = extremes(per_route, ["route_id", "year"], "revenue", carry=["flights"])
    return found.select("route_id", "year", "min_revenue", "max_revenue", "flights")


def eligible_discount(
    tables: Tables, name: str, low: int, high: int | None, ignore_case: bool = False, since: int | None = None
) -> DataFrame:
    """Tickets whose buyer was within an age band at purchase, and the discount they would have had.

    Age is a difference of years, so tickets are first summed per customer and purchase year;
    the age test is then a residual of the join on the customer.  ``since`` limits the years.
    """
    tickets = tables("tickets", "customer_id", "purchase_date", "final_price")
    if since is not None:
        tickets = tickets.filter(F.col("purchase_date") >= F.lit(datetime.date(since, 1, 1)))
    bought = (
        tickets.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id", F.year("purchase_date").alias("bought_in"))
        .agg(_count().alias("n"), F.sum("final_price").alias("paid"))
    )
    buyers = tables("customers", "customer_id", "birth_date").select(
        F.col("customer_id").alias("buyer"), F.year("birth_date").alias("born_in")
    )
    age = F.col("bought_in") - F.col("born_in")
    aged = (age >= low) if high is None else age.between(low, high)
    eligible = bought.join(buyers, (F.col("customer_id") == F.col("buyer")) & aged, "left_semi")
    label = F.col("name")
    wanted = loosely(label) == loosely(F.lit(name)) if ignore_case else label == name
    # a scalar subquery: more than one rate of that name is an error
    rate = tables("discounts", "name", "percentage").filter(wanted).select("percentage").scalar()
    return eligible.agg(F.sum("n").alias("n"), F.sum("paid").alias("paid")).select(
        F.coalesce(F.col("n"), F.lit(0).cast("long")).alias(f"{name} count"),
        (F.col("paid") * rate).cast("decimal(26,4)").alias("total_discount"),
    )


def registered_ratio(tables: Tables, years: Sequence[int], monthly: bool = False) -> DataFrame:
    """Tickets of registered over tickets of anonymous passengers per boarding year."""
    tickets = tables("tickets", "customer_id", "boarding_date")
    find = monthly_presence_ratio if monthly else presence_ratio
    return find(tickets, "customer_id", years, "boarding_date")


def revenue_by_date(tables: Tables, year: int, counts: DataFrame | None = None) -> DataFrame:
    if counts is None:
        days = (
            tables("tickets", "purchase_date", "final_price")
            .filter(in_year("purchase_date", year))
            .groupBy("purchase_date")
            .agg(F.sum("final_price").cast(MONEY).alias("revenue"), _count().alias("total"))
        )
    else:
        days = _of_counts(counts, "purchase_date", "revenue", "total")
    placed = ranked(days, [F.desc("revenue"), F.asc("purchase_date")], top=1, bound=DAYS_IN_YEAR)
    return placed.select("orden", "purchase_date", "revenue", "total", "position")


# --- demand ----------------------------------------------------------------------------------


def _chosen_routes(
    tables: Tables,
    origin: str | None,
    destination: str | None,
    weekdays: Sequence[int] = (),
    city_how: str = "left",
    ignore_case: bool = False,
) -> DataFrame:
    def named(column: str, name: str) -> Column:
        return loosely(column) == loosely(F.lit(name)) if ignore_case else F.col(column) == name

    routes = tables(
        "routes", "route_id", "weekday_id", "start_time", "city_state_id_origin", "city_state_id_destination"
    )
    if weekdays:
        routes = routes.filter(F.col("weekday_id").isin(*weekdays))
    routes = routes.join(_weekdays(tables), "weekday_id")
    routes = routes.join(_city(tables, "city_state_id_origin", "city_state"), "city_state_id_origin", city_how)
    if origin is not None:
        routes = routes.filter(named("city_state", origin))
    if destination is not None:
        ends = _city(tables, "city_state_id_destination", "city_state_to").filter(named("city_state_to", destination))
        routes = routes.join(ends.drop("city_state_to"), "city_state_id_destination", "left_semi")
    return routes


def _tickets_per_route(tables: Tables, flights: DataFrame, routes: DataFrame, extra: Sequence[str]) -> DataFrame:
    """Tickets per chosen route; only ids pass through the join of flights and tickets.

    The route table bounds the chosen ids, so it is measured in their place.
    """
    ids = routes.select("route_id")
    if fits_broadcast(tables("routes", "route_id"), BROADCAST_BYTES):
        chosen = flights.join(F.broadcast(ids), "route_id", "left_semi")
    else:
        chosen = spread_join(flights, ids, "route_id", "left_semi", ["flight_id"])
    return (
        chosen.join(_tickets_per_flight(tables), "flight_id")
        .groupBy("route_id", *extra)
        .agg(F.sum("tickets").alias("tickets"))
    )


def _busiest(
    tables: Tables,
    key: str,
    origin: str,
    destination: str | None,
    n: int,
    per_flight: Column | None,
    ignore_case: bool,
) -> DataFrame:
    routes = _chosen_routes(tables, origin, destination, ignore_case=ignore_case).select(
        "route_id", "weekday_id", "weekday_name", "city_state"
    )
    if per_flight is None:
        flights = tables("flights", "flight_id", "route_id")
    else:
        flights = tables("flights", "flight_id", "route_id", "start_time_actual").withColumn(key, per_flight)
    group = list(dict.fromkeys([key, "weekday_id", "weekday_name", "city_state"]))
    demand = (
        _tickets_per_route(tables, flights, routes, [key] if per_flight is not None else [])
        .join(routes, "route_id")
        .groupBy(*group)
        .agg(F.sum("tickets").alias("total_tickets"))
    )
    best = top_n_per_group(demand, "weekday_id", [F.desc("total_tickets"), F.asc(key)], n)
    return best.select("position", *group, "total_tickets").orderBy("weekday_id", "position")


def busiest_routes(
    tables: Tables, origin: str, destination: str | None = None, n: int = 1, ignore_case: bool = False
) -> DataFrame:
    """Best-selling routes of each weekday from a city."""
    return _busiest(tables, "route_id", origin, destination, n, None, ignore_case)


def busiest_times(
    tables: Tables,
    origin: str,
    destination: str | None = None,
    n: int = 1,
    hour: bool = False,
    ignore_case: bool = False,
) -> DataFrame:
    """Best-selling departure times (or hours) of each weekday from a city."""
    departure = hour_of("start_time_actual") if hour else F.col("start_time_actual")
    return _busiest(tables, "start_time_actual", origin, destination, n, departure, ignore_case)


def months_by_tickets(tables: Tables, year: int, mark_last: bool = False) -> DataFrame:
    """Months ranked by tickets; LOWEST sits at rank 12 unless ``mark_last`` puts it on the last."""
    flights = tables("flights", "flight_id", "date").filter(in_year("date", year))
    months = (
        flights.join(_tickets_per_flight(tables), "flight_id")
        .groupBy(F.trunc("date", "month").alias("first_day"))
        .agg(F.sum("tickets").alias("tickets"))
        .select(F.year("first_day").alias("year"), month_label("first_day").alias("month"), "tickets")
    )
    labels = {1: "HIGHEST"} if mark_last else {1: "HIGHEST", 12: "LOWEST"}
    placed = ranked(
        months, [F.desc("tickets"), F.asc("month")], labels, last="LOWEST" if mark_last else None, bound=12
    )
    return placed.select("orden", "year", "month", "tickets", "position")


#: What the suite groups the tickets by, besides the hour.
SUITE_KEYS = ("employee_id", "cabin_type_id", "purchase_location_id", "payment_type_id", "purchase_date")


def ticket_counts(tables: Tables, year: int) -> DataFrame:
    """Tickets and revenue of a year by each of ``SUITE_KEYS`` and by hour: one pass over the tickets.

    The columns are ``by`` (the name of the key a row is for), the keys (null but for that one), ``total``
    and ``revenue``.  Grouping sets give each ticket to six groups before anything moves, and what moves is
    one row for each key and task, so that a hot key costs no more than others.
    """
    keys = [*SUITE_KEYS, "hour"]
    sold = tables("tickets", *SUITE_KEYS, "purchase_time", "final_price").filter(in_year("purchase_date", year))
    sold = sold.withColumn("hour", hour_of("purchase_time")).drop("purchase_time")
    counted = sold.groupingSets([[key] for key in keys], *keys).agg(
        F.grouping_id().alias("_set"), _count().alias("total"), F.sum("final_price").cast(MONEY).alias("revenue")
    )
    # a key's bit of the grouping id is 0 in its own set
    everything = 2 ** len(keys) - 1
    own = F.coalesce(
        *[F.when(F.col("_set") == everything - 2 ** (len(keys) - 1 - i), key) for i, key in enumerate(keys)]
    )
    return counted.select(own.alias("by"), *keys, "total", "revenue")


def _of_counts(counts: DataFrame, key: str, *columns: str) -> DataFrame:
    return counts.filter(F.col("by") == key).select(key, *columns)


def report_suite(tables: Tables, year: int, only_top: int | None = None) -> dict[str, DataFrame]:
    """r10, r11, r12, r14, r15 and r16 of a year, with the rows that each gives alone, from one scan of the tickets.

    The counts are kept in the shared folder, so a report that is run again reads those.
    """
    counts = store(ticket_counts(tables, year))
    return {
        "r10": employees_by_tickets(tables, year, only_top=only_top, counts=counts),
        "r11": cabin_types_by_tickets(tables, year, counts),
        "r12": locations_by_tickets(tables, year, counts=counts),
        "r14": payment_types_by_tickets(tables, year, counts=counts),
        "r15": revenue_by_date(tables, year, counts),
        "r16": hours_by_tickets(tables, year, counts),
    }


def _tickets_by(tables: Tables, key: str, date: str, year: int, counts: DataFrame | None = None) -> DataFrame:
    if counts is not None:
        found = _of_counts(counts, key, "total")
        return found.filter(F.col(key).isNotNull()).withColumn("year", F.lit(year))
    return (
        tables("tickets", key, date)
        .filter(in_year(date, year) & F.col(key).isNotNull())
        .groupBy(key)
        .agg(_count().alias("total"))
        .withColumn("year", F.lit(year))
    )


def _lookup_ranking(
    tables: Tables,
    year: int,
    table: str,
    key: str,
    ticket_key: str,
    name: str,
    top: int | None,
    ascending: bool = False,
    only_top: int | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Rows of a keyed table ranked by the tickets that point at them."""
    dim = tables(table, key, "name")
    counted = _tickets_by(tables, ticket_key, "purchase_date", year, counts).withColumnRenamed(ticket_key, key)
    named = counted.join(dim.withColumnRenamed("name", name), key)
    placed = ranked(named, [F.desc("total"), F.asc(key)], top=top, bound=dim, only_top=only_top)
    shown = ["orden", "year", key, name, "total"] + (["position"] if top is not None else [])
    shown_rows = placed.select(*shown)
    return shown_rows.orderBy(F.asc("total"), F.desc("orden")) if ascending else shown_rows


def employees_by_tickets(
    tables: Tables, year: int, top: int = 3, only_top: int | None = None, counts: DataFrame | None = None
) -> DataFrame:
    staff = tables("employees", "employee_id", "first_name", "last_name")
    counted = _tickets_by(tables, "employee_id", "purchase_date", year, counts)
    named = counted.join(staff, "employee_id").withColumn("name", full_name("first_name", "last_name"))
    placed = ranked(named, [F.desc("total"), F.asc("employee_id")], top=top, bound=staff, only_top=only_top)
    return placed.select("orden", "year", "employee_id", "name", "total", "position")


def cabin_types_by_tickets(tables: Tables, year: int, counts: DataFrame | None = None) -> DataFrame:
    return _lookup_ranking(
        tables, year, "cabin_types", "cabin_type_id", "cabin_type_id", "cabin_type_name", None, counts=counts
    )


def locations_by_tickets(
    tables: Tables, year: int, top: int = 1, output_order: str = "asc", counts: DataFrame | None = None
) -> DataFrame:
    ascending = output_order == "asc"
    return _lookup_ranking(
        tables, year, "locations", "location_id", "purchase_location_id", "location_name", top, ascending, counts=counts
    )


def payment_types_by_tickets(
    tables: Tables, year: int, top: int = 1, counts: DataFrame | None = None
) -> DataFrame:
    return _lookup_ranking(
        tables, year, "payment_types", "payment_type_id", "payment_type_id", "payment_type_name", top, counts=counts
    )


def hours_by_tickets(tables: Tables, year: int, counts: DataFrame | None = None) -> DataFrame:
    if counts is None:
        hours = (
            tables("tickets", "purchase_date", "purchase_time")
            .filter(in_year("purchase_date", year))
            .groupBy(hour_of("purchase_time").alias("purchase_time"))
            .agg(_count().alias("total"))
        )
    else:
        hours = _of_counts(counts, "hour", "total").withColumnRenamed("hour", "purchase_time")
    # 24 hours and the missing one
    placed = ranked(hours, [F.desc("total"), F.asc("purchase_time")], top=1, bound=25)
    return placed.select("orden", "purchase_time", "total", "position")


def _residents(tables: Tables, people: str, place: str, key: str, top: int, only_top: int | None) -> DataFrame:
    places = tables(place, key, "name")
    counted = tables(people, key).filter(F.col(key).isNotNull()).groupBy(key).agg(_count().alias("total"))
    named = counted.join(places, key)
    placed = ranked(named, [F.desc("total"), F.asc(key)], top=top, bound=places, only_top=only_top)
    return placed.select("orden", "name", "total", "position")


def cities_by_customers(tables: Tables, top: int = 3, only_top: int | None = None) -> DataFrame:
    return _residents(tables, "customers", "cities_states", "city_state_id", top, only_top)


def zipcodes_by_employees(tables: Tables, top: int = 6, only_top: int | None = None) -> DataFrame:
    return _residents(tables, "employees", "zipcodes", "zipcode_id", top, only_top)


def customers_by_tickets(tables: Tables, year: int, top: int = 3, only_top: int | None = None) -> DataFrame:
    """Customers ranked by tickets; ``only_top`` skips ranking the millions that follow."""
    people = tables("customers", "customer_id", "first_name", "last_name").select(
        "customer_id", full_name("first_name", "last_name").alias("customer_name")
    )
    counted = _tickets_by(tables, "customer_id", "purchase_date", year)
    order = [F.desc("total"), F.asc("customer_id")]
    placed = ranked(counted.join(people, "customer_id"), order, top=top, only_top=only_top)
    return placed.select("orden", "year", "customer_name", "total", "position")


def weekend_routes(
    tables: Tables, year: int, weekdays: Sequence[int] = (6, 7), only_top: int | None = None
) -> DataFrame:
    """Routes of the given weekdays ranked by tickets of a year."""
    routes = _chosen_routes(tables, None, None, weekdays, "inner").select(
        "route_id", "start_time", "weekday_name", F.col("city_state").alias("city_state_origin_name")
    )
    flights = tables("flights", "flight_id", "date", "route_id").filter(in_year("date", year))
    flights = flights.select("flight_id", "route_id", F.year("date").alias("year"))
    used = _tickets_per_route(tables, flights, routes, ["year"]).join(routes, "route_id")
    order = [F.desc("tickets"), F.asc("route_id")]
    placed = ranked(used, order, top=1, bound=tables("routes", "route_id"), only_top=only_top)
    return placed.select(
        "orden", "year", "weekday_name", "route_id", "start_time", "city_state_origin_name", "tickets", "position"
    )


# --- people ----------------------------------------------------------------------------------


def top_customers_by_age(tables: Tables, as_of: datetime.date | None = None, n: int = 100) -> DataFrame:
    """The youngest customers with their city."""
    people = tables("customers", "customer_id", "first_name", "last_name", "birth_date", "city_state_id")
    cities = tables("cities_states", "city_state_id", "name")
    aged = join_dim(people, cities, "city_state_id", spread_by=["customer_id"]).select(
        "customer_id",
        "first_name",
        "last_name",
        "birth_date",
        year_diff("birth_date", _day(as_of)).alias("current_age"),
        "name",
    )
    return first_n(aged, [F.asc("current_age"), F.desc("birth_date"), F.asc("customer_id")], n)


def top_routes_by_weekday(tables: Tables, years: Sequence[int], n: int = 3) -> DataFrame:
    """Best-selling routes of each weekday with both cities; flights without tickets count 0."""
    routes = tables("routes", "route_id", "weekday_id", "city_state_id_origin", "city_state_id_destination")
    for key, name in (
        ("city_state_id_origin", "city_name_origin"),
        ("city_state_id_destination", "city_name_destination"),
    ):
        routes = routes.join(_city(tables, key, name), key)
    routes = routes.join(_weekdays(tables), "weekday_id")
    flights = tables("flights", "flight_id", "route_id")
    if isinstance(tables, CountedTables):
        counted = tables.counts.per_flight(years)
        flown = flights.join(counted, "flight_id", "left").fillna(0, ["tickets"])
    else:
        sold = tables("tickets", "flight_id", "boarding_date").filter(in_year("boarding_date", *years))
        flown = counts_per_outer(flights, sold, "flight_id", "tickets")
    group = ["route_id", "city_name_origin", "city_name_destination", "weekday_id", "weekday_name"]
    # to route grain before meeting the route table
    demand = (
        flown.groupBy("route_id")
        .agg(F.sum("tickets").alias("total_flights"))
        .join(routes.select(*group), "route_id")
    )
    best = top_n_per_group(demand, "weekday_name", [F.desc("total_flights"), F.asc("route_id")], n)
    return best.select("position", *group, "total_flights").orderBy("weekday_id", "weekday_name", "position")


def _flown_per_customer(tables: Tables, years: Sequence[int]) -> DataFrame:
    """Tickets on known flights per registered customer, by boarding year."""
    if isinstance(tables, CountedTables):
        return tables.counts.per_customer(years)
    tickets = (
        tables("tickets", "ticket_id", "flight_id", "customer_id", "boarding_date")
        .filter(in_year("boarding_date", *years))
        .filter(F.col("customer_id").isNotNull() & F.col("flight_id").isNotNull())
        .drop("boarding_date")
    )
    flights = tables("flights", "flight_id")
    boarded = tables("tickets", "flight_id", "boarding_date").filter(in_year("boarding_date", *years))
    known = join_dim(tickets, flights, "flight_id", "left_semi", ["ticket_id"], hot_from=boarded)
    return known.groupBy("customer_id").agg(_count().alias("n"))


def city_gender_counts(tables: Tables, years: Sequence[int], n: int = 20) -> DataFrame:
    """Cities by tickets of their residents, split by gender; same-named cities count as one."""
    people = tables("customers", "customer_id", "gender", "city_state_id")
    per_city = (
        _flown_per_customer(tables, years)
        .join(people, "customer_id")
        .groupBy("city_state_id", "gender")
        .agg(F.sum("n").alias("n"))
        .join(_city(tables, "city_state_id", "city_name"), "city_state_id")
    )
    cases = {
        "flights_gender_M": F.col("gender") == "M",
        "flights_gender_F": F.col("gender") == "F",
        "flights_total": F.lit(True),
    }
    counted = conditional_counts(per_city, "city_name", cases, F.col("n"))
    return first_n(counted, [F.desc("flights_total"), F.asc("city_name")], n)


def top_cities_by_age_group(
    tables: Tables,
    years: Sequence[int],
    as_of: datetime.date | None = None,
    n: int = 3,
    by_flights: bool = False,
    bands: Sequence[tuple[int, int, str]] = AGE_BANDS,
) -> DataFrame:
    """Best cities of each age group by customers that flew.

    Customers are unique after the per-customer count, so the distinct count is a plain one.
    ``by_flights`` breaks ties of customers by flights before the city name.
    """
    people = tables("customers", "customer_id", "birth_date", "city_state_id").select(
        "customer_id", "city_state_id", band(year_diff("birth_date", _day(as_of)), bands).alias("age_group")
    )
    per_city = (
        _flown_per_customer(tables, years)
        .join(people, "customer_id")
        .groupBy("city_state_id", "age_group")
        .agg(_count().alias("customers"), F.sum("n").alias("n"))
        .join(_city(tables, "city_state_id", "city_name"), "city_state_id")
        .groupBy("city_name", "age_group")
        .agg(F.sum("customers").alias("customers_total"), F.sum("n").alias("flights_total"))
    )
    order = [F.desc("customers_total"), *([F.desc("flights_total")] if by_flights else []), F.asc("city_name")]
    best = top_n_per_group(per_city, "age_group", order, n)
    return best.select("position", "city_name", "age_group", "customers_total", "flights_total").orderBy(
        "age_group", "position", F.desc("flights_total")
    )


# Inventory id -> the report as the reference asks it.
REPORTS: dict[str, Callable[..., DataFrame]] = {
    "r01": lambda t, year=2016, **kw: capacity_threshold(t, year, **{"op": ">", "divisor": 2, **kw}),
    "r02": lambda t, year=2017, **kw: capacity_threshold(t, year, **{"op": "<", "divisor": 4, **kw}),
    "r03": lambda t, year=2017: route_extremes(t, year),
    "r04a": lambda t, **kw: eligible_discount(t, "Student Discount", 16, 23, **kw),
    "r04b": lambda t, **kw: eligible_discount(t, "Elderly Discount", 65, None, **kw),
    "r05": lambda t, years=(2016, 2017), **kw: registered_ratio(t, years, **kw),
    "r06": lambda t, origin="Tampa", **kw: busiest_routes(t, origin, **kw),
    "r07": lambda t, origin="Orlando", **kw: busiest_times(t, origin, **kw),
    "r08": lambda t, year=2017, **kw: departure_justified(t, year, **kw),
    "r09": lambda t, year=2017, **kw: months_by_tickets(t, year, **kw),
    "r10": lambda t, year=2017, **kw: employees_by_tickets(t, year, **kw),
    "r11": lambda t, year=2017: cabin_types_by_tickets(t, year),
    "r12": lambda t, year=2016, **kw: locations_by_tickets(t, year, **kw),
    "r13": lambda t, **kw: full_flights(t, **kw),
    "r14": lambda t, year=2017, **kw: payment_types_by_tickets(t, year, **kw),
    "r15": lambda t, year=2017: revenue_by_date(t, year),
    "r16": lambda t, year=2017: hours_by_tickets(t, year),
    "r17": lambda t, **kw: cities_by_customers(t, **kw),
    "r18": lambda t, **kw: zipcodes_by_employees(t, **kw),
    "r19": lambda t, year=2017, **kw: customers_by_tickets(t, year, **kw),
    "r20": lambda t, year=2017, **kw: weekend_routes(t, year, **kw),
    "v06": lambda t, as_of=None, **kw: top_customers_by_age(t, as_of, **kw),
    "v07": lambda t, years=(2016, 2017), **kw: top_routes_by_weekday(t, years, **kw),
    "v08": lambda t, years=(2016, 2017), **kw: city_gender_counts(t, years, **kw),
    "v09": lambda t, as_of=None, years=(2016, 2017), **kw: top_cities_by_age_group(t, years, as_of, **kw),
}

VIEWS = {
    "youngest_customers": "v06",
    "top_routes_by_weekday": "v07",
    "city_gender_counts": "v08",
    "top_cities_by_age_group": "v09",
}


def register_views(tables: Tables, as_of: datetime.date) -> None:
    """The four view reports as temporary views for ``spark.sql``."""
    for name, key in VIEWS.items():
        dated = {"as_of": as_of} if key in ("v06", "v09") else {}
        REPORTS[key](tables, **dated).createOrReplaceTempView(name)
