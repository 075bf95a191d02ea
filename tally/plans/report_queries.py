"""The reports on the test tables: orders of 1996 and 1997 stand for the two report years."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.plans.bindings import AS_OF, DESTINATION, ORIGIN, EventTickets, OrderTables
from tally.plans.registry import query
from tally.plans.reports import REPORTS, busiest_routes, registered_ratio, report_suite

Y1, Y2 = 1996, 1997


def _year(column: str, first: int, last: int | None = None) -> str:
    return f"{column} >= DATE '{first}-01-01' AND {column} < DATE '{(last or first) + 1}-01-01'"


def _report(key: str, sql: str, tables: str, source: type = OrderTables, **kwargs: object) -> None:
    query(key, sql, tables)(lambda spark, sf_dir: REPORTS[key](source(spark, sf_dir), **kwargs))


_report(
    "r01",
    f"""
    SELECT flight_id, n AS cantidad, capacity
    FROM (SELECT flight_id, count(*) AS n FROM tickets GROUP BY flight_id)
    JOIN flights USING (flight_id) JOIN planes USING (plane_id)
    WHERE {_year("date", Y1)} AND n > capacity // 2
    ORDER BY n DESC, flight_id""",
    "tickets flights planes",
    year=Y1,
)
_report(
    "r02",
    f"""
    SELECT flight_id, n AS cantidad, capacity
    FROM (SELECT flight_id, count(*) AS n FROM tickets GROUP BY flight_id)
    JOIN flights USING (flight_id) JOIN planes USING (plane_id)
    WHERE {_year("date", Y2)} AND n < capacity // 4
    ORDER BY n DESC, flight_id""",
    "tickets flights planes",
    year=Y2,
)
_report(
    "r03",
    f"""
    , per_route AS (
        SELECT route_id, CAST(sum(final_price) AS DECIMAL(20,2)) AS revenue, count(*) AS n
        FROM tickets JOIN flights USING (flight_id) JOIN routes USING (route_id)
        WHERE {_year("date", Y2)} GROUP BY route_id),
    top AS (SELECT * FROM per_route ORDER BY revenue DESC, route_id LIMIT 1),
    bottom AS (SELECT * FROM per_route ORDER BY revenue, route_id LIMIT 1)
    SELECT route_id, {Y2} AS year, CAST(0 AS DECIMAL(20,2)) AS min_revenue, revenue AS max_revenue, n AS flights FROM top
    UNION ALL
    SELECT route_id, {Y2}, revenue, CAST(0 AS DECIMAL(20,2)), n FROM bottom""",
    "tickets flights routes",
    year=Y2,
)


def _discount_sql(name: str, age: str) -> str:
    return f"""
    SELECT count(*) AS "{name} count",
           CAST(sum(final_price) * (SELECT percentage FROM discounts WHERE name = '{name}') AS DECIMAL(26,4))
               AS total_discount
    FROM tickets t
    WHERE EXISTS (SELECT 1 FROM customers c WHERE c.customer_id = t.customer_id
                  AND date_diff('year', c.birth_date, t.purchase_date) {age})"""


_report("r04a", _discount_sql("Student Discount", "BETWEEN 16 AND 23"), "tickets customers discounts")
_report("r04b", _discount_sql("Elderly Discount", ">= 65"), "tickets customers discounts")

_report(
    "r05",
    f"""
    SELECT CAST(year(boarding_date) AS INTEGER) AS year,
           CAST(count(customer_id) / nullif(count(*) - count(customer_id), 0) AS DECIMAL(23,13)) AS ratio
    FROM tickets WHERE {_year("boarding_date", Y1, Y2)} GROUP BY 1""",
    "tickets",
    years=(Y1, Y2),
)
query(
    "r05_monthly",
    f"""
    , months AS (
        SELECT CAST(year(boarding_date) AS INTEGER) AS year, month(boarding_date) AS month,
               CAST(count(customer_id) / nullif(count(*) - count(customer_id), 0) AS DECIMAL(23,13)) AS r
        FROM tickets WHERE {_year("boarding_date", Y1, Y2)} GROUP BY 1, 2)
    SELECT year, CAST(round(avg(r), 8) AS DECIMAL(18,8)) AS ratio FROM months GROUP BY year""",
    "tickets",
)(
    lambda spark, sf_dir: registered_ratio(OrderTables(spark, sf_dir), (Y1, Y2), monthly=True).selectExpr(
        "year", "CAST(round(ratio, 8) AS DECIMAL(18,8)) AS ratio"
    )
)


def _busiest_sql(key: str, origin: str, extra: str = "") -> str:
    return f"""
    , demand AS (
        SELECT {key}, weekday_id, w.name AS weekday_name, c.name AS city_state, count(*) AS total_tickets
        FROM tickets JOIN flights USING (flight_id) JOIN routes r USING (route_id)
        JOIN weekdays w USING (weekday_id) JOIN cities_states c ON c.city_state_id = r.city_state_id_origin
        WHERE c.name = '{origin}' {extra} GROUP BY ALL)
    SELECT row_number() OVER (PARTITION BY weekday_id ORDER BY total_tickets DESC, {key} NULLS FIRST) AS position, *
    FROM demand QUALIFY position <= 1 ORDER BY weekday_id"""


_report("r06", _busiest_sql("route_id", ORIGIN), "tickets flights routes weekdays cities_states", origin=ORIGIN)
query(
    "r06_destination",
    _busiest_sql(
        "route_id",
        ORIGIN,
        f"AND (SELECT e.name FROM cities_states e WHERE e.city_state_id = r.city_state_id_destination) = '{DESTINATION}'",
    ),
    "tickets flights routes weekdays cities_states",
)(lambda spark, sf_dir: busiest_routes(OrderTables(spark, sf_dir), ORIGIN, DESTINATION))
_report(
    "r07",
    _busiest_sql("start_time_actual", DESTINATION),
    "tickets flights routes weekdays cities_states",
    origin=DESTINATION,
)
_report(
    "r08",
    f"""
    SELECT row_number() OVER (ORDER BY n DESC, flight_id) AS orden, CAST(year(date) AS INTEGER) AS year, flight_id,
           n AS tickets, CASE WHEN n > capacity * 0.25 THEN 'YES' ELSE 'NO' END AS justify
    FROM (SELECT flight_id, count(*) AS n FROM tickets GROUP BY flight_id)
    JOIN flights USING (flight_id) LEFT JOIN planes USING (plane_id)
    WHERE {_year("date", Y2)} ORDER BY orden""",
    "tickets flights planes",
    year=Y2,
)
_report(
    "r09",
    f"""
    , months AS (
        SELECT CAST(year(date) AS INTEGER) AS year, strftime(date, '%m - %B') AS month, count(*) AS tickets
        FROM tickets JOIN flights USING (flight_id) WHERE {_year("date", Y2)} GROUP BY 1, 2),
    placed AS (SELECT row_number() OVER (ORDER BY tickets DESC, month) AS orden, * FROM months)
    SELECT *, CASE orden WHEN 1 THEN 'HIGHEST' WHEN 12 THEN 'LOWEST' END AS position FROM placed ORDER BY orden""",
    "tickets flights",
    year=Y2,
)


def _ranking_sql(key: str, ticket_key: str, table: str, name: str, alias: str, year: int, top: int | None) -> str:
    label = f", CASE WHEN orden <= {top} THEN 'TOP {top}' END AS position" if top else ""
    return f"""
    , sold AS (
        SELECT CAST(year(purchase_date) AS INTEGER) AS year, {ticket_key} AS {key}, count(*) AS total
        FROM tickets WHERE {_year("purchase_date", year)} GROUP BY 1, 2),
    placed AS (
        SELECT row_number() OVER (ORDER BY total DESC, {key}) AS orden, year, {key}, {name} AS {alias}, total
        FROM sold JOIN {table} USING ({key}))
    SELECT *{label} FROM placed"""


_report(
    "r10",
    _ranking_sql("employee_id", "employee_id", "employees", "first_name || ' ' || last_name", "name", Y2, 3),
    "tickets employees",
    year=Y2,
)
_report(
    "r11",
    _ranking_sql("cabin_type_id", "cabin_type_id", "cabin_types", "name", "cabin_type_name", Y2, None),
    "tickets cabin_types",
    year=Y2,
)
_report(
    "r12",
    _ranking_sql("location_id", "purchase_location_id", "locations", "name", "location_name", Y1, 1),
    "tickets locations",
    year=Y1,
)
_report(
    "r13",
    """
    , flagged AS (
        SELECT CAST(year(date) AS INTEGER) AS year, flight_id, plane_id, n AS tickets,
               CASE WHEN n = capacity THEN 'YES' ELSE 'NO' END AS "full capacity"
        FROM (SELECT flight_id, count(*) AS n FROM tickets GROUP BY flight_id)
        JOIN flights USING (flight_id) LEFT JOIN planes USING (plane_id))
    SELECT row_number() OVER (ORDER BY "full capacity", flight_id) AS orden, * FROM flagged
    ORDER BY "full capacity" DESC, orden""",
    "tickets flights planes",
)
_report(
    "r14",
    _ranking_sql("payment_type_id", "payment_type_id", "payment_types", "name", "payment_type_name", Y2, 1),
    "tickets payment_types",
    year=Y2,
)
_report(
    "r15",
    f"""
    , days AS (
        SELECT purchase_date, CAST(sum(final_price) AS DECIMAL(20,2)) AS revenue, count(*) AS total
        FROM tickets WHERE {_year("purchase_date", Y2)} GROUP BY purchase_date),
    placed AS (SELECT row_number() OVER (ORDER BY revenue DESC, purchase_date) AS orden, * FROM days)
    SELECT *, CASE WHEN orden = 1 THEN 'TOP 1' END AS position FROM placed ORDER BY orden""",
    "tickets",
    year=Y2,
)
_report(
    "r16",
    f"""
    , hours AS (
        SELECT CAST(substr(purchase_time, 1, 2) AS INTEGER) AS purchase_time, count(*) AS total
        FROM event_tickets WHERE {_year("purchase_date", 2024)} GROUP BY 1),
    placed AS (SELECT row_number() OVER (ORDER BY total DESC, purchase_time NULLS FIRST) AS orden, * FROM hours)
    SELECT *, CASE WHEN orden = 1 THEN 'TOP 1' END AS position FROM placed ORDER BY orden""",
    "event_tickets",
    EventTickets,
    year=2024,
)


def _residents_sql(people: str, place: str, key: str, top: int) -> str:
    return f"""
    , placed AS (
        SELECT row_number() OVER (ORDER BY count(*) DESC, {key}) AS orden, p.name, count(*) AS total
        FROM {people} JOIN {place} p USING ({key}) GROUP BY {key}, p.name)
    SELECT *, CASE WHEN orden <= {top} THEN 'TOP {top}' END AS position FROM placed ORDER BY orden"""


_report(
    "r17", _residents_sql("customers", "cities_states", "city_state_id", 3), "customers cities_states"
)
_report("r18", _residents_sql("employees", "zipcodes", "zipcode_id", 6), "employees zipcodes")
_report(
    "r19",
    f"""
    , sold AS (
        SELECT customer_id, CAST(year(purchase_date) AS INTEGER) AS year, count(*) AS total
        FROM tickets WHERE {_year("purchase_date", Y2)} GROUP BY 1, 2),
    placed AS (
        SELECT row_number() OVER (ORDER BY total DESC, customer_id) AS orden, year,
               first_name || ' ' || last_name AS customer_name, total
        FROM sold JOIN customers USING (customer_id))
    SELECT *, CASE WHEN orden <= 3 THEN 'TOP 3' END AS position FROM placed ORDER BY orden""",
    "tickets customers",
    year=Y2,
)
_report(
    "r20",
    f"""
    , used AS (
        SELECT CAST(year(date) AS INTEGER) AS year, w.name AS weekday_name, route_id, start_time,
               c.name AS city_state_origin_name, count(*) AS tickets
        FROM tickets JOIN flights USING (flight_id) JOIN routes r USING (route_id)
        JOIN weekdays w USING (weekday_id) JOIN cities_states c ON c.city_state_id = r.city_state_id_origin
        WHERE weekday_id IN (6, 7) AND {_year("date", Y2)} GROUP BY ALL),
    placed AS (SELECT row_number() OVER (ORDER BY tickets DESC, route_id) AS orden, * FROM used)
    SELECT *, CASE WHEN orden = 1 THEN 'TOP 1' END AS position FROM placed ORDER BY orden""",
    "tickets flights routes weekdays cities_states",
    year=Y2,
)
_report(
    "v06",
    f"""
    SELECT customer_id, first_name, last_name, birth_date,
           CAST(date_diff('year', birth_date, DATE '{AS_OF}') AS INTEGER) AS current_age, name
    FROM customers JOIN cities_states USING (city_state_id)
    ORDER BY current_age, birth_date DESC, customer_id LIMIT 100""",
    "customers cities_states",
    as_of=AS_OF,
)
_report(
    "v07",
    f"""
    , per_flight AS (
        SELECT route_id, (SELECT count(*) FROM tickets t WHERE t.flight_id = f.flight_id
                          AND {_year("boarding_date", Y1, Y2)}) AS n FROM flights f),
    demand AS (
        SELECT route_id, o.name AS city_name_origin, d.name AS city_name_destination, weekday_id,
               w.name AS weekday_name, CAST(sum(n) AS BIGINT) AS total_flights
        FROM per_flight JOIN routes r USING (route_id) JOIN weekdays w USING (weekday_id)
        JOIN cities_states o ON o.city_state_id = r.city_state_id_origin
        JOIN cities_states d ON d.city_state_id = r.city_state_id_destination GROUP BY ALL)
    SELECT row_number() OVER (PARTITION BY weekday_name ORDER BY total_flights DESC, route_id) AS position, *
    FROM demand QUALIFY position <= 3 ORDER BY weekday_id, position""",
    "tickets flights routes weekdays cities_states",
    years=(Y1, Y2),
)
_report(
    "v08",
    f"""
    , flown AS (
        SELECT c.name AS city_name, gender
        FROM tickets JOIN flights USING (flight_id) JOIN customers USING (customer_id)
        JOIN cities_states c USING (city_state_id) WHERE {_year("boarding_date", Y1, Y2)})
    SELECT city_name, CAST(sum(1) FILTER (gender = 'M') AS BIGINT) AS "flights_gender_M",
           CAST(sum(1) FILTER (gender = 'F') AS BIGINT) AS "flights_gender_F", count(*) AS flights_total
    FROM flown GROUP BY city_name ORDER BY flights_total DESC, city_name LIMIT 20""",
    "tickets flights customers cities_states",
    years=(Y1, Y2),
)
_report(
    "v09",
    f"""
    , flown AS (
        SELECT c.name AS city_name, customer_id, date_diff('year', birth_date, DATE '{AS_OF}') AS age
        FROM tickets JOIN flights USING (flight_id) JOIN customers USING (customer_id)
        JOIN cities_states c USING (city_state_id) WHERE {_year("boarding_date", Y1, Y2)}),
    grouped AS (
        SELECT city_name, CASE WHEN age BETWEEN 0 AND 25 THEN '00 - 25' WHEN age BETWEEN 26 AND 40 THEN '26 - 40'
                   WHEN age BETWEEN 41 AND 55 THEN '41 - 55' WHEN age BETWEEN 56 AND 70 THEN '56 - 70'
                   WHEN age BETWEEN 71 AND 100 THEN '71 - 100' END AS age_group,
               count(DISTINCT customer_id) AS customers_total, count(*) AS flights_total
        FROM flown GROUP BY 1, 2)
    SELECT row_number() OVER (PARTITION BY age_group ORDER BY customers_total DESC, city_name) AS position, *
    FROM grouped QUALIFY position <= 3 ORDER BY age_group, position""",
    "tickets flights customers cities_states",
    as_of=AS_OF,
    years=(Y1, Y2),
)


# --- the ticket rankings of a year from one scan ------------------------------------------------


class _TimedTickets(OrderTables):
    """The order tables, whose tickets also have a time of sale."""

    def _tickets(self, columns: tuple[str, ...]) -> DataFrame:
        kept = [c for c in columns if c not in ("purchase_time", "ticket_id")]
        hour = F.lpad((F.col("ticket_id") % 24).cast("string"), 2, "0")
        timed = F.when(F.col("ticket_id") % 40 != 0, F.concat(hour, F.lit(":30:00")))
        return super()._tickets((*kept, "ticket_id")).withColumn("purchase_time", timed)


def _suite_sql(key: str, ticket_key: str, table: str, name: str, top: int) -> str:
    label = f"CASE WHEN orden <= {top} THEN 'TOP {top}' END" if top else "CAST(NULL AS VARCHAR)"
    return f"""
    SELECT '{key}' AS report, orden, CAST(k AS VARCHAR) AS key, name, total,
           CAST(NULL AS DECIMAL(20,2)) AS revenue, {label} AS position
    FROM (SELECT row_number() OVER (ORDER BY total DESC, k) AS orden, k, {name} AS name, total
          FROM (SELECT {ticket_key} AS k, count(*) AS total FROM sold GROUP BY 1)
          JOIN {table} d ON k = d.{ticket_key.removeprefix("purchase_")})"""


@query(
    "r10_r16_suite",
    f"""
    , sold AS (
        SELECT *, CASE WHEN ticket_id % 40 <> 0 THEN CAST(ticket_id % 24 AS INTEGER) END AS hour
        FROM tickets WHERE {_year("purchase_date", Y2)})"""
    + _suite_sql("r10", "employee_id", "employees", "first_name || ' ' || last_name", 3)
    + " UNION ALL "
    + _suite_sql("r11", "cabin_type_id", "cabin_types", "d.name", 0)
    + " UNION ALL "
    + _suite_sql("r12", "purchase_location_id", "locations", "d.name", 1)
    + " UNION ALL "
    + _suite_sql("r14", "payment_type_id", "payment_types", "d.name", 1)
    + """
    UNION ALL
    SELECT 'r15', orden, CAST(purchase_date AS VARCHAR), NULL, total, revenue, CASE WHEN orden = 1 THEN 'TOP 1' END
    FROM (SELECT row_number() OVER (ORDER BY revenue DESC, purchase_date) AS orden, *
          FROM (SELECT purchase_date, CAST(sum(final_price) AS DECIMAL(20,2)) AS revenue, count(*) AS total
                FROM sold GROUP BY 1))
    UNION ALL
    SELECT 'r16', orden, CAST(hour AS VARCHAR), NULL, total, NULL, CASE WHEN orden = 1 THEN 'TOP 1' END
    FROM (SELECT row_number() OVER (ORDER BY total DESC, hour NULLS FIRST) AS orden, *
          FROM (SELECT hour, count(*) AS total FROM sold GROUP BY 1))""",
    "tickets employees cabin_types locations payment_types",
)
def r10_r16_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six rankings of a year, one below the other."""
    found = report_suite(_TimedTickets(spark, sf_dir), Y2)
    shown = {
        "r10": ("employee_id", "name"),
        "r11": ("cabin_type_id", "cabin_type_name"),
        "r12": ("location_id", "location_name"),
        "r14": ("payment_type_id", "payment_type_name"),
        "r15": ("purchase_date", None),
        "r16": ("purchase_time", None),
    }
    parts = [
        found[report].select(
            F.lit(report).alias("report"),
            "orden",
            F.col(key).cast("string").alias("key"),
            (F.col(name) if name else F.lit(None).cast("string")).alias("name"),
            "total",
            (F.col("revenue") if report == "r15" else F.lit(None).cast("decimal(20,2)")).alias("revenue"),
            (F.col("position") if report != "r11" else F.lit(None).cast("string")).alias("position"),
        )
        for report, (key, name) in shown.items()
    ]
    return functools.reduce(DataFrame.unionAll, parts)
