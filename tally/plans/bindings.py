"""The booking tables derived from the star-schema test tables.

``OrderTables`` answers like ``tally.sources.ParquetTables``, so every report runs on the
test data unchanged: an order is a flight, an order line a ticket.  Columns are only brought
in when asked for; a ticket's customer and payment type live on the order and cost a join.

``SQL`` holds the same derivations for the comparison queries.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.operators.joins import Hot, hot_keys, join_dim

# Fixed values of the binding.
PLANES = [(0, 8), (1, 12), (2, 13), (3, 16)]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
CABINS = [("A", "First Class"), ("N", "Second Class"), ("R", "Third Class")]
OUTLETS = [("F", "Airport"), ("O", "Online")]
PAYMENTS = [
    ("1-URGENT", "URGENT"),
    ("2-HIGH", "HIGH"),
    ("3-MEDIUM", "MEDIUM"),
    ("4-NOT SPECIFIED", "NOT SPECIFIED"),
    ("5-LOW", "LOW"),
]
DISCOUNTS = [(1, "Student Discount", "0.20"), (2, "Elderly Discount", "0.15")]
ROUTES = 112
AS_OF = datetime.date(2001, 12, 31)
ORIGIN, DESTINATION = "CITY_0", "CITY_1"


def part(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, with the schema it has now."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _values(rows: list[tuple], names: str) -> str:
    def literal(value: object) -> str:
        return f"'{value}'" if isinstance(value, str) else str(value)

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({names})"


class OrderTables:
    """Booking tables over region, nation, customer, supplier, orders and lineitem."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._hot: Hot | None = None

    def __call__(self, name: str, *columns: str) -> DataFrame:
        table = getattr(self, f"_{name}")(columns)
        return table.select(*columns) if columns else table

    def _read(self, name: str) -> DataFrame:
        return part(self.spark, self.sf_dir, name)

    def _tickets(self, columns: tuple[str, ...]) -> DataFrame:
        from_order = {"customer_id", "payment_type_id"}
        price = F.col("l_extendedprice").cast("decimal(10,2)")
        lines = self._read("lineitem").select(
            (F.col("l_partkey") * 100 + F.col("l_linenumber")).alias("ticket_id"),
            F.col("l_orderkey").alias("flight_id"),
            F.col("l_suppkey").alias("employee_id"),
            F.to_date("l_shipdate").alias("purchase_date"),
            F.to_date("l_shipdate").alias("boarding_date"),
            F.col("l_linestatus").alias("purchase_location_id"),
            F.col("l_returnflag").alias("cabin_type_id"),
            price.alias("final_price"),
        )
        wanted = [c for c in columns if c in from_order] if columns else sorted(from_order)
        if not wanted:
            return lines
        anonymous = F.col("o_orderkey") % 10 == 0
        buyers = self._read("orders").select(
            F.col("o_orderkey").alias("flight_id"),
            F.when(~anonymous, F.col("o_custkey")).alias("customer_id"),
            F.col("o_orderpriority").alias("payment_type_id"),
        )
        own = [c for c in columns if c not in from_order] if columns else lines.columns
        kept = list(dict.fromkeys(["flight_id", "ticket_id", *own]))
        return join_dim(
            lines.select(*kept), buyers.select("flight_id", *wanted), "flight_id", "left", hot_from=self.hot_flights
        )

    def hot_flights(self) -> Hot:
        """Looked for once per binding, and only if a join is not broadcast."""
        if self._hot is None:
            self._hot = hot_keys(self._read("lineitem").select("l_orderkey"), "l_orderkey")
        return self._hot

    def _flights(self, columns: tuple[str, ...]) -> DataFrame:
        key = F.col("o_orderkey")
        slot = F.call_function("div", key % ROUTES, F.lit(14))
        departure = F.concat(
            F.lpad((slot * 2 + 6).cast("string"), 2, "0"),
            F.lit(":"),
            F.lpad(((key % 4) * 15).cast("string"), 2, "0"),
            F.lit(":00"),
        )
        return self._read("orders").select(
            key.alias("flight_id"),
            F.to_date("o_orderdate").alias("date"),
            F.when(key % 97 != 0, departure).alias("start_time_actual"),
            (key % ROUTES + 1).cast("int").alias("route_id"),
            (key % 4).cast("int").alias("plane_id"),
        )

    def _planes(self, columns: tuple[str, ...]) -> DataFrame:
        return self.spark.sql(_values(PLANES, "plane_id, capacity"))

    def _routes(self, columns: tuple[str, ...]) -> DataFrame:
        zero = F.col("id")
        slot = F.call_function("div", zero, F.lit(14))
        outbound = F.call_function("div", zero, F.lit(7)) % 2 == 0
        return self.spark.range(ROUTES).select(
            (zero + 1).cast("int").alias("route_id"),
            F.when(outbound, 0).otherwise(1).alias("city_state_id_origin"),
            F.when(outbound, 1).otherwise(0).alias("city_state_id_destination"),
            F.concat(F.lpad((slot * 2 + 6).cast("string"), 2, "0"), F.lit(":00:00")).alias("start_time"),
            (zero % 7 + 1).cast("int").alias("weekday_id"),
        )

    def _weekdays(self, columns: tuple[str, ...]) -> DataFrame:
        return self.spark.sql(_values([(i, n, i) for i, n in enumerate(WEEKDAYS, 1)], "weekday_id, name, day_order"))

    def _cabin_types(self, columns: tuple[str, ...]) -> DataFrame:
        return self.spark.sql(_values(CABINS, "cabin_type_id, name"))

    def _locations(self, columns: tuple[str, ...]) -> DataFrame:
        return self.spark.sql(_values(OUTLETS, "location_id, name"))

    def _payment_types(self, columns: tuple[str, ...]) -> DataFrame:
        return self.spark.sql(_values(PAYMENTS, "payment_type_id, name"))

    def _discounts(self, columns: tuple[str, ...]) -> DataFrame:
        rows = self.spark.sql(_values(DISCOUNTS, "discount_id, name, percentage"))
        return rows.withColumn("percentage", F.col("percentage").cast("decimal(5,2)"))

    def _cities_states(self, columns: tuple[str, ...]) -> DataFrame:
        return self._read("nation").select(
            F.col("n_nationkey").alias("city_state_id"),
            F.concat(F.lit("CITY_"), (F.col("n_nationkey") % 20).cast("string")).alias("name"),
            F.col("n_regionkey").alias("state_id"),
        )

    def _states(self, columns: tuple[str, ...]) -> DataFrame:
        return self._read("region").select(F.col("r_regionkey").alias("state_id"), F.col("r_name").alias("name"))

    def _zipcodes(self, columns: tuple[str, ...]) -> DataFrame:
        return self._read("nation").select(
            F.col("n_nationkey").alias("zipcode_id"),
            F.concat(F.lit("Z"), F.lpad(F.col("n_nationkey").cast("string"), 4, "0")).alias("name"),
            F.col("n_regionkey").alias("state_id"),
        )

    def _customers(self, columns: tuple[str, ...]) -> DataFrame:
        key = F.col("c_custkey")
        born = F.date_add(F.lit(datetime.date(1920, 1, 1)), ((key * 37) % 25000).cast("int"))
        return self._read("customer").select(
            key.alias("customer_id"),
            F.col("c_mktsegment").alias("first_name"),
            F.when(key % 50 != 0, F.col("c_name")).alias("last_name"),
            born.alias("birth_date"),
            F.when(key % 3 == 0, "M").when(key % 3 == 1, "F").alias("gender"),
            F.col("c_nationkey").alias("city_state_id"),
            F.col("c_nationkey").alias("zipcode_id"),
        )

    def _employees(self, columns: tuple[str, ...]) -> DataFrame:
        key = F.col("s_suppkey")
        return self._read("supplier").select(
            key.alias("employee_id"),
            F.concat(F.lit("Staff"), (key % 9).cast("string")).alias("first_name"),
            F.when(key % 50 != 0, F.col("s_name")).alias("last_name"),
            F.col("s_nationkey").alias("city_state_id"),
            F.col("s_nationkey").alias("zipcode_id"),
        )

    def _routes_cabin_types(self, columns: tuple[str, ...]) -> DataFrame:
        """A list price per route and cabin: 20000 plus steps for each."""
        step = F.when(F.col("cabin_type_id") == "A", 12000).when(F.col("cabin_type_id") == "N", 6000).otherwise(0)
        cabins = F.explode(F.array(*[F.lit(code) for code, _ in CABINS]))
        return (
            self.spark.range(ROUTES)
            .select((F.col("id") + 1).cast("int").alias("route_id"), cabins.alias("cabin_type_id"))
            .withColumn("price", (F.lit(20000) + (F.col("route_id") % 4) * 8000 + step).cast("decimal(10,2)"))
        )


class EventTickets:
    """Tickets sold at the moments of the events table."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __call__(self, name: str, *columns: str) -> DataFrame:
        if name != "tickets":
            raise KeyError(name)
        at = F.col("ts")
        return (
            part(self.spark, self.sf_dir, "events")
            .select(
                F.col("event_id").alias("ticket_id"),
                F.to_date(at).alias("purchase_date"),
                F.when(F.col("event_id") % 40 != 0, F.substring(at.cast("string"), 12, 8)).alias("purchase_time"),
            )
            .select(*columns)
        )


_SLOT = "lpad(CAST(6 + 2 * ({zero} // 14) AS VARCHAR), 2, '0')"

# The same tables for DuckDB.
SQL: dict[str, str] = {
    "tickets": """
        SELECT l.l_partkey * 100 + l.l_linenumber AS ticket_id, l.l_orderkey AS flight_id,
               CASE WHEN o.o_orderkey % 10 <> 0 THEN o.o_custkey END AS customer_id,
               l.l_suppkey AS employee_id, CAST(l.l_shipdate AS DATE) AS purchase_date,
               CAST(l.l_shipdate AS DATE) AS boarding_date, l.l_linestatus AS purchase_location_id,
               l.l_returnflag AS cabin_type_id, CAST(l.l_extendedprice AS DECIMAL(10,2)) AS final_price,
               o.o_orderpriority AS payment_type_id
        FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey""",
    "flights": f"""
        SELECT o_orderkey AS flight_id, CAST(o_orderdate AS DATE) AS date,
               CASE WHEN o_orderkey % 97 <> 0 THEN {_SLOT.format(zero=f"(o_orderkey % {ROUTES})")} || ':' ||
                    lpad(CAST((o_orderkey % 4) * 15 AS VARCHAR), 2, '0') || ':00' END AS start_time_actual,
               CAST(o_orderkey % {ROUTES} + 1 AS INTEGER) AS route_id, CAST(o_orderkey % 4 AS INTEGER) AS plane_id
        FROM orders""",
    "planes": _values(PLANES, "plane_id, capacity"),
    "routes": f"""
        SELECT CAST(i + 1 AS INTEGER) AS route_id, CAST(i // 7 % 2 AS INTEGER) AS city_state_id_origin,
               CAST(1 - i // 7 % 2 AS INTEGER) AS city_state_id_destination,
               {_SLOT.format(zero="i")} || ':00:00' AS start_time, CAST(i % 7 + 1 AS INTEGER) AS weekday_id
        FROM range({ROUTES}) AS r(i)""",
    "weekdays": _values([(i, n, i) for i, n in enumerate(WEEKDAYS, 1)], "weekday_id, name, day_order"),
    "cabin_types": _values(CABINS, "cabin_type_id, name"),
    "locations": _values(OUTLETS, "location_id, name"),
    "payment_types": _values(PAYMENTS, "payment_type_id, name"),
    "discounts": """
        SELECT discount_id, name, CAST(percentage AS DECIMAL(5,2)) AS percentage FROM ("""
    + _values(DISCOUNTS, "discount_id, name, percentage")
    + ") AS d",
    "cities_states": """
        SELECT n_nationkey AS city_state_id, 'CITY_' || CAST(n_nationkey % 20 AS VARCHAR) AS name,
               n_regionkey AS state_id FROM nation""",
    "states": "SELECT r_regionkey AS state_id, r_name AS name FROM region",
    "zipcodes": """
        SELECT n_nationkey AS zipcode_id, 'Z' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS name,
               n_regionkey AS state_id FROM nation""",
    "customers": """
        SELECT c_custkey AS customer_id, c_mktsegment AS first_name,
               CASE WHEN c_custkey % 50 <> 0 THEN c_name END AS last_name,
               DATE '1920-01-01' + CAST((c_custkey * 37) % 25000 AS INTEGER) AS birth_date,
               CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender,
               c_nationkey AS city_state_id, c_nationkey AS zipcode_id FROM customer""",
    "employees": """
        SELECT s_suppkey AS employee_id, 'Staff' || CAST(s_suppkey % 9 AS VARCHAR) AS first_name,
               CASE WHEN s_suppkey % 50 <> 0 THEN s_name END AS last_name,
               s_nationkey AS city_state_id, s_nationkey AS zipcode_id FROM supplier""",
    "routes_cabin_types": f"""
        SELECT CAST(i + 1 AS INTEGER) AS route_id, c AS cabin_type_id,
               CAST(20000 + (i + 1) % 4 * 8000 +
                    CASE c WHEN 'A' THEN 12000 WHEN 'N' THEN 6000 ELSE 0 END AS DECIMAL(10,2)) AS price
        FROM range({ROUTES}) AS r(i), (VALUES {", ".join(f"('{code}')" for code, _ in CABINS)}) AS v(c)""",
    "event_tickets": """
        SELECT event_id AS ticket_id, CAST(ts AS DATE) AS purchase_date,
               CASE WHEN event_id % 40 <> 0 THEN strftime(ts, '%H:%M:%S') END AS purchase_time FROM events""",
}


def with_tables(names: str, query: str) -> str:
    """``query`` with the named tables (space-separated) in front as CTEs.

    A query that starts with a comma goes on with CTEs of its own.
    """
    ctes = ",\n".join(f"{name} AS ({SQL[name].strip()})" for name in names.split())
    return f"WITH {ctes}\n{query.strip()}"

