"""Projections, filters, joins, aggregates, windows, sorts, set operations, functions, subqueries."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.functions import (
    band,
    full_name,
    hour_of,
    in_year,
    int_div,
    month_label,
    trimmed_length,
    year_diff,
)
from tally.operators.aggregates import conditional_counts, counts_per_outer, presence_ratio
from tally.operators.changes import apply_updates, pair_images
from tally.operators.joins import join_dim, lookup, semi_theta
from tally.operators.ranking import extremes, first_n, rank_all, ranked, top_n_per_group
from tally.plans.bindings import AS_OF, PLANES, EventTickets, OrderTables, part
from tally.plans.registry import query
from tally.plans.reports import AGE_BANDS
from tally.sources import append, load, read_insert_dump, write_insert_dump
from tally.workspace import fresh_path

MONEY = "decimal(20,2)"
BIG = "decimal(26,4)"


def _number_of_rows() -> Column:
    return F.count("*").alias("n")


# --- scans, sources, sinks -------------------------------------------------------------------

_ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
    ]
)


@query("src_scan", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def src_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders", _ORDERS)


_DUMPED = T.StructType(
    [
        T.StructField("item_id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("price", T.DecimalType(10, 2)),
        T.StructField("made_on", T.DateType()),
        T.StructField("sold_at", T.TimestampNTZType()),
    ]
)


@query(
    "src_seed",
    """
    SELECT CAST(p_partkey AS INTEGER) AS item_id,
           CASE WHEN p_partkey % 11 <> 0 THEN p_name || '''s (no. ' || CAST(p_partkey AS VARCHAR) || '), CAST ' END AS name,
           CAST(p_retailprice AS DECIMAL(10,2)) AS price,
           DATE '2000-01-01' + CAST(p_partkey % 3000 AS INTEGER) AS made_on,
           strftime(TIMESTAMP '2001-02-03 00:00:00' + to_minutes(CAST(p_partkey % 1440 AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS sold_at
    FROM part""",
)
def src_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and suppliers written as INSERT lines under one folder; the parts read back."""
    key = F.col("p_partkey")
    odd_name = F.concat("p_name", F.lit("'s (no. "), key.cast("string"), F.lit("), CAST "))
    items = part(spark, sf_dir, "part").select(
        key.cast("int").alias("item_id"),
        F.when(key % 11 != 0, odd_name).alias("name"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.date_add(F.lit(datetime.date(2000, 1, 1)), (key % 3000).cast("int")).alias("made_on"),
        F.expr("TIMESTAMP_NTZ'2001-02-03 00:00:00' + make_dt_interval(0, 0, CAST(p_partkey % 1440 AS INT), 0)").alias("sold_at"),
    )
    folder = fresh_path(spark, "dump")
    write_insert_dump(items, f"{folder}/items", "items")
    write_insert_dump(part(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), f"{folder}/staff", "staff")
    read = read_insert_dump(spark, f"{folder}/*", "items", _DUMPED)
    return read.withColumn("sold_at", F.date_format("sold_at", "yyyy-MM-dd HH:mm:ss"))


@query(
    "src_values",
    "SELECT capacity, count(*) AS flights FROM flights JOIN planes USING (plane_id) GROUP BY capacity",
    "flights planes",
)
def src_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ", ".join(str(row) for row in PLANES)
    planes = spark.sql(f"SELECT * FROM VALUES {rows} AS p(plane_id, capacity)")
    flights = OrderTables(spark, sf_dir)("flights", "plane_id")
    return flights.join(planes, "plane_id").groupBy("capacity").agg(F.count("*").alias("flights"))


@query(
    "src_ctas",
    """
    SELECT 1996 AS year, flight_id FROM flights WHERE year(date) = 1996
    UNION ALL SELECT 1997, flight_id FROM flights WHERE year(date) = 1997""",
    "flights",
)
def src_ctas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two selections put into one working set and read back."""
    flights = OrderTables(spark, sf_dir)("flights", "flight_id", "date")
    slices = [flights.filter(in_year("date", y)).select(F.lit(y).alias("year"), "flight_id") for y in (1996, 1997)]
    return slices[0].unionByName(slices[1]).select("*")


@query(
    "snk_append",
    """
    SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey < 12
    UNION ALL SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey >= 9""",
)
def snk_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = part(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    path = fresh_path(spark, "append")
    append(people.filter(F.col("c_nationkey") < 12), path)
    append(people.filter(F.col("c_nationkey") >= 9), path)
    return spark.read.schema(people.schema).parquet(path)


@query(
    "snk_update",
    """
    SELECT customer_id, CASE WHEN gender = 'F' THEN 'NEW ' || first_name ELSE first_name END AS first_name,
           CASE WHEN gender = 'F' THEN NULL ELSE gender END AS gender FROM customers""",
    "customers",
)
def snk_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = OrderTables(spark, sf_dir)("customers", "customer_id", "first_name", "gender")
    changes = people.filter(F.col("gender") == "F").select(
        "customer_id", F.concat(F.lit("NEW "), "first_name").alias("first_name"), F.lit(None).cast("string").alias("gender")
    )
    return apply_updates(people, changes, "customer_id", ["first_name", "gender"])


@query(
    "snk_result",
    "SELECT customer_id, last_name FROM customers ORDER BY last_name NULLS FIRST, customer_id DESC",
    "customers",
)
def snk_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = OrderTables(spark, sf_dir)("customers", "customer_id", "last_name")
    return people.orderBy(F.asc("last_name"), F.desc("customer_id"))


# --- projections, filters, predicates --------------------------------------------------------


@query("prj_col", "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def prj_col(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")


@query("prj_alias", 'SELECT o_orderkey AS flight, o_orderstatus AS "flight status" FROM orders')
def prj_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("flight"), F.col("o_orderstatus").alias("flight status")
    )


@query("prj_star", "SELECT * FROM customer")
def prj_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part(spark, sf_dir, "customer").select("*")


@query(
    "prj_const",
    "SELECT s_suppkey, 0 AS none_yet, CAST(NULL AS INTEGER) AS padding, 'YES' AS flag FROM supplier",
)
def prj_const(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part(spark, sf_dir, "supplier").select(
        "s_suppkey", F.lit(0).alias("none_yet"), F.lit(None).cast("int").alias("padding"), F.lit("YES").alias("flag")
    )


@query(
    "prj_expr",
    """
    SELECT ticket_id, flight_id, final_price, CAST(final_price * 0.20 AS DECIMAL(26,4)) AS total_discount
    FROM tickets""",
    "tickets",
)
def prj_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickets = OrderTables(spark, sf_dir)("tickets", "ticket_id", "flight_id", "final_price")
    rate = F.lit(Decimal("0.20"))
    return tickets.withColumn("total_discount", (F.col("final_price") * rate).cast(BIG))


def _filtered(key: str, table: str, cols: str, sql: str, condition: str) -> None:
    names = cols.split(", ")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return OrderTables(spark, sf_dir)(table, *names).filter(condition)

    query(key, f"SELECT {cols} FROM {table} WHERE {sql}", table)(run)


_filtered("flt_eq", "cities_states", "city_state_id, name", "name = 'CITY_3'", "name = 'CITY_3'")
_filtered(
    "flt_cmp",
    "tickets",
    "flight_id, ticket_id, final_price, purchase_location_id",
    "final_price >= 90000 AND purchase_location_id <> 'F'",
    "final_price >= 90000 AND purchase_location_id != 'F'",
)
_filtered(
    "flt_in",
    "tickets",
    "flight_id, ticket_id, payment_type_id",
    "payment_type_id IN ('1-URGENT', '5-LOW')",
    "payment_type_id IN ('1-URGENT', '5-LOW')",
)
_filtered("flt_null", "customers", "customer_id, gender", "gender IS NULL", "gender IS NULL")
_filtered(
    "flt_and",
    "customers",
    "customer_id, gender, city_state_id",
    "gender = 'F' AND city_state_id IS NOT NULL AND city_state_id > 4",
    "gender = 'F' AND city_state_id IS NOT NULL AND city_state_id > 4",
)


@query(
    "flt_year",
    """
    SELECT flight_id, date FROM flights
    WHERE year(date) IN (1996, 1997, 1999)""",
    "flights",
)
def flt_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return OrderTables(spark, sf_dir)("flights", "flight_id", "date").filter(in_year("date", 1996, 1997, 1999))


@query(
    "flt_between",
    """
    SELECT CASE WHEN final_price BETWEEN 30000 * 0.80 AND 30000 * 1.20 THEN 'inside' ELSE 'outside' END AS band,
           count(*) AS n
    FROM tickets GROUP BY 1""",
    "tickets",
)
def flt_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickets = OrderTables(spark, sf_dir)("tickets", "final_price")
    price, listed = F.col("final_price"), F.lit(30000)
    inside = price.between(listed * F.lit(Decimal("0.80")), listed * F.lit(Decimal("1.20")))
    return tickets.groupBy(F.when(inside, "inside").otherwise("outside").alias("band")).agg(_number_of_rows())


@query(
    "flt_having",
    "SELECT customer_id, count(*) AS n FROM tickets GROUP BY customer_id HAVING count(*) > 30",
    "tickets",
)
def flt_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickets = OrderTables(spark, sf_dir)("tickets", "customer_id")
    return tickets.groupBy("customer_id").agg(_number_of_rows()).filter(F.col("n") > 30)


@query(
    "flt_postwin",
    """
    SELECT flight_id, plane_id, row_number() OVER (PARTITION BY plane_id ORDER BY flight_id DESC) AS position
    FROM flights QUALIFY position <= 5""",
    "flights",
)
def flt_postwin(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = OrderTables(spark, sf_dir)("flights", "flight_id", "plane_id")
    return top_n_per_group(flights, "plane_id", [F.desc("flight_id")], 5)


# --- joins -----------------------------------------------------------------------------------


@query(
    "jn_inner",
    """
    SELECT t.ticket_id, flight_id, e.last_name FROM tickets t JOIN employees e USING (employee_id)
    WHERE e.last_name IS NOT NULL""",
    "tickets employees",
)
def jn_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = OrderTables(spark, sf_dir)
    staff = t("employees", "employee_id", "last_name").filter(F.col("last_name").isNotNull())
    tickets = t("tickets", "ticket_id", "flight_id", "employee_id")
    return join_dim(tickets, staff, "employee_id", spread_by=["ticket_id", "flight_id"]).drop("employee_id")


@query(
    "jn_chain",
    """
    SELECT capacity, w.name AS weekday_name, c.name AS city_state, count(*) AS n
    FROM tickets JOIN flights USING (flight_id) JOIN planes USING (plane_id) JOIN routes r USING (route_id)
    JOIN weekdays w USING (weekday_id) JOIN cities_states c ON c.city_state_id = r.city_state_id_origin
    GROUP BY ALL""",
    "tickets flights planes routes weekdays cities_states",
)
def jn_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six tables: tickets shrink to their flight, flights to (plane, route), then the lookups follow."""
    t = OrderTables(spark, sf_dir)
    sold = t("tickets", "flight_id").groupBy("flight_id").agg(_number_of_rows())
    grain = (
        t("flights", "flight_id", "plane_id", "route_id")
        .join(sold, "flight_id")
        .groupBy("plane_id", "route_id")
        .agg(F.sum("n").alias("n"))
    )
    weekdays = t("weekdays", "weekday_id", "name").withColumnRenamed("name", "weekday_name")
    cities = t("cities_states", "city_state_id", "name").toDF("city_state_id_origin", "city_state")
    return (
        grain.join(t("planes"), "plane_id")
        .join(t("routes", "route_id", "weekday_id", "city_state_id_origin"), "route_id")
        .join(weekdays, "weekday_id")
        .join(cities, "city_state_id_origin")
        .groupBy("capacity", "weekday_name", "city_state")
        .agg(F.sum("n").alias("n"))
    )


@query(
    "jn_role",
    """
    SELECT flight_id, o.name AS city_name_origin, d.name AS city_name_destination
    FROM flights JOIN routes r USING (route_id)
    JOIN cities_states o ON o.city_state_id = r.city_state_id_origin
    JOIN cities_states d ON d.city_state_id = r.city_state_id_destination""",
    "flights routes cities_states",
)
def jn_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = OrderTables(spark, sf_dir)
    cities = t("cities_states", "city_state_id", "name")
    o, d = cities.alias("o"), cities.alias("d")
    routes = (
        t("routes", "route_id", "city_state_id_origin", "city_state_id_destination")
        .join(o, F.col("city_state_id_origin") == F.col("o.city_state_id"))
        .join(d, F.col("city_state_id_destination") == F.col("d.city_state_id"))
        .select("route_id", F.col("o.name").alias("city_name_origin"), F.col("d.name").alias("city_name_destination"))
    )
    return join_dim(t("flights", "flight_id", "route_id"), routes, "route_id").drop("route_id")


@query(
    "jn_composite",
    """
    SELECT ticket_id, flight_id, route_id, cabin_type_id, final_price, price
    FROM tickets JOIN flights USING (flight_id) JOIN routes_cabin_types USING (route_id, cabin_type_id)""",
    "tickets flights routes_cabin_types",
)
def jn_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = OrderTables(spark, sf_dir)
    tickets = t("tickets", "ticket_id", "flight_id", "cabin_type_id", "final_price")
    flights = t("flights", "flight_id", "route_id")
    routed = join_dim(tickets, flights, "flight_id", spread_by=["ticket_id"], hot_from=t.hot_flights)
    priced = join_dim(routed, t("routes_cabin_types"), ["route_id", "cabin_type_id"], spread_by=["ticket_id", "flight_id"])
    return priced.select("ticket_id", "flight_id", "route_id", "cabin_type_id", "final_price", "price")


@query(
    "jn_composite_spread",
    """
    SELECT ticket_id, flight_id, route_id, cabin_type_id, final_price, price
    FROM tickets JOIN flights USING (flight_id) JOIN routes_cabin_types USING (route_id, cabin_type_id)""",
    "tickets flights routes_cabin_types",
)
def jn_composite_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without broadcasts: what runs when no side is small."""
    t = OrderTables(spark, sf_dir)
    tickets = t("tickets", "ticket_id", "flight_id", "cabin_type_id", "final_price")
    flights = t("flights", "flight_id", "route_id")
    routed = join_dim(tickets, flights, "flight_id", spread_by=["ticket_id"], limit=0, hot_from=t.hot_flights)
    keys = ["route_id", "cabin_type_id"]
    priced = join_dim(routed, t("routes_cabin_types"), keys, spread_by=["ticket_id", "flight_id"], limit=0)
    return priced.select("ticket_id", "flight_id", "route_id", "cabin_type_id", "final_price", "price")


@query(
    "jn_lookup_spread",
    """
    SELECT ticket_id, flight_id, employee_id,
           (SELECT first_name || ' ' || last_name FROM employees e WHERE e.employee_id = t.employee_id) AS name
    FROM tickets t""",
    "tickets employees",
)
def jn_lookup_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup without a broadcast."""
    t = OrderTables(spark, sf_dir)
    staff = t("employees", "employee_id", "first_name", "last_name").withColumn(
        "full_name", full_name("first_name", "last_name")
    )
    tickets = t("tickets", "ticket_id", "flight_id", "employee_id")
    named = lookup(tickets, staff, "employee_id", {"full_name": "name"}, limit=0)
    return named.select("ticket_id", "flight_id", "employee_id", "name")


@query(
    "jn_semi_theta",
    """
    SELECT customer_id, CAST(year(purchase_date) AS INTEGER) AS bought_in, count(*) AS n FROM tickets t
    WHERE customer_id IN (SELECT c.customer_id FROM customers c
                          WHERE date_diff('year', c.birth_date, t.purchase_date) BETWEEN 30 AND 35)
    GROUP BY 1, 2""",
    "tickets customers",
)
def jn_semi_theta(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = OrderTables(spark, sf_dir)
    bought = (
        t("tickets", "customer_id", "purchase_date")
        .groupBy("customer_id", F.year("purchase_date").alias("bought_in"))
        .agg(_number_of_rows())
    )
    people = t("customers", "customer_id", "birth_date").select("customer_id", F.year("birth_date").alias("born_in"))
    return semi_theta(bought, people, "customer_id", (F.col("bought_in") - F.col("born_in")).between(30, 35))


@query(
    "jn_selfkey",
    """
    SELECT coalesce(b.p_partkey, a.p_partkey) AS p_partkey, b.p_size AS size_before, a.p_size AS size_after
    FROM (SELECT * FROM part WHERE p_brand <> 'Brand#3') b
    FULL JOIN (SELECT p_partkey, p_size + p_partkey % 2 AS p_size FROM part WHERE p_type <> 'ECONOMY') a
    ON a.p_partkey = b.p_partkey""".replace("p_size + p_partkey % 2", "CAST(p_size + p_partkey % 2 AS INTEGER)"),
)
def jn_selfkey(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = part(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand", "p_type")
    before = items.filter(F.col("p_brand") != "Brand#3").select("p_partkey", "p_size")
    after = items.filter(F.col("p_type") != "ECONOMY").select(
        "p_partkey", (F.col("p_size") + F.col("p_partkey") % 2).cast("int").alias("p_size")
    )
    return pair_images(before, after, "p_partkey").select(
        "p_partkey", F.col("before.p_size").alias("size_before"), F.col("after.p_size").alias("size_after")
    )


@query(
    "jn_update",
    """
    SELECT p_partkey, CASE WHEN sold.n IS NULL THEN p_size ELSE CAST(sold.n AS INTEGER) END AS p_size
    FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey) sold
    ON sold.l_partkey = p_partkey""",
)
def jn_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = (
        part(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.count("*").cast("int").alias("p_size"))
    )
    return apply_updates(part(spark, sf_dir, "part").select("p_partkey", "p_size"), sold, "p_partkey", ["p_size"])


@query(
    "jn_lookup",
    """
    SELECT ticket_id, flight_id, employee_id,
           (SELECT first_name || ' ' || last_name FROM employees e WHERE e.employee_id = t.employee_id) AS name
    FROM tickets t""",
    "tickets employees",
)
def jn_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = OrderTables(spark, sf_dir)
    staff = t("employees", "employee_id", "first_name", "last_name").withColumn(
        "full_name", full_name("first_name", "last_name")
    )
    return lookup(t("tickets", "ticket_id", "flight_id", "employee_id"), staff, "employee_id", {"full_name": "name"}).select(
        "ticket_id", "flight_id", "employee_id", "name"
    )


@query(
    "jn_lookup2",
    """
    SELECT flight_id, c.name AS city_state FROM flights LEFT JOIN routes r USING (route_id)
    LEFT JOIN cities_states c ON c.city_state_id = r.city_state_id_origin""",
    "flights routes cities_states",
)
def jn_lookup2(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = OrderTables(spark, sf_dir)
    routed = lookup(t("flights", "flight_id", "route_id"), t("routes"), "route_id", {"city_state_id_origin": "city_state_id"})
    named = lookup(routed, t("cities_states"), "city_state_id", {"name": "city_state"})
    return named.select("flight_id", "city_state")


# --- aggregations ----------------------------------------------------------------------------


def _grouped(key: str, sql: str, table: str, cols: str, keys: list[str], **aggregates: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = OrderTables(spark, sf_dir)(table, *cols.split(", "))
        made = [F.expr(text).alias(name) for name, text in aggregates.items()]
        return source.groupBy(*[F.expr(k) for k in keys]).agg(*made)

    query(key, sql, table)(run)


_grouped(
    "ag_count",
    "SELECT cabin_type_id, count(*) AS total FROM tickets GROUP BY cabin_type_id",
    "tickets",
    "cabin_type_id",
    ["cabin_type_id"],
    total="count(*)",
)
_grouped(
    "ag_countcol",
    "SELECT purchase_location_id, count(customer_id) AS registered, count(*) AS total FROM tickets GROUP BY 1",
    "tickets",
    "purchase_location_id, customer_id",
    ["purchase_location_id"],
    registered="count(customer_id)",
    total="count(*)",
)
_grouped(
    "ag_countdist",
    "SELECT cabin_type_id, count(DISTINCT customer_id) AS customers FROM tickets GROUP BY cabin_type_id",
    "tickets",
    "cabin_type_id, customer_id",
    ["cabin_type_id"],
    customers="count(DISTINCT customer_id)",
)
_grouped(
    "ag_sum",
    """
    SELECT employee_id, CAST(sum(final_price) AS DECIMAL(20,2)) AS revenue FROM tickets GROUP BY employee_id""",
    "tickets",
    "employee_id, final_price",
    ["employee_id"],
    revenue="CAST(sum(final_price) AS DECIMAL(20,2))",
)
_grouped(
    "ag_global",
    "SELECT count(*) AS n, CAST(sum(final_price) AS DECIMAL(20,2)) AS revenue FROM tickets",
    "tickets",
    "final_price",
    [],
    n="count(*)",
    revenue="CAST(sum(final_price) AS DECIMAL(20,2))",
)
_grouped(
    "ag_multikey",
    """
    SELECT cabin_type_id, purchase_location_id, employee_id, count(*) AS n FROM tickets GROUP BY 1, 2, 3""",
    "tickets",
    "cabin_type_id, purchase_location_id, employee_id",
    ["cabin_type_id", "purchase_location_id", "employee_id"],
    n="count(*)",
)


@query(
    "ag_exprkey",
    """
    SELECT CAST(year(purchase_date) AS INTEGER) AS year, strftime(purchase_date, '%m - %B') AS month, count(*) AS n
    FROM tickets GROUP BY 1, 2""",
    "tickets",
)
def ag_exprkey(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickets = OrderTables(spark, sf_dir)("tickets", "purchase_date")
    day = F.col("purchase_date")
    return tickets.groupBy(F.year(day).alias("year"), month_label(day).alias("month")).agg(_number_of_rows())


@query(
    "ag_resum",
    """
    , per_flight AS (SELECT flight_id, employee_id, count(*) AS n FROM tickets GROUP BY 1, 2),
    per_pair AS (SELECT plane_id, employee_id, sum(n) AS n FROM per_flight JOIN flights USING (flight_id) GROUP BY 1, 2)
    SELECT plane_id, CAST(sum(n) AS BIGINT) AS tickets FROM per_pair GROUP BY 1""",
    "tickets flights",
)
def ag_resum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested sums flattened: only the flight grain is needed on the way to the plane."""
    t = OrderTables(spark, sf_dir)
    sold = t("tickets", "flight_id").groupBy("flight_id").agg(_number_of_rows())
    flights = t("flights", "flight_id", "plane_id")
    return flights.join(sold, "flight_id").groupBy("plane_id").agg(F.sum("n").alias("tickets"))


@query(
    "ag_dedup",
    "SELECT DISTINCT cabin_type_id, purchase_location_id FROM tickets",
    "tickets",
)
def ag_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return OrderTables(spark, sf_dir)("tickets", "cabin_type_id", "purchase_location_id").distinct()


@query(
    "ag_cond",
    """
    , branches AS (
        SELECT city_state_id, count(*) AS m, NULL AS f, NULL AS everyone FROM customers WHERE gender = 'M' GROUP BY 1
        UNION SELECT city_state_id, NULL, count(*), NULL FROM customers WHERE gender = 'F' GROUP BY 1
        UNION SELECT city_state_id, NULL, NULL, count(*) FROM customers GROUP BY 1)
    SELECT city_state_id, CAST(sum(m) AS BIGINT) AS m, CAST(sum(f) AS BIGINT) AS f,
           CAST(sum(everyone) AS BIGINT) AS everyone FROM branches GROUP BY city_state_id""",
    "customers",
)
def ag_cond(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = OrderTables(spark, sf_dir)("customers", "city_state_id", "gender")
    gender = F.col("gender")
    return conditional_counts(people, "city_state_id", {"m": gender == "M", "f": gender == "F", "everyone": F.lit(True)})


@query(
    "ag_minmax",
    """
    SELECT CAST(min(length(rtrim(last_name))) AS INTEGER) AS shortest,
           CAST(max(length(rtrim(first_name))) AS INTEGER) AS longest FROM customers""",
    "customers",
)
def ag_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return OrderTables(spark, sf_dir)("customers", "first_name", "last_name").agg(
        F.min(trimmed_length("last_name")).alias("shortest"), F.max(trimmed_length("first_name")).alias("longest")
    )


@query(
    "ag_ratio",
    """
    SELECT CAST(year(purchase_date) AS INTEGER) AS year,
           CAST(count(customer_id) / nullif(count(*) - count(customer_id), 0) AS DECIMAL(23,13)) AS ratio
    FROM tickets WHERE year(purchase_date) BETWEEN 1995 AND 2000 GROUP BY 1""",
    "tickets",
)
def ag_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickets = OrderTables(spark, sf_dir)("tickets", "customer_id", "purchase_date")
    return presence_ratio(tickets, "customer_id", range(1995, 2001), "purchase_date")


@query(
    "ag_corrcount",
    """
    SELECT customer_id, (SELECT count(*) FROM tickets t WHERE t.customer_id = c.customer_id
                         AND year(t.boarding_date) = 1996) AS flights FROM customers c""",
    "tickets customers",
)
def ag_corrcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = OrderTables(spark, sf_dir)
    tickets = t("tickets", "customer_id", "boarding_date").filter(in_year("boarding_date", 1996))
    return counts_per_outer(t("customers", "customer_id"), tickets, "customer_id", "flights")


# --- windows, sorts, top-k -------------------------------------------------------------------


@query(
    "wn_rankall",
    """
    SELECT row_number() OVER (ORDER BY count(*) DESC, flight_id) AS position, flight_id, count(*) AS n
    FROM tickets GROUP BY flight_id""",
    "tickets",
)
def wn_rankall(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = OrderTables(spark, sf_dir)("tickets", "flight_id").groupBy("flight_id").agg(_number_of_rows())
    return rank_all(sold, [F.desc("n"), F.asc("flight_id")])


@query(
    "wn_rankexpr",
    """
    SELECT row_number() OVER (ORDER BY CASE WHEN gender = 'M' THEN 'YES' ELSE 'NO' END, customer_id) AS position,
           customer_id, CASE WHEN gender = 'M' THEN 'YES' ELSE 'NO' END AS male
    FROM customers""",
    "customers",
)
def wn_rankexpr(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = OrderTables(spark, sf_dir)("customers", "customer_id", "gender")
    flagged = people.select("customer_id", F.when(F.col("gender") == "M", "YES").otherwise("NO").alias("male"))
    return rank_all(flagged, [F.asc("male"), F.asc("customer_id")])


@query(
    "wn_rankpart",
    """
    , sold AS (SELECT cabin_type_id, employee_id, count(*) AS n FROM tickets GROUP BY 1, 2)
    SELECT row_number() OVER (PARTITION BY cabin_type_id ORDER BY n DESC, employee_id) AS position, *
    FROM sold QUALIFY position <= 10""",
    "tickets",
)
def wn_rankpart(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = (
        OrderTables(spark, sf_dir)("tickets", "cabin_type_id", "employee_id")
        .groupBy("cabin_type_id", "employee_id")
        .agg(_number_of_rows())
    )
    return top_n_per_group(sold, "cabin_type_id", [F.desc("n"), F.asc("employee_id")], 10)


@query(
    "wn_rankpart2",
    """
    , sold AS (SELECT purchase_location_id, employee_id, count(*) AS n FROM tickets GROUP BY 1, 2)
    SELECT row_number() OVER (PARTITION BY purchase_location_id
                              ORDER BY purchase_location_id, n DESC, employee_id) AS position, *
    FROM sold QUALIFY position <= 3""",
    "tickets",
)
def wn_rankpart2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partition key repeated in the order adds nothing and is accepted."""
    sold = (
        OrderTables(spark, sf_dir)("tickets", "purchase_location_id", "employee_id")
        .groupBy("purchase_location_id", "employee_id")
        .agg(_number_of_rows())
    )
    order = [F.asc("purchase_location_id"), F.desc("n"), F.asc("employee_id")]
    return top_n_per_group(sold, "purchase_location_id", order, 3)


@query(
    "wn_label",
    """
    SELECT row_number() OVER (ORDER BY count(*) DESC, employee_id) AS orden, employee_id, count(*) AS total,
           CASE WHEN row_number() OVER (ORDER BY count(*) DESC, employee_id) IN (1, 2, 3) THEN 'TOP 3' END AS position
    FROM tickets GROUP BY employee_id""",
    "tickets",
)
def wn_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = OrderTables(spark, sf_dir)
    sold = t("tickets", "employee_id").groupBy("employee_id").agg(F.count("*").alias("total"))
    # employees are not joined, so their number is no bound on the ids found in tickets
    return ranked(sold, [F.desc("total"), F.asc("employee_id")], top=3)


@query(
    "so_order",
    "SELECT city_state_id, gender, customer_id FROM customers ORDER BY city_state_id DESC, gender NULLS FIRST, customer_id",
    "customers",
)
def so_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = OrderTables(spark, sf_dir)("customers", "city_state_id", "gender", "customer_id")
    return people.orderBy(F.desc("city_state_id"), F.asc("gender"), F.asc("customer_id"))


def _employee_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickets = OrderTables(spark, sf_dir)("tickets", "employee_id", "final_price")
    return tickets.groupBy("employee_id").agg(F.sum("final_price").cast(MONEY).alias("revenue"))


@query(
    "so_top1",
    """
    SELECT employee_id, CAST(sum(final_price) AS DECIMAL(20,2)) AS revenue FROM tickets
    GROUP BY employee_id ORDER BY revenue DESC, employee_id LIMIT 1""",
    "tickets",
)
def so_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_n(_employee_revenue(spark, sf_dir), [F.desc("revenue"), F.asc("employee_id")], 1)


@query(
    "so_topn",
    "SELECT flight_id, final_price, ticket_id FROM tickets ORDER BY final_price DESC, flight_id, ticket_id LIMIT 100",
    "tickets",
)
def so_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickets = OrderTables(spark, sf_dir)("tickets", "flight_id", "final_price", "ticket_id")
    return first_n(tickets, [F.desc("final_price"), F.asc("flight_id"), F.asc("ticket_id")], 100)


@query(
    "so_topngrp",
    """
    , bought AS (SELECT cabin_type_id, customer_id, count(*) AS n FROM tickets WHERE customer_id IS NOT NULL GROUP BY 1, 2)
    SELECT row_number() OVER (PARTITION BY cabin_type_id ORDER BY n DESC, customer_id) AS position, *
    FROM bought QUALIFY position <= 1200""",
    "tickets",
)
def so_topngrp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More rows per group than Spark cuts by itself, so groups are trimmed in pieces first."""
    bought = (
        OrderTables(spark, sf_dir)("tickets", "cabin_type_id", "customer_id")
        .filter(F.col("customer_id").isNotNull())
        .groupBy("cabin_type_id", "customer_id")
        .agg(_number_of_rows())
    )
    return top_n_per_group(bought, "cabin_type_id", [F.desc("n"), F.asc("customer_id")], 1200)


@query(
    "so_extremes",
    """
    , per_employee AS (SELECT employee_id, CAST(sum(final_price) AS DECIMAL(20,2)) AS revenue FROM tickets GROUP BY 1)
    SELECT * FROM (SELECT employee_id, CAST(0 AS DECIMAL(20,2)) AS min_revenue, revenue AS max_revenue
                   FROM per_employee ORDER BY revenue DESC, employee_id LIMIT 1)
    UNION ALL
    SELECT * FROM (SELECT employee_id, revenue, CAST(0 AS DECIMAL(20,2))
                   FROM per_employee ORDER BY revenue, employee_id LIMIT 1)""",
    "tickets",
)
def so_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extremes(_employee_revenue(spark, sf_dir), ["employee_id"], "revenue")


# --- set operations --------------------------------------------------------------------------


@query(
    "st_union",
    "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier",
)
def st_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = part(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    return people.union(part(spark, sf_dir, "supplier").select("s_nationkey")).distinct()


@query(
    "st_append",
    "SELECT c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier",
)
def st_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = part(spark, sf_dir, "customer").selectExpr("c_name AS name", "c_nationkey AS nation")
    return people.unionByName(part(spark, sf_dir, "supplier").selectExpr("s_nationkey AS nation", "s_name AS name"))


# --- scalar functions: each counts the rows of a table by the function's value ----------------


def _function(
    key: str, table: str, cols: str, made: Callable[[], Column], sql: str, source: type = OrderTables
) -> None:
    sql_table = "event_tickets" if source is EventTickets else table

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = source(spark, sf_dir)(table, *cols.split(", "))
        return rows.groupBy(made().alias("value")).agg(_number_of_rows())

    query(key, f"SELECT {sql} AS value, count(*) AS n FROM {sql_table} GROUP BY 1", sql_table)(run)


_function("fn_year", "flights", "date", lambda: F.year("date"), "CAST(year(date) AS INTEGER)")
_function("fn_month", "flights", "date", lambda: F.month("date"), "CAST(month(date) AS INTEGER)")
_function("fn_monthname", "flights", "date", lambda: F.date_format("date", "MMMM"), "monthname(date)")
_function("fn_monthlabel", "flights", "date", lambda: month_label("date"), "strftime(date, '%m - %B')")
_function(
    "fn_hour",
    "tickets",
    "purchase_time",
    lambda: hour_of("purchase_time"),
    "CAST(hour(CAST(purchase_time AS TIME)) AS INTEGER)",
    EventTickets,
)
_function(
    "fn_yeardiff",
    "customers",
    "birth_date",
    lambda: year_diff("birth_date", F.lit(AS_OF)),
    f"CAST(date_diff('year', birth_date, DATE '{AS_OF}') AS INTEGER)",
)
_function(
    "fn_today",
    "customers",
    "birth_date",
    lambda: F.datediff(F.lit(AS_OF), "birth_date") >= 18263,
    f"(DATE '{AS_OF}' - birth_date) >= 18263",
)
_function(
    "fn_convert",
    "employees",
    "employee_id",
    lambda: (F.col("employee_id") / 7).cast("decimal(10,2)"),
    "CAST((200 * employee_id + 7) // 14 / 100.0 AS DECIMAL(10,2))",
)
_function(
    "fn_cast",
    "flights",
    "date",
    lambda: F.concat(F.col("date").cast("string"), F.lit(" 23:59:59")).cast("timestamp_ntz").cast("date"),
    "make_date(year(date), month(date), day(date))",
)
_function(
    "fn_implicit",
    "flights",
    "plane_id, date",
    lambda: F.concat(F.col("plane_id").cast("string"), F.lit("/"), F.date_format("date", "yyyy-MM-dd")),
    "format('{}/{:04d}-{:02d}-{:02d}', plane_id, year(date), month(date), day(date))",
)
_function("fn_add", "flights", "date", lambda: F.month("date") + 100, "CAST(100 + month(date) AS INTEGER)")
_function(
    "fn_concat",
    "employees",
    "first_name, last_name",
    lambda: full_name("first_name", "last_name"),
    "first_name || ' ' || last_name",
)
_function(
    "fn_right",
    "flights",
    "date",
    lambda: F.right((F.month("date") + 100).cast("string"), F.lit(2)),
    "right(CAST(100 + month(date) AS VARCHAR), 2)",
)
_function(
    "fn_len",
    "customers",
    "first_name",
    lambda: trimmed_length(F.concat("first_name", F.lit("   "))),
    "CAST(length(rtrim(first_name || '   ')) AS INTEGER)",
)
_function(
    "fn_case",
    "customers",
    "gender",
    lambda: F.when(F.col("gender") == "M", "male").when(F.col("gender") == "F", "female"),
    "CASE WHEN gender = 'M' THEN 'male' WHEN gender = 'F' THEN 'female' END",
)
_function(
    "fn_band",
    "customers",
    "birth_date",
    lambda: band(year_diff("birth_date", F.lit(AS_OF)), AGE_BANDS),
    f"""CASE WHEN date_diff('year', birth_date, DATE '{AS_OF}') BETWEEN 0 AND 25 THEN '00 - 25'
         WHEN date_diff('year', birth_date, DATE '{AS_OF}') BETWEEN 26 AND 40 THEN '26 - 40'
         WHEN date_diff('year', birth_date, DATE '{AS_OF}') BETWEEN 41 AND 55 THEN '41 - 55'
         WHEN date_diff('year', birth_date, DATE '{AS_OF}') BETWEEN 56 AND 70 THEN '56 - 70'
         WHEN date_diff('year', birth_date, DATE '{AS_OF}') BETWEEN 71 AND 100 THEN '71 - 100' END""",
)
_function("fn_intdiv", "flights", "route_id", lambda: int_div("route_id", 4), "CAST(route_id // 4 AS BIGINT)")
_function(
    "fn_decmul",
    "flights",
    "route_id",
    lambda: (F.col("route_id") * F.lit(Decimal("0.25"))).cast("decimal(12,2)"),
    "CAST(route_id * 0.25 AS DECIMAL(12,2))",
)


@query(
    "fn_decdiv",
    """
    SELECT employee_id,
           CAST(round(CAST(sum(final_price) AS DOUBLE) / nullif(count(customer_id) - 10, 0), 2) AS DECIMAL(20,2)) AS share
    FROM tickets GROUP BY employee_id""",
    "tickets",
)
def fn_decdiv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Division of decimals, NULL where the divisor is 0."""
    tickets = OrderTables(spark, sf_dir)("tickets", "employee_id", "final_price", "customer_id")
    divisor = (F.count("customer_id") - 10).cast("decimal(10,0)")
    share = F.try_divide(F.sum("final_price"), divisor)
    return tickets.groupBy("employee_id").agg(F.round(share, 2).cast(MONEY).alias("share"))


# --- subquery forms --------------------------------------------------------------------------


@query(
    "sq_scalar",
    """
    SELECT count(*) AS n, CAST(sum(final_price * (SELECT percentage FROM discounts WHERE name = 'Elderly Discount'))
                               AS DECIMAL(26,4)) AS total_discount FROM tickets""",
    "tickets discounts",
)
def sq_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = OrderTables(spark, sf_dir)
    rate = t("discounts", "name", "percentage").filter(F.col("name") == "Elderly Discount").select("percentage")
    total = F.sum(F.col("final_price") * rate.scalar()).cast(BIG).alias("total_discount")
    return t("tickets", "final_price").agg(_number_of_rows(), total)


@query(
    "sq_corr",
    """
    SELECT flight_id, (SELECT capacity FROM planes p WHERE p.plane_id = f.plane_id AND p.capacity > 10) AS capacity
    FROM flights f""",
    "flights planes",
)
def sq_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = OrderTables(spark, sf_dir)
    large = t("planes").filter(F.col("capacity") > 10)
    return lookup(t("flights", "flight_id", "plane_id"), large, "plane_id", {"capacity": "capacity"}).drop("plane_id")


@query(
    "sq_corr2",
    """
    SELECT flight_id FROM flights f
    WHERE (SELECT name FROM cities_states WHERE city_state_id =
           (SELECT city_state_id_origin FROM routes r WHERE r.route_id = f.route_id)) = 'CITY_1'""",
    "flights routes cities_states",
)
def sq_corr2(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = OrderTables(spark, sf_dir)
    named = lookup(
        t("routes", "route_id", "city_state_id_origin"),
        t("cities_states"),
        "city_state_id_origin",
        {"name": "city_state"},
        "city_state_id",
    )
    wanted = named.filter(F.col("city_state") == "CITY_1").select("route_id")
    return join_dim(t("flights", "flight_id", "route_id"), wanted, "route_id", "left_semi").select("flight_id")


@query(
    "sq_corragg",
    """
    SELECT plane_id, count(*) AS flights,
           CASE WHEN count(*) > (SELECT capacity FROM planes p WHERE p.plane_id = f.plane_id) THEN 'YES' ELSE 'NO' END AS busy
    FROM flights f GROUP BY plane_id""",
    "flights planes",
)
def sq_corragg(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = OrderTables(spark, sf_dir)
    used = t("flights", "plane_id").groupBy("plane_id").agg(F.count("*").alias("flights"))
    busy = F.when(F.col("flights") > F.col("capacity"), "YES").otherwise("NO")
    return used.join(t("planes"), "plane_id", "left").select("plane_id", "flights", busy.alias("busy"))


@query(
    "sq_corrcount",
    """
    SELECT flight_id, (SELECT count(*) FROM tickets t WHERE t.flight_id = f.flight_id
                       AND year(boarding_date) IN (1996, 1997)) AS flights FROM flights f""",
    "flights tickets",
)
def sq_corrcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = OrderTables(spark, sf_dir)
    boarded = t("tickets", "flight_id", "boarding_date").filter(in_year("boarding_date", 1996, 1997))
    return counts_per_outer(t("flights", "flight_id"), boarded, "flight_id", "flights")


@query(
    "sq_in",
    """
    SELECT CAST(year(purchase_date) AS INTEGER) AS bought_in, count(*) AS n FROM tickets t
    WHERE customer_id IN (SELECT c.customer_id FROM customers c
                          WHERE date_diff('year', c.birth_date, t.purchase_date) >= 60)
    GROUP BY 1""",
    "tickets customers",
)
def sq_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = OrderTables(spark, sf_dir)
    bought = (
        t("tickets", "customer_id", "purchase_date")
        .groupBy("customer_id", F.year("purchase_date").alias("bought_in"))
        .agg(_number_of_rows())
    )
    people = t("customers", "customer_id", "birth_date").select("customer_id", F.year("birth_date").alias("born_in"))
    aged = semi_theta(bought, people, "customer_id", F.col("bought_in") - F.col("born_in") >= 60)
    return aged.groupBy("bought_in").agg(F.sum("n").alias("n"))


@query(
    "sq_exists",
    """
    SELECT w.weekday_id, EXISTS (SELECT 1 FROM flights JOIN routes r USING (route_id)
                                 WHERE r.weekday_id = w.weekday_id AND year(date) = 2001 AND month(date) > 7) AS used
    FROM weekdays w""",
    "weekdays flights routes",
)
def sq_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXISTS per weekday: the late flights shrink to their distinct routes first."""
    t = OrderTables(spark, sf_dir)
    late = t("flights", "route_id", "date").filter(in_year("date", 2001) & (F.month("date") > 7))
    days = late.select("route_id").distinct().join(t("routes", "route_id", "weekday_id"), "route_id")
    used = days.select("weekday_id").distinct().withColumn("used", F.lit(True))
    return t("weekdays", "weekday_id").join(used, "weekday_id", "left").select(
        "weekday_id", F.coalesce("used", F.lit(False)).alias("used")
    )


@query(
    "sq_derived",
    """
    , a AS (SELECT flight_id, count(*) AS n FROM tickets GROUP BY flight_id),
    b AS (SELECT n AS size, count(*) AS flights FROM a GROUP BY n)
    SELECT size, flights, row_number() OVER (ORDER BY flights DESC, size) AS position FROM b""",
    "tickets",
)
def sq_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_flight = OrderTables(spark, sf_dir)("tickets", "flight_id").groupBy("flight_id").agg(F.count("*").alias("size"))
    sizes = per_flight.groupBy("size").agg(F.count("*").alias("flights"))
    return rank_all(sizes, [F.desc("flights"), F.asc("size")])
