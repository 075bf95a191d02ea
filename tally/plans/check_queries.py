"""Data checks, change auditing and their micro-batch forms on the test tables."""

from __future__ import annotations

import datetime
import re
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tally.operators.changes import apply_updates, audit_changes, audit_pairs, classify, pair_images
from tally.operators.joins import join_dim
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
)
from tally.plans.bindings import SQL, OrderTables, part
from tally.plans.integrity import declared_checks
from tally.plans.registry import query
from tally.schemas import MAX_LENGTHS, PRIMARY_KEYS, REFERENCES, REQUIRED
from tally.streaming import audit_stream, validate_stream, violations_stream
from tally.workspace import fresh_path

LOW, HIGH = datetime.date(1996, 1, 1), datetime.date(1999, 12, 31)
PCT = Decimal("0.20")
AT = datetime.datetime(2001, 12, 31, 8, 30, 0)
ITEM_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_size", "price"]

_OUTSIDE = f"date < DATE '{LOW}' OR date > DATE '{HIGH}'"


# --- date range ------------------------------------------------------------------------------


def _date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_date_range(OrderTables(spark, sf_dir)("flights", "flight_id", "date"), "date", LOW, HIGH)


for _key in ("q_daterange", "tr01"):
    query(_key, f"SELECT flight_id, date FROM flights WHERE {_OUTSIDE}", "flights")(_date_range)


# --- price tolerance -------------------------------------------------------------------------

_PRICED = """
    , proposed AS (
        SELECT ticket_id, flight_id, cabin_type_id, route_id,
               CASE WHEN ticket_id % 50 <> 0 THEN final_price END AS final_price
        FROM tickets JOIN flights USING (flight_id)),
    listed AS (SELECT * FROM routes_cabin_types WHERE cabin_type_id <> 'R'),
    judged AS (
        SELECT p.*, l.price, CASE WHEN l.price IS NULL THEN 'unpriced' WHEN final_price IS NULL THEN 'empty'
                   WHEN final_price BETWEEN l.price * 0.80 AND l.price * 1.20 THEN 'accepted'
                   ELSE 'clamped' END AS verdict
        FROM proposed p LEFT JOIN listed l USING (route_id, cabin_type_id))"""


def _proposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticket prices as proposed changes, each with its flight's route; some lack a price."""
    t = OrderTables(spark, sf_dir)
    tickets = t("tickets", "ticket_id", "flight_id", "cabin_type_id", "final_price").withColumn(
        "final_price", F.when(F.col("ticket_id") % 50 != 0, F.col("final_price"))
    )
    flights = t("flights", "flight_id", "route_id")
    return join_dim(tickets, flights, "flight_id", spread_by=["ticket_id"], hot_from=t.hot_flights)


def _price_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No list price for the third class."""
    return OrderTables(spark, sf_dir)("routes_cabin_types").filter(F.col("cabin_type_id") != "R")


PRICE_KEYS = ["route_id", "cabin_type_id"]
TICKET = ["ticket_id", "flight_id"]


def _clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = clamp_to_reference(
        _proposed(spark, sf_dir), _price_list(spark, sf_dir), PRICE_KEYS, "final_price", "price", PCT, spread_by=TICKET
    )
    return kept.select(*TICKET, "cabin_type_id", "verdict", "validated")


_CLAMPED_SQL = (
    _PRICED
    + """
    SELECT ticket_id, flight_id, cabin_type_id, verdict,
           CASE WHEN verdict = 'accepted' THEN final_price ELSE price END AS validated
    FROM judged WHERE verdict <> 'unpriced'"""
)
for _key in ("q_tolerance", "tr03"):
    query(_key, _CLAMPED_SQL, "tickets flights routes_cabin_types")(_clamped)


@query("q_tolerance_spread", _CLAMPED_SQL, "tickets flights routes_cabin_types")
def q_tolerance_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without broadcasts: what runs when the price list is not small."""
    kept = clamp_to_reference(
        _proposed(spark, sf_dir), _price_list(spark, sf_dir), PRICE_KEYS, "final_price", "price", PCT, spread_by=TICKET, limit=0
    )
    return kept.select(*TICKET, "cabin_type_id", "verdict", "validated")


@query(
    "q_tolerance_reject",
    _PRICED + " SELECT ticket_id, flight_id, final_price AS validated FROM judged WHERE verdict = 'accepted'",
    "tickets flights routes_cabin_types",
)
def q_tolerance_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clamp_to_reference(
        _proposed(spark, sf_dir), _price_list(spark, sf_dir), PRICE_KEYS, "final_price", "price", PCT, "reject", TICKET
    ).select(*TICKET, "validated")


@query(
    "ch_summary",
    _PRICED + " SELECT count(*) FILTER (verdict = 'clamped') AS errors, count(*) AS total_rows FROM judged",
    "tickets flights routes_cabin_types",
)
def ch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_against_reference(
        _proposed(spark, sf_dir), _price_list(spark, sf_dir), PRICE_KEYS, "final_price", "price", PCT, TICKET
    )
    return tolerance_summary(judged)


# --- length bounds ---------------------------------------------------------------------------

_RENAMED = """
    , renamed AS (
        SELECT customer_id + 10 AS customer_id,
               CASE customer_id % 4 WHEN 0 THEN 'X' WHEN 1 THEN first_name || '  ' WHEN 2 THEN first_name || first_name END
                   AS first_name FROM customers),
    bounds AS (SELECT min(length(rtrim(first_name))) AS lo, max(length(rtrim(first_name))) AS hi FROM customers)"""


def _renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = OrderTables(spark, sf_dir)("customers", "customer_id", "first_name")
    kind, name = F.col("customer_id") % 4, F.col("first_name")
    new = F.when(kind == 0, "X").when(kind == 1, F.concat(name, F.lit("  "))).when(kind == 2, F.concat(name, name))
    return people.select((F.col("customer_id") + 10).alias("customer_id"), new.alias("first_name"))


def _length_check(part_name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        current = OrderTables(spark, sf_dir)("customers", "first_name")
        return getattr(check_length_bounds(current, _renamed(spark, sf_dir), "first_name"), part_name)

    return run


_INSIDE = "length(rtrim(first_name)) BETWEEN lo AND hi"
query("q_lenbounds", _RENAMED + f" SELECT renamed.* FROM renamed, bounds WHERE {_INSIDE}", "customers")(
    _length_check("accepted")
)
query("tr04", _RENAMED + f" SELECT renamed.* FROM renamed, bounds WHERE NOT ({_INSIDE})", "customers")(
    _length_check("rejected")
)
query(
    "q_lenbounds_summary",
    _RENAMED + f" SELECT count(*) FILTER (NOT ({_INSIDE})) AS errors, count(*) AS total_rows FROM renamed, bounds",
    "customers",
)(_length_check("summary"))


# --- keys, references, required columns, lengths, rules --------------------------------------


@query(
    "q_pk",
    'SELECT l_orderkey, l_linenumber, count(*) AS "rows" FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1',
)
def q_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique(part(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_ORPHANS = """
    , child AS (SELECT flight_id, ticket_id, CASE WHEN ticket_id % 20 <> 0 THEN employee_id END AS employee_id FROM tickets),
    parent AS (SELECT employee_id FROM employees WHERE city_state_id < 20)"""


def _child_and_parent(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    t = OrderTables(spark, sf_dir)
    child = t("tickets", "flight_id", "ticket_id", "employee_id").withColumn(
        "employee_id", F.when(F.col("ticket_id") % 20 != 0, F.col("employee_id"))
    )
    staff = t("employees", "employee_id", "city_state_id").filter(F.col("city_state_id") < 20)
    return child, staff.select("employee_id")


@query(
    "q_fk",
    _ORPHANS
    + """
    SELECT employee_id, count(*) AS orphan_rows FROM child
    WHERE employee_id IS NOT NULL AND employee_id NOT IN (SELECT employee_id FROM parent) GROUP BY 1""",
    "tickets employees",
)
def q_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    child, parent = _child_and_parent(spark, sf_dir)
    return check_references(child, "employee_id", parent, "employee_id")


@query(
    "q_fk_rows",
    _ORPHANS
    + """
    SELECT * FROM child
    WHERE employee_id IS NOT NULL AND employee_id NOT IN (SELECT employee_id FROM parent)""",
    "tickets employees",
)
def q_fk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    child, parent = _child_and_parent(spark, sf_dir)
    return orphans(child, "employee_id", parent, "employee_id")


@query(
    "q_notnull",
    """
    SELECT 'customer_id' AS "column", count(*) FILTER (customer_id IS NULL) AS violations FROM customers
    UNION ALL SELECT 'last_name', count(*) FILTER (last_name IS NULL) FROM customers
    UNION ALL SELECT 'gender', count(*) FILTER (gender IS NULL) FROM customers""",
    "customers",
)
def q_notnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = OrderTables(spark, sf_dir)("customers", "customer_id", "last_name", "gender")
    return check_not_null(people, ["customer_id", "last_name", "gender"])


@query(
    "q_length",
    """
    SELECT 'first_name' AS "column", count(*) FILTER (length(first_name) > 8) AS violations FROM customers
    UNION ALL SELECT 'last_name', count(*) FILTER (length(last_name) > 50) FROM customers""",
    "customers",
)
def q_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = OrderTables(spark, sf_dir)("customers", "first_name", "last_name")
    return check_max_length(people, {"first_name": 8, "last_name": 50})


@query(
    "q_rules",
    """
    SELECT 'price is positive' AS rule, count(*) FILTER (final_price <= 0) AS violations FROM tickets
    UNION ALL SELECT 'price is below 100000', count(*) FILTER (NOT final_price < 100000) FROM tickets
    UNION ALL SELECT 'a known cabin', count(*) FILTER (NOT cabin_type_id IN ('A', 'N')) FROM tickets
    UNION ALL SELECT 'buyers of some age', count(*) FILTER (NOT customer_id > 10) FROM tickets""",
    "tickets",
)
def q_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickets = OrderTables(spark, sf_dir)("tickets", "final_price", "cabin_type_id", "customer_id")
    return check_rules(
        tickets,
        {
            "price is positive": "final_price > 0",
            "price is below 100000": "final_price < 100000",
            "a known cabin": "cabin_type_id IN ('A', 'N')",
            "buyers of some age": "customer_id > 10",
        },
    )


@query(
    "q_rules_defaults",
    """
    SELECT customer_id, coalesce(gender, '?') AS gender, coalesce(last_name, 'Customer ' || CAST(customer_id AS VARCHAR))
               AS last_name FROM customers""",
    "customers",
)
def q_rules_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = OrderTables(spark, sf_dir)("customers", "customer_id", "gender", "last_name")
    named = F.concat(F.lit("Customer "), F.col("customer_id").cast("string"))
    return fill_defaults(people, {"gender": "?", "last_name": named})


DECLARED = (
    "tickets flights customers employees routes planes routes_cabin_types cabin_types cities_states states zipcodes "
    "weekdays locations payment_types"
).split()


def _declared_sql() -> str:
    """The same report, a statement a constraint, over the columns that the derived tables have."""
    has = {name: set(re.findall(r"\w+", SQL[name])) for name in DECLARED}
    parts = []

    def add(kind: str, name: str, column: str, count: str) -> None:
        parts.append(f"SELECT '{kind}' AS kind, '{name}' AS \"table\", '{column}' AS \"column\", CAST(({count}) AS BIGINT) AS violations")

    for name in DECLARED:
        key = ", ".join(PRIMARY_KEYS[name])
        missing = " OR ".join(f"{c} IS NULL" for c in PRIMARY_KEYS[name])
        grouped = f"SELECT {key}, count(*) AS n FROM {name} GROUP BY {key} HAVING count(*) > 1 OR {missing}"
        if set(PRIMARY_KEYS[name]) <= has[name]:
            add("primary key", name, key, f"SELECT coalesce(sum(n), 0) FROM ({grouped})")
        for c in REQUIRED[name]:
            if c in has[name]:
                add("required", name, c, f"SELECT count(*) FROM {name} WHERE {c} IS NULL")
        for c, n in MAX_LENGTHS[name].items():
            if c in has[name]:
                add("length", name, c, f"SELECT count(*) FROM {name} WHERE length({c}) > {n}")
        for child, c, parent, parent_key in REFERENCES:
            if child == name and parent in DECLARED and c in has[name]:
                known = f"SELECT {parent_key} FROM {parent}"
                add("reference", name, f"{c} -> {parent}", f"SELECT count(*) FROM {name} WHERE {c} IS NOT NULL AND {c} NOT IN ({known})")
    return " UNION ALL ".join(parts)


@query("q_declared", _declared_sql(), " ".join(DECLARED))
def q_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys, references, required columns and text limits of the derived tables in one report."""
    return declared_checks(OrderTables(spark, sf_dir), DECLARED)


# --- change auditing -------------------------------------------------------------------------

_IMAGES = """
    WITH items AS (
        SELECT p_partkey, CASE WHEN p_partkey % 13 <> 0 THEN p_name END AS p_name, p_brand, p_size,
               CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part),
    before AS (SELECT * FROM items WHERE p_brand <> 'Brand#1'),
    after AS (
        SELECT p_partkey, CASE WHEN p_partkey % 26 = 0 THEN 'named' WHEN p_partkey % 8 = 3 THEN NULL ELSE p_name END AS p_name,
               p_brand, CAST(CASE WHEN p_partkey % 4 = 0 THEN p_size + 1 ELSE p_size END AS INTEGER) AS p_size,
               CAST(CASE WHEN p_partkey % 6 = 0 THEN price + 1 ELSE price END AS DECIMAL(10,2)) AS price
        FROM items WHERE p_brand <> 'Brand#2')"""


def _items(stored: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    return stored.select(
        "p_partkey",
        F.when(key % 13 != 0, F.col("p_name")).alias("p_name"),
        "p_brand",
        "p_size",
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
    )


def _edited(items: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    name = F.when(key % 26 == 0, "named").when(key % 8 != 3, F.col("p_name"))
    size = F.when(key % 4 == 0, F.col("p_size") + 1).otherwise(F.col("p_size"))
    price = F.when(key % 6 == 0, F.col("price") + 1).otherwise(F.col("price"))
    return items.withColumns({"p_name": name, "p_size": size.cast("int"), "price": price.cast("decimal(10,2)")})


def _images(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    items = _items(part(spark, sf_dir, "part"))
    return items.filter(F.col("p_brand") != "Brand#1"), _edited(items).filter(F.col("p_brand") != "Brand#2")


def _column_rows(image: str) -> str:
    rows = [
        f"SELECT p_partkey, '{name}' AS aud_column, CAST({name} AS VARCHAR) AS v FROM {image}" for name in ITEM_COLUMNS
    ]
    return " UNION ALL ".join(rows)


def _audit_sql(batch: str) -> str:
    return f"""{_IMAGES},
    b AS ({_column_rows("before")}),
    a AS ({_column_rows("after")}),
    paired AS (
        SELECT coalesce(b.p_partkey, a.p_partkey) AS id, coalesce(b.aud_column, a.aud_column) AS aud_column,
               b.p_partkey IS NULL AS added, a.p_partkey IS NULL AS removed, b.v AS aud_before, a.v AS aud_after
        FROM b FULL JOIN a ON a.p_partkey = b.p_partkey AND a.aud_column = b.aud_column)
    SELECT '{batch}:items:' || CAST(id AS VARCHAR) || ':' || aud_column AS aud_id, 'desk-1' AS aud_station,
           CASE WHEN added THEN 'INSERT' WHEN removed THEN 'DELETE' ELSE 'UPDATE' END AS aud_operation,
           DATE '{AT.date()}' AS aud_date, '{AT.strftime("%H:%M:%S")}' AS aud_time, 'clerk' AS aud_username,
           'items' AS aud_table, CAST(id AS VARCHAR) AS aud_identifier_id, aud_column, aud_before, aud_after
    FROM paired WHERE added OR removed OR aud_before IS DISTINCT FROM aud_after"""


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _images(spark, sf_dir)
    return audit_changes(before, after, "p_partkey", ITEM_COLUMNS, "items", "clerk", "desk-1", AT)


for _key in ("ch_audit", "tr05"):
    query(_key, _audit_sql("0"))(_audit)


@query(
    "ch_classify",
    _IMAGES
    + """
    SELECT coalesce(b.p_partkey, a.p_partkey) AS p_partkey,
           CASE WHEN b.p_partkey IS NULL THEN 'INSERT' WHEN a.p_partkey IS NULL THEN 'DELETE'
                WHEN (b.p_name, b.p_size, b.price) IS DISTINCT FROM (a.p_name, a.p_size, a.price) THEN 'UPDATE' END AS operation
    FROM before b FULL JOIN after a ON a.p_partkey = b.p_partkey""",
)
def ch_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _images(spark, sf_dir)
    return classify(pair_images(before, after, "p_partkey")).select("p_partkey", "operation")


_NUMBERED = """
    , asked AS (
        SELECT t.*, route_id,
               row_number() OVER (PARTITION BY flight_id, ticket_id ORDER BY final_price, cabin_type_id) AS n
        FROM tickets t JOIN flights USING (flight_id)),
    listed AS (SELECT * FROM routes_cabin_types WHERE cabin_type_id <> 'R'),
    stored AS (
        SELECT ticket_id, flight_id, n, CASE
            WHEN l.price IS NULL THEN final_price
            WHEN ticket_id % 50 <> 0 AND final_price BETWEEN l.price * 0.80 AND l.price * 1.20 THEN final_price
            ELSE l.price END AS final_price
        FROM asked LEFT JOIN listed l USING (route_id, cabin_type_id))"""


def _stored_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ticket after its validated price was written back; unpriced tickets keep theirs."""
    t = OrderTables(spark, sf_dir)
    flights = t("flights", "flight_id", "route_id")
    bought = t("tickets", "ticket_id", "flight_id", "cabin_type_id", "final_price")
    alike = Window.partitionBy("flight_id", "ticket_id").orderBy("final_price", "cabin_type_id")
    bought = bought.withColumn("n", F.row_number().over(alike).cast("long"))  # with it, rows have a key
    target = join_dim(bought, flights, "flight_id", spread_by=["ticket_id"], hot_from=t.hot_flights)
    asked = target.withColumn("final_price", F.when(F.col("ticket_id") % 50 != 0, F.col("final_price")))
    kept = clamp_to_reference(asked, _price_list(spark, sf_dir), PRICE_KEYS, "final_price", "price", PCT, spread_by=TICKET)
    changes = kept.select(*TICKET, "n", F.col("validated").alias("final_price"))
    return apply_updates(target, changes, [*TICKET, "n"], ["final_price"]).select(*TICKET, "n", "final_price")


query(
    "tr03_apply",
    _NUMBERED + " SELECT * FROM stored",
    "tickets flights routes_cabin_types",
)(_stored_prices)


@query(
    "tr04_apply",
    _RENAMED
    + f"""
    SELECT customer_id, CASE WHEN {_INSIDE.replace("first_name", "renamed.first_name")} THEN renamed.first_name
                             ELSE c.first_name END AS first_name
    FROM customers c LEFT JOIN renamed USING (customer_id), bounds""",
    "customers",
)
def tr04_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First names whose length is allowed are written back to their customer."""
    people = OrderTables(spark, sf_dir)("customers", "customer_id", "first_name")
    allowed = check_length_bounds(people, _renamed(spark, sf_dir), "first_name").accepted
    return apply_updates(people, allowed, "customer_id", ["first_name"])


@query(
    "ch_apply",
    _NUMBERED + " SELECT flight_id, CAST(sum(final_price) AS DECIMAL(20,2)) AS paid FROM stored GROUP BY flight_id",
    "tickets flights routes_cabin_types",
)
def ch_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Takings per flight after the validated prices are written back; unpriced tickets keep theirs.

    What a ticket costs afterwards is decided on its own row, so one pass and one grouping do.
    """
    asked = F.when(F.col("ticket_id") % 50 != 0, F.col("final_price"))
    t = OrderTables(spark, sf_dir)
    bought = t("tickets", "ticket_id", "flight_id", "cabin_type_id", "final_price").withColumn("asked", asked)
    routed = join_dim(bought, t("flights", "flight_id", "route_id"), "flight_id", spread_by=["ticket_id"], hot_from=t.hot_flights)
    judged = judge_against_reference(routed, _price_list(spark, sf_dir), PRICE_KEYS, "asked", "price", PCT, TICKET)
    after = (
        F.when(F.col("verdict") == "accepted", F.col("asked"))
        .when(F.col("verdict") == "unpriced", F.col("final_price"))
        .otherwise(F.col("reference_value"))
    )
    return judged.groupBy("flight_id").agg(F.sum(after).cast("decimal(20,2)").alias("paid"))


# --- micro-batches ---------------------------------------------------------------------------


FILES_PER_BATCH = 64  # bounds a batch, and with it what a batch holds


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source = spark.readStream.schema(part(spark, sf_dir, name).schema).option("maxFilesPerTrigger", FILES_PER_BATCH)
    return source.parquet(f"{sf_dir}/{name}.parquet*")


@query("ss_audit", _audit_sql("0"))
def ss_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edited items as a stream of changes; a removed item arrives marked as such."""
    before, _ = _images(spark, sf_dir)
    items = _items(_stream(spark, sf_dir, "part"))
    changes = _edited(items).withColumn("gone", F.col("p_brand") == "Brand#2")
    folder = fresh_path(spark, "audit")
    audit_stream(
        changes,
        lambda _: before,  # an item changes once in this feed, so no batch alters what another meets
        "p_partkey",
        ITEM_COLUMNS,
        f"{folder}/rows",
        f"{folder}/checkpoint",
        "items",
        "clerk",
        "desk-1",
        at=AT,
        deleted=F.col("gone"),
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/rows").drop("batch_id")


def _step_sql(batch: int, before: str, after: str) -> str:
    return f"""
    SELECT '{batch}:items:' || CAST(b.p_partkey AS VARCHAR) || ':' || b.aud_column AS aud_id, 'desk-1' AS aud_station,
           'UPDATE' AS aud_operation, DATE '{AT.date()}' AS aud_date, '{AT.strftime("%H:%M:%S")}' AS aud_time,
           'clerk' AS aud_username, 'items' AS aud_table, CAST(b.p_partkey AS VARCHAR) AS aud_identifier_id, b.aud_column,
           b.v AS aud_before, a.v AS aud_after
    FROM ({_column_rows(before)}) b JOIN ({_column_rows(after)}) a ON a.p_partkey = b.p_partkey AND a.aud_column = b.aud_column
    WHERE a.v IS DISTINCT FROM b.v"""


@query(
    "ss_audit_batches",
    """
    WITH zero AS (
        SELECT p_partkey, CASE WHEN p_partkey % 13 <> 0 THEN p_name END AS p_name, p_brand, p_size,
               CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part),
    one AS (SELECT p_partkey, p_name, p_brand, CASE WHEN p_partkey % 3 = 0 THEN p_size + 1 ELSE p_size END AS p_size, price FROM zero),
    two AS (SELECT p_partkey, p_name, p_brand, CASE WHEN p_partkey % 2 = 0 THEN p_size + 10 ELSE p_size END AS p_size, price FROM one)"""
    + _step_sql(0, "zero", "one")
    + " UNION ALL "
    + _step_sql(1, "one", "two"),
)
def ss_audit_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two micro-batches; the second is compared with the state that the first left."""
    zero = _items(part(spark, sf_dir, "part"))
    size = F.col("p_size")
    first = zero.filter(F.col("p_partkey") % 3 == 0).withColumn("p_size", (size + 1).cast("int"))
    one = apply_updates(zero, first, "p_partkey", ["p_size"])
    second = one.filter(F.col("p_partkey") % 2 == 0).withColumn("p_size", (size + 10).cast("int"))
    folder = fresh_path(spark, "audit")
    files = 2  # of each step, and so of each batch
    for step in (first, second):
        step.repartition(files, "p_partkey").write.mode("append").parquet(f"{folder}/feed")
    feed = spark.readStream.schema(first.schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/feed")
    audit_stream(
        feed,
        lambda batch: one if batch else zero,
        "p_partkey",
        ITEM_COLUMNS,
        f"{folder}/rows",
        f"{folder}/checkpoint",
        "items",
        "clerk",
        "desk-1",
        at=AT,
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/rows").drop("batch_id")


@query("ss_audit_pairs", _audit_sql("0"))
def ss_audit_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes as a feed that carries both images: a projection, without any join."""
    items = _items(_stream(spark, sf_dir, "part"))
    image = F.struct(*ITEM_COLUMNS)
    paired = _edited(items.withColumn("was", image)).select(
        "p_partkey",
        F.when(F.col("p_brand") != "Brand#1", F.col("was")).alias("before"),
        F.when(F.col("p_brand") != "Brand#2", image).alias("after"),
    )
    log = audit_pairs(paired, "p_partkey", ITEM_COLUMNS, "items", "clerk", "desk-1", AT)
    folder = fresh_path(spark, "audit")
    (
        log.writeStream.format("parquet")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(log.schema).parquet(f"{folder}/rows")


_TICKET_STREAM_SQL = (
    _PRICED
    + """
    SELECT ticket_id, flight_id, CASE WHEN verdict = 'accepted' THEN final_price ELSE price END AS validated
    FROM judged WHERE verdict <> 'unpriced'"""
)


@query("ss_validate", _TICKET_STREAM_SQL, "tickets flights routes_cabin_types")
def ss_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticket prices clamped batch by batch against the static price list."""
    t = OrderTables(spark, sf_dir)
    tickets = _stream(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") * 100 + F.col("l_linenumber")).alias("ticket_id"),
        F.col("l_orderkey").alias("flight_id"),
        F.col("l_returnflag").alias("cabin_type_id"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price_asked"),
    )
    proposed = tickets.withColumn("final_price", F.when(F.col("ticket_id") % 50 != 0, F.col("price_asked"))).drop(
        "price_asked"
    )
    flights, listed = t("flights", "flight_id", "route_id"), _price_list(spark, sf_dir)

    def clamp(batch: DataFrame) -> DataFrame:
        routed = join_dim(batch, flights, "flight_id", spread_by=["ticket_id"])
        kept = clamp_to_reference(routed, listed, PRICE_KEYS, "final_price", "price", PCT, spread_by=TICKET)
        return kept.select(*TICKET, "validated")

    folder = fresh_path(spark, "validated")
    validate_stream(proposed, clamp, f"{folder}/rows", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/rows").drop("batch_id")


@query("ss_validate_dates", f"SELECT flight_id, date FROM flights WHERE {_OUTSIDE}", "flights")
def ss_validate_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date-range check as a streaming filter into a parquet sink."""
    flights = _stream(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("flight_id"), F.to_date("o_orderdate").alias("date")
    )
    bad = violations_stream(flights, "date", LOW, HIGH)
    folder = fresh_path(spark, "dates")
    (
        bad.writeStream.format("parquet")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(bad.schema).parquet(f"{folder}/rows")
