"""Queries with row-preserving joins on data where one key holds a third of the rows, unbroadcast."""

import duckdb
import pytest
from test_catalog import ORACLES, QUERIES, normal

from tally.operators import joins

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
KEYS = [
    "jn_composite",
    "jn_inner",
    "jn_lookup",
    "jn_lookup2",
    "jn_role",
    "sq_corr2",
    "q_fk_rows",
    "q_tolerance",
    "ch_summary",
    "r01",
    "r04a",
    "r06",
    "r07",
    "r13",
    "r14",
    "r19",
    "r20",
    "v06",
    "v07",
    "v08",
    "v09",
]
SKEW = {
    "customer": "* REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 3 ELSE c_nationkey END AS c_nationkey)",
    "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)",
    "lineitem": "* REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey, "
    "CASE WHEN l_linenumber % 3 = 0 THEN 3 ELSE l_suppkey END AS l_suppkey)",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory, small_dir):
    folder = tmp_path_factory.mktemp("skew")
    con = duckdb.connect()
    for name in TABLES:
        chosen = SKEW.get(name, "*")
        con.execute(f"COPY (SELECT {chosen} FROM '{small_dir}/{name}.parquet') TO '{folder}/{name}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return str(folder), con


@pytest.mark.parametrize("key", KEYS)
def test_same_rows_without_broadcasts(spark, skewed, monkeypatch, key):
    folder, con = skewed
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = QUERIES[key](spark, folder)
        found = normal([tuple(r) for r in got.collect()], got.columns)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = con.sql(ORACLES[key])
    assert found == normal(want.fetchall(), want.columns)


def test_the_hot_order_is_split(spark, skewed):
    lines = spark.read.parquet(f"{skewed[0]}/lineitem.parquet")
    [(_, pieces)] = joins.hot_keys(lines, "l_orderkey")
    assert pieces >= 3
    orders = spark.read.parquet(f"{skewed[0]}/orders.parquet").withColumnRenamed("o_orderkey", "l_orderkey")
    joined = joins.spread_join(lines, orders, "l_orderkey", spread_by=["l_partkey", "l_linenumber"])
    assert joined.count() == lines.join(orders, "l_orderkey").count()
