import datetime

import pytest
from frames import rows
from pyspark.sql import functions as F

from tally.operators import audit_changes, check_reference_ids, check_references, check_unique, check_unique_ids
from tally.operators import asof, count_ids, differing, id_bitmaps, join_asof, merge_bitmaps, semi_intervals
from tally.workspace import store

AT = datetime.datetime(2021, 5, 6, 7, 8, 9)
D = datetime.date


def audited(before, after, key, cols, digests):
    return rows(audit_changes(before, after, key, cols, "t", "u", "s", AT, digests=digests))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Two images in key order, 1% of whose rows differ."""
    folder = str(tmp_path_factory.mktemp("images"))
    old = spark.range(0, 30_000, 1, 8).select("id", F.concat(F.lit("name "), "id").alias("name"), (F.col("id") % 5).cast("double").alias("size"))
    moved = F.col("id").between(9000, 9249) | (F.col("id") % 600 == 0)
    new = old.filter("id <> 77").withColumn("size", F.when(moved, F.lit(None)).otherwise(F.col("size")))
    new = new.unionByName(spark.createDataFrame([(40_000, None, 1.0), (-3, "low", None)], "id long, name string, size double"))
    old.write.parquet(f"{folder}/old")
    new.write.parquet(f"{folder}/new")
    return spark.read.parquet(f"{folder}/old"), spark.read.parquet(f"{folder}/new")


def test_digests_give_the_same_audit(stored):
    for cols in (["name", "size"], ["size"], ["id", "name", "size"]):
        assert audited(*stored, "id", cols, True) == audited(*stored, "id", cols, False)


def test_only_rows_that_differ_are_left(stored):
    before, after = differing(*stored, "id")
    changed = 250 + 50  # 9000 is a multiple of 600
    assert before.count() == changed + 1 - 1 and after.count() == changed + 2 - 1


def test_few_ranges_and_unbroadcast_keys(stored):
    for settings in ({"most_ranges": 1}, {"rows_per_range": 1}, {"limit": 0}, {"most_ranges": 7, "limit": 0}):
        assert [rows(x) for x in differing(*stored, "id", **settings)] == [rows(x) for x in differing(*stored, "id")]


def test_missing_keys_swapped_values_and_other_types(spark):
    schema = "a string, b int, x string, y string, z double"
    old = [("k", 1, None, "v", 0.0), ("k", 2, "v", None, float("nan")), (None, 1, "n", "n", 1.0), ("m", None, "n", "n", 1.0), ("same", 1, "s", "s", 1.0)]
    new = [("k", 1, "v", None, -0.0), ("k", 2, "v", None, float("nan")), (None, 1, "n", "n", 1.0), ("same", 1, "s", "s", 1.0), ("new", 9, None, None, None)]
    before, after = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    assert audited(before, after, ["a", "b"], ["x", "y", "z"], True) == audited(before, after, ["a", "b"], ["x", "y", "z"], False)


def test_empty_images_and_hot_values(spark, stored):
    old, _ = stored
    none = old.limit(0)
    assert audited(none, none, "id", ["size"], True) == []
    few = old.filter("id < 50")
    for pair in ((none, few), (few, none), (few, few)):
        assert audited(*pair, "id", ["size", "name"], True) == audited(*pair, "id", ["size", "name"], False)
    ends = spark.createDataFrame([(-(2**63), 1), (2**63 - 1, 2), (0, 3)], "id long, v int")
    moved = ends.withColumn("v", F.col("v") + (F.col("id") == 0).cast("int"))
    assert audited(ends, moved, "id", ["v"], True) == audited(ends, moved, "id", ["v"], False)
    # a third of the rows without a key
    gaps = old.limit(900).withColumn("id", F.when(F.col("id") % 3 != 0, F.col("id")))
    with pytest.raises(Exception, match="more than one row"):
        audited(gaps, gaps, "id", ["size"], True)


def test_a_second_row_of_a_changed_key_is_an_error(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    two = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "id int, v string")
    with pytest.raises(Exception, match="more than one row"):
        audited(one, two, "id", ["v"], True)


# --- as-of joins -----------------------------------------------------------------------------

PRICES = "route int, cabin string, price int, start_date date, end_date date"


def plain_asof(facts, versions):
    out = []
    for route, cabin, at, n in facts:
        known = [v for v in versions if None not in (route, cabin, at, v[3]) and v[:2] == (route, cabin) and v[3] <= at]
        last = max(known, key=lambda v: v[3], default=None)
        out.append((route, cabin, at, n, last[2] if last and (last[4] is None or last[4] >= at) else None))
    return out


@pytest.fixture(scope="module")
def dated(spark):
    days = [D(2020, 1, 1) + datetime.timedelta(i) for i in range(60)]
    facts = [(1 if i % 3 else i % 9, "A" if i % 2 else "B", days[i * 7 % 60], i) for i in range(700)]  # most rows on one key
    facts += [(None, "A", days[3], 1), (1, None, days[3], 1), (1, "A", None, 1), (5, "Z", days[3], 1)] + [(1, "A", days[30], 5)] * 300
    versions = [(r, c, r * 100 + k, days[k * 9 + r % 3], days[k * 9 + 5] if k == 2 else None) for r in range(9) for c in "AB" for k in range(5)]
    versions += [(None, "A", 1, days[0], None), (1, "A", 2, None, None), (7, "C", 3, days[0], None)]
    schema = "route int, cabin string, day date, n int"
    return facts, versions, spark.createDataFrame(facts, schema), spark.createDataFrame(versions, PRICES)


def as_of(fact, versions, **settings):
    return join_asof(fact, versions, ["route", "cabin"], "day", "start_date", {"price": "due"}, "end_date", **settings)


@pytest.mark.parametrize("settings", [{}, {"limit": 0}, {"most_listed": 1}])
def test_rows_meet_the_version_of_their_day(spark, dated, settings):
    facts, versions, fact, listed = dated
    assert rows(as_of(fact, listed, **settings)) == sorted(plain_asof(facts, versions), key=lambda r: [(v is not None, str(v)) for v in r])


def test_a_hot_key_is_cut(spark, dated, monkeypatch):
    _, _, fact, listed = dated
    many = fact.crossJoin(spark.range(30)).withColumn("n", F.col("id").cast("int")).drop("id")  # a third on one key and day
    kept = []
    monkeypatch.setattr(asof, "store", lambda df: kept.append(store(df)) or kept[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = as_of(many, listed, limit=0)
        assert placed.count() == many.count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in kept[0].groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < many.count() / 4  # windows stand over these ranges, not over keys
    assert rows(placed.groupBy("due").count()) == rows(as_of(many, listed).groupBy("due").count())


def test_two_versions_with_one_start(spark, dated):
    _, versions, fact, _ = dated
    twice = spark.createDataFrame([*versions, (1, "A", 9, versions[10][3], None), (8, "Q", 1, D(2020, 1, 1), None), (8, "Q", 2, D(2020, 1, 1), None)], PRICES)
    for settings in ({}, {"limit": 0}):
        with pytest.raises(Exception, match="more than one row"):
            as_of(fact, twice, **settings).collect()
        assert as_of(fact.filter("route > 1"), twice, **settings).count() == fact.filter("route > 1").count()


def test_no_rows_or_no_versions(spark, dated):
    _, _, fact, listed = dated
    for settings in ({}, {"limit": 0}):
        assert as_of(fact.limit(0), listed, **settings).count() == 0
        got = as_of(fact, listed.limit(0), **settings)
        assert got.columns == [*fact.columns, "due"] and got.filter("due is not null").count() == 0 and got.count() == fact.count()


# --- ranges ----------------------------------------------------------------------------------


def test_points_in_ranges(spark):
    points = [(i, (i * 37) % 1000, i % 4) for i in range(800)] + [(900, None, 1), (901, 5000, 1)]
    ranges = [(k, (k * 91) % 1000, (k * 91) % 1000 + (k % 5) * 2, k % 4) for k in range(60)] + [(70, 100, 90, 1), (71, None, 3, 2), (72, 998, None, 0)]
    left = spark.createDataFrame(points, "i int, p int, g int")
    right = spark.createDataFrame(ranges, "k int, lo int, hi int, h int")
    inside = lambda p, r: p is not None and (r[1] is None or r[1] <= p) and (r[2] is None or p <= r[2])
    for limit in (None, 0):
        got = rows(semi_intervals(left, right, "p", "lo", "hi", limit=limit))
        assert got == rows(spark.createDataFrame([x for x in points if any(inside(x[1], r) for r in ranges)], left.schema))
        got = rows(semi_intervals(left, right.withColumnRenamed("h", "g"), "p", "lo", "hi", on=["g"], residual=F.col("k") != F.col("i"), limit=limit))
        assert got == rows(
            spark.createDataFrame([x for x in points if any(inside(x[1], r) and r[3] == x[2] and r[0] != x[0] for r in ranges)], left.schema)
        )


def test_many_ranges_of_one_key_without_nested_loops(spark):
    left = spark.range(20_000).select("id", F.lit(7).alias("g"), ((F.col("id") * 7919) % 1_000_003).cast("double").alias("p"))
    right = spark.range(100_000).select(F.lit(7).alias("g"), (F.col("id") * 10.0).alias("lo"), (F.col("id") * 10.0 + 3).alias("hi"))
    want = left.filter("p % 10 <= 3 and p <= 999993").count()
    for limit in (None, 0):
        got = semi_intervals(left, right, "p", "lo", "hi", on=["g"], limit=limit)
        assert got.count() == want
        assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_ranges_over_all_points_and_dates(spark):
    day = F.date_add(F.lit(D(2020, 1, 1)), F.col("id").cast("int"))
    left = spark.range(400).select("id", day.alias("at"), F.to_timestamp(day).alias("moment"))
    right = spark.createDataFrame([(D(1900, 1, 1), D(2020, 2, 1)), (D(2020, 3, 1), D(2020, 3, 1)), (D(2020, 12, 30), D(2090, 1, 1))], "lo date, hi date")
    want = left.filter("at <= '2020-02-01' or at = '2020-03-01' or at >= '2020-12-30'").count()
    for limit in (None, 0):
        assert semi_intervals(left, right, "at", "lo", "hi", limit=limit).count() == want
        stamps = right.select(*[F.to_timestamp(c).alias(c) for c in right.columns])
        assert semi_intervals(left, stamps, "moment", "lo", "hi", limit=limit).count() == want
    assert semi_intervals(left.limit(0), right, "at", "lo", "hi").count() == 0
    assert semi_intervals(left, right.limit(0), "at", "lo", "hi").count() == 0
    same = left.withColumn("at", F.lit(D(2020, 1, 1)))
    assert semi_intervals(same, right, "at", "lo", "hi").count() == 400
    with pytest.raises(TypeError):
        semi_intervals(left.withColumn("s", F.lit("x")), right, "s", "lo", "hi")


# --- bitmaps ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def ids(spark):
    odd = [(v,) for v in (None, None, 0, 1, 1, -1, -40_000, -40_000, 32_768, 32_769, 2**31 - 1, -(2**31), 7)]
    many = spark.range(50_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") * 3).cast("int").alias("id"))  # a hot id
    return spark.createDataFrame(odd, "id int").unionByName(many)


@pytest.mark.parametrize("kind", ["int", "bigint", "string", "smallint"])
@pytest.mark.parametrize("limit", [None, 0])
def test_bitmaps_find_the_same_violations(spark, ids, kind, limit):
    child = ids.filter("id is null or id between -30000 and 30000") if kind == "smallint" else ids
    child = child.select(F.col("id").cast(kind).alias("id"))
    parent = child.filter("id is null or id % 7 <> 3").distinct()
    assert rows(check_unique_ids(child, "id", limit=limit)) == rows(check_unique(child, ["id"]))
    wide = parent.select(F.col("id").cast("bigint" if kind == "int" else kind).alias("pk"))
    assert rows(check_reference_ids(child, "id", wide, "pk", limit=limit)) == rows(check_references(child, "id", wide, "pk"))
    for c, p in ((child, wide.limit(0)), (child.limit(0), wide)):
        assert rows(check_reference_ids(c, "id", p, "pk")) == rows(check_references(c, "id", p, "pk"))
    assert check_unique_ids(child.limit(0), "id").count() == 0


def test_distinct_counts_of_merged_days(spark, ids):
    days = [ids.filter(F.col("id") % 3 == d) for d in range(3)]
    merged = merge_bitmaps(*[id_bitmaps(day, "id") for day in days], id_bitmaps(ids.filter("id < 900"), "id"))
    assert count_ids(merged).first().ids == ids.select("id").dropna().distinct().count()
    assert count_ids(id_bitmaps(ids.limit(0), "id")).first().ids == 0
    assert id_bitmaps(ids, "id").count() <= 12
    with pytest.raises(TypeError):
        id_bitmaps(spark.createDataFrame([("a",)], "id string"), "id")
