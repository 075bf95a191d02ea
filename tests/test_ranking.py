from decimal import Decimal

import pytest
from frames import rows
from pyspark.sql import functions as F

from tally.operators import ranking
from tally.operators.ranking import extremes, rank_all, ranked, top_n_per_group


@pytest.fixture
def scores(spark):
    """Many ties: a third of the rows share one score."""
    score = F.when(F.col("id") % 3 == 0, 50).otherwise(F.col("id") % 97)
    return spark.range(5000).select(F.col("id").alias("who"), score.alias("score"), (F.col("id") % 7).alias("team"))


def test_distributed_rank_equals_one_window(scores):
    order = [F.desc("score"), F.asc("who")]
    assert rows(rank_all(scores, order)) == rows(rank_all(scores, order, bound=5000))


def test_distributed_rank_uses_no_window_over_the_rows(scores):
    plan = rank_all(scores, [F.desc("score"), F.asc("who")])._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan


def test_rank_bound_by_a_table(spark, scores, monkeypatch):
    monkeypatch.setattr(ranking, "ONE_TASK_ROWS", 100)
    by_team = scores.groupBy("team").agg(F.count("*").alias("n"))
    got = rank_all(by_team, [F.desc("n"), F.asc("team")], bound=by_team)
    big = rank_all(by_team, [F.desc("n"), F.asc("team")], bound=scores)
    assert rows(got) == rows(big)


def test_rank_of_nothing(scores):
    assert rank_all(scores.limit(0), [F.asc("who")]).count() == 0


def test_ranked_labels(spark):
    df = spark.createDataFrame([("a", 5), ("b", 9), ("c", 9), ("d", 1)], "k string, n int")
    order = [F.desc("n"), F.asc("k")]
    got = ranked(df, order, top=2, last="LOWEST", bound=10).orderBy("orden").collect()
    assert [(r.orden, r.k, r.position) for r in got] == [
        (1, "b", "TOP 2"),
        (2, "c", "TOP 2"),
        (3, "a", None),
        (4, "d", "LOWEST"),
    ]
    assert [r.k for r in ranked(df, order, top=1, only_top=2).orderBy("orden").collect()] == ["b", "c"]
    with pytest.raises(ValueError):
        ranked(df, order, last="LOWEST", only_top=1)


@pytest.mark.parametrize("n", [1, 3, 700])
def test_top_n_per_group_equals_brute_force(spark, scores, n):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "100")
    try:
        df = top_n_per_group(scores, "team", [F.desc("score"), F.asc("who")], n)
        assert ("_piece" in df._jdf.queryExecution().analyzed().toString()) == (n > 100)
        got = rows(df)
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    teams = {}
    for r in scores.collect():
        teams.setdefault(r.team, []).append(r)
    want = []
    for members in teams.values():
        best = sorted(members, key=lambda r: (-r.score, r.who))[:n]
        want += [(r.who, r.score, r.team, place) for place, r in enumerate(best, 1)]
    assert sorted(got) == sorted(want)


def test_top_n_cuts_groups_before_the_shuffle(scores):
    df = top_n_per_group(scores, "team", [F.desc("score"), F.asc("who")], 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("x", 3)], "g string, n int")
    assert rows(top_n_per_group(df, "g", [F.desc("n")], 1)) == [(None, 2, 1), ("x", 3, 1)]


def test_extremes_ties_and_carry(spark):
    df = spark.createDataFrame(
        [(4, Decimal("9.50"), 1), (2, Decimal("9.50"), 2), (3, Decimal("1.00"), 3), (1, Decimal("1.00"), 4)],
        "k int, revenue decimal(10,2), n int",
    )
    got = [tuple(r) for r in extremes(df, ["k"], "revenue", carry=["n"]).collect()]
    assert got == [(2, Decimal("0.00"), Decimal("9.50"), 2), (1, Decimal("1.00"), Decimal("0.00"), 4)]


def test_extremes_missing_measure_is_lowest(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "k int, m int")
    assert [(r.k, r.min_m, r.max_m) for r in extremes(df, ["k"], "m").collect()] == [(3, 0, 7), (2, None, 0)]
    assert extremes(df.limit(0), ["k"], "m").count() == 0
