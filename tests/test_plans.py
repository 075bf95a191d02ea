"""What the plans must and must not contain, whatever the size of the tables."""

import re

import pytest

from tally.plans.catalog import QUERIES

STREAMED = {"ss_audit", "ss_audit_batches", "ss_audit_pairs", "ss_validate", "ss_validate_dates"}  # return what was written


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(QUERIES) - STREAMED))
def test_no_pairing_of_all_rows_and_no_python(spark, small_dir, key):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES[key](spark, small_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"Python|ArrowEval|InPandas", text)


@pytest.mark.parametrize("key", ["r01", "r02", "r03", "r08", "r09", "r10", "r15", "r19", "r20", "v07", "v08", "v09"])
def test_year_filters_reach_the_scan(spark, small_dir, key, monkeypatch):
    from tally.operators import ranking

    monkeypatch.setattr(ranking, "store", lambda df: df)  # keep the whole plan in sight
    pushed = re.findall(r"PushedFilters: \[([^\]]*)", plan(QUERIES[key](spark, small_dir)))
    assert any("GreaterThanOrEqual(" in filters or "LessThan(" in filters for filters in pushed)


@pytest.mark.parametrize("key", ["r08", "r13", "r19", "wn_rankall"])
def test_large_ranks_use_no_window_over_the_rows(spark, small_dir, key):
    assert "row_number" not in plan(QUERIES[key](spark, small_dir))


@pytest.mark.parametrize("key", ["r06", "r07", "v07", "v09", "flt_postwin", "wn_rankpart"])
def test_groups_are_cut_before_the_shuffle(spark, small_dir, key):
    assert plan(QUERIES[key](spark, small_dir)).count("WindowGroupLimit") == 2


@pytest.mark.parametrize("key", ["v06", "v08", "so_top1", "so_topn"])
def test_limits_are_top_k(spark, small_dir, key):
    assert "TakeOrderedAndProject" in plan(QUERIES[key](spark, small_dir))


@pytest.mark.parametrize(("key", "table"), [("ag_cond", "customer"), ("so_extremes", "lineitem"), ("q_rules", "lineitem")])
def test_several_counts_take_one_scan(spark, small_dir, key, table):
    assert len(re.findall(rf"FileScan parquet .*{table}\.parquet", plan(QUERIES[key](spark, small_dir)))) == 1


def test_scans_read_only_needed_columns(spark, small_dir):
    text = plan(QUERIES["r01"](spark, small_dir))
    assert "ReadSchema: struct<l_orderkey:bigint>" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_full_flights_sort_once(spark, small_dir):
    text = plan(QUERIES["r13"](spark, small_dir))
    assert "rangepartitioning" not in text  # the one sort is behind the stored rows


def test_labels_use_no_bound_of_an_unjoined_table(spark, small_dir):
    assert "row_number" not in plan(QUERIES["wn_label"](spark, small_dir))


def test_references_of_a_child_are_one_scan(spark, small_dir):
    from tally.plans.bindings import OrderTables
    from tally.plans.integrity import reference_counts

    refs = [("flight_id", "flights", "flight_id"), ("employee_id", "employees", "employee_id")]
    counted = reference_counts(OrderTables(spark, small_dir), "tickets", refs)
    assert len(re.findall(r"Scan parquet", plan(counted))) == 3
