"""Physical-plan shape: the scale properties the operators are built for."""

import pytest

from abacus.catalogue import QUERIES, Ledger

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    keys = ["split_expand", "record_spine", "latest_per_key", "categories_latest", "conditional_sums",
            "dense_rollup", "chart_monthly_overview", "audit_forall", "scan_project", "date_range"]
    return {k: plan(QUERIES[k](spark, SF)) for k in keys}


def test_no_cartesian_or_nested_loop_joins(plans):
    for key, p in plans.items():
        assert "CartesianProduct" not in p and "NestedLoopJoin" not in p, key


def test_split_expand_is_inner_plus_anti_not_outer(plans):
    p = plans["split_expand"]
    assert "Inner" in p and "LeftAnti" in p and "LeftOuter" not in p and "Union" in p


def test_latest_per_key_has_no_window_sort(plans):
    for key in ("latest_per_key", "categories_latest"):
        assert "Window" not in plans[key], key
    assert "partial_max_by" in plans["latest_per_key"]


def test_record_spine_is_a_generator(spark):
    p = plan(Ledger(spark, SF, materialize=False)["combined.record_spine"])
    assert "Generate explode(" in p and "sequence(" in p
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_aggregations_are_partial_before_the_shuffle(plans):
    for key in ("conditional_sums", "dense_rollup"):
        assert "partial_sum" in plans[key], key


def test_chart_series_is_one_scan(plans):
    p = plans["chart_monthly_overview"]
    assert "Union" not in p and p.count("FileScan parquet") == 1


def test_projection_reaches_the_reader(spark):
    p = plan(QUERIES["month_key"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in p


def test_audits_scan_once(plans):
    p = plans["audit_forall"]
    assert p.count("FileScan parquet") == 1


def test_no_python_evaluation_anywhere(spark):
    python_nodes = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                    "FlatMapCoGroupsInPandas", "PythonUDF", "MapInArrow")
    for key, fn in QUERIES.items():
        df = fn(spark, SF)
        text = df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()
        assert not any(node in text for node in python_nodes), key
