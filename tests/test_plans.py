"""Shape of the physical plans."""

from __future__ import annotations

from pathlib import Path

import pytest

from straitflow.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")

BATCH = [
    "feature_table",
    "feature_table_all_boxes",
    "daily_panel",
    "rolling_30",
    "dedup_events",
    "geo_tag_explode",
    "geo_tag_range_join",
    "geo_tag_grid_join",
    "asof_join_macro",
    "macro_forward_fill",
    "macro_full_outer_merge",
    "time_split",
    "classification_metrics",
    "graph_edges",
    "preprocessing_funnel",
]


def plan_of(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_nested_loops(spark, name):
    plan = plan_of(spark, name)
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert node not in plan


def test_dedup_ranks_on_both_sides_of_the_shuffle(spark):
    assert plan_of(spark, "dedup_events").count("WindowGroupLimit") == 2


def test_rolling_means_share_one_sort(spark):
    plan = plan_of(spark, "feature_table")
    assert plan.count("Exchange hashpartitioning(chokepoint") == 1
    assert plan.count("Sort [chokepoint") == 1


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(spark, "eda_chokepoint_totals")
    assert "l_extendedprice" not in plan
    price = plan_of(spark, "price_normalise")
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)" in price


@pytest.mark.parametrize("threshold, join", [("10m", "BroadcastHashJoin"), ("-1", "SortMergeJoin")])
def test_the_size_of_a_box_table_decides_its_join(spark, threshold, join):
    from straitflow.operators.tagging import tag_by_bins
    from straitflow.sources.sample import sample_events

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plan = tag_by_bins(sample_events(spark, SF_DIR))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert join in plan


def test_as_of_join_leaves_the_left_side_in_place(spark):
    plan = plan_of(spark, "asof_join_macro")
    join = plan.index("BroadcastHashJoin")
    assert "Exchange hashpartitioning(series_id" not in plan[:join]
