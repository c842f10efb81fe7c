"""Physical plans of registered queries: what must not appear in them."""

import pytest

from workloads.catalog import CATALOG

SF_DIR = "/root/testdata/sf0.001"


def physical(spark, name: str) -> str:
    df = CATALOG[name].run(spark, SF_DIR)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_no_pairing_and_no_python(spark, name):
    plan = physical(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython"):
        assert operator not in plan, operator


def test_one_shuffle_for_daily_statistics(spark):
    """From stored hours: the aggregation's own shuffle and no other."""
    plan = physical(spark, "multi_year_daily")
    assert plan.count("Exchange") == 1
    assert "partial_min" in plan.split("Exchange")[1]


def test_all_metrics_share_one_shuffle(spark):
    """That of the derived input, dealt round, and that of the aggregation."""
    plan = physical(spark, "daily_all_metrics")
    assert plan.count("Exchange") == 2 and "RoundRobinPartitioning" in plan


def test_only_needed_columns_are_read(spark):
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in physical(
        spark, "multi_year_daily"
    )


def test_windows_see_aggregated_rows_only(spark):
    for name in CATALOG:
        plan = physical(spark, name)
        # Runs of cells are found within 256 columns of one row of the grid.
        windows = [part for part in plan.split("Window [")[1:] if "run_block" not in part.split("\n")[0]]
        if windows:
            below = plan[plan.index(windows[0]) :]
            assert "HashAggregate" in below, name
            assert "SinglePartition" not in below.split("HashAggregate")[0], name


def test_edges_do_not_broadcast_vertices(spark):
    assert "SortMergeJoin" in physical(spark, "polygon_edges")
