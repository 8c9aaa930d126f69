"""Plans and parity of every registered query."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
import parity
from freshet.checks import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"
# These write files before they return a frame.
WRITING = {"land_exports", "land_tagged", "publish_all_roundtrip", "revise_slice", "csv_titled_scan", "multi_file_scan", "partitioned_roundtrip", "scenario_lookup", "snapshot_roundtrip"}


@pytest.fixture(scope="module")
def con():
    return parity.connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    text, _ = parity.compare(spark, con, QUERIES[name], SQL[name], SMALL)
    assert not text, text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_plan(spark, name):
    """No cross joins, no Python in the plan, no window over the whole data, no unpruned scan."""
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan
    assert not re.search(r"Window \[.*\], \[\], ", plan)
    for schema in re.findall(r"ReadSchema: struct<([^>]*)", plan):
        assert schema.count(":") <= 5, schema


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


DIVERSIONS = [f"{kind}_diverted_{family}" for kind in ("total", "proportion") for family in ("calsim2", "calsim3", "action_5")]


@pytest.mark.parametrize("name", DIVERSIONS)
def test_the_window_of_diversions_reaches_the_scan(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"PushedFilters: \[([^\]]*)[^\n]*l_returnflag", plan)
    assert scans and all("GreaterThanOrEqual(l_shipdate" in s for s in scans)


@pytest.mark.parametrize("name", ["model_cube", "supplier_cube", "two_place_cube", "mean_flow_calsim2"])
def test_cubes_collect_nothing(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "collect_set" not in plan


def test_the_day_table_of_a_log_is_not_copied(spark):
    plan = QUERIES["gate_intervals"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "explode" not in plan and plan.count("events.parquet") <= 2


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["scenario", "place", "month"] and df.count() > 0


def test_filters_reach_the_scan(spark):
    plan = QUERIES["window_filter"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PushedFilters: \[([^\]]*)", plan).group(1)
    assert "GreaterThanOrEqual(l_shipdate" in pushed and "LessThan(l_shipdate" in pushed
    plan = QUERIES["scenario_compare"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "In(l_returnflag" in plan or "l_returnflag" in re.search(r"PushedFilters: \[([^\]]*)", plan).group(1)


@pytest.mark.parametrize("name", ["gate_intervals", "gate_days_open", "gate_month_stats", "previous_entry_hot_gate"])
def test_one_scan_of_the_log(spark, name):
    """The log is written in ranges; what follows reads those."""
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("events.parquet") <= 1


def run_time_plan(spark, name):
    """The plan as adaptive execution finished it."""
    df = QUERIES[name](spark, SMALL)
    df.collect()
    executed = df._jdf.queryExecution().executedPlan()
    return executed, executed.toString().split("== Initial Plan ==")[0]


ONE_SCAN = [
    "full_merge_by_date", "junction_ratio", "month_year_matrix", "proportion_diverted_calsim2", "ratio_policies",
    "total_diverted_calsim2", "unified_comparison", "union_scenarios",
]


@pytest.mark.parametrize("name", ONE_SCAN)
def test_line_items_are_read_once(spark, name):
    _, plan = run_time_plan(spark, name)
    assert plan.count("lineitem.parquet") == 1


@pytest.mark.parametrize("name", ["ratio_policies", "junction_ratio", "formula_ratio", "proportion_diverted_calsim2"])
def test_generated_methods_can_be_compiled(spark, name):
    """The virtual machine only interprets methods of more than 8,000 bytes."""
    executed, _ = run_time_plan(spark, name)
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(executed)
    assert 0 < max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) <= 8000


@pytest.mark.parametrize("name", ["formula_sum", "formula_sum_present", "formula_ratio", "delta_flows", "bypass_ratio", "overtopped"])
def test_formulas_of_a_growing_map_stay_in_bounded_lots(spark, name):
    """One shuffle, whose lots follow from the number of lines and are not put together again."""
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count("REPARTITION_BY_NUM") == 1
