"""What physical plans must and must not hold."""

import os

import pytest

import __spark_entry__ as contract
from checks.base import Tables
from checks.plans import facts, plan_text
from fieldmark.operators import joins, ordered, windows

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")

# Queries that are a stored result when they return, or that train a model.
LAZY = sorted(
    set(contract.oracle_sql())
    - {"rebuild_on_decline", "stream_tumbling", "stream_upsert", "csv_source", "load_many", "overwrite_sink", "append_sink"}
)


@pytest.mark.parametrize("name", LAZY)
def test_no_product_of_tables(spark, name):
    found = facts(plan_text(contract.queries()[name](spark, FOLDER)))
    assert found["cartesian"] == 0 and found["nested_loop"] == 0


def test_filters_and_columns_reach_the_scan(spark):
    text = contract.queries()["table_source"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_totalprice), EqualTo(o_orderstatus,F)" in text
    assert "o_custkey" not in text.split("ReadSchema")[1]


def test_all_rolling_features_share_one_block_exchange(spark):
    t = Tables(spark, FOLDER)
    specs = {f"m{n}": ("mean", "volt", n) for n in (2, 23)} | {"sd": ("sd", "rotate", 23), "s": ("sum", "volt", 5)}
    out = windows.rolling(t.placed_telemetry, ["machineID"], "pos", specs)
    assert plan_text(out).count("_block") > 0
    assert facts(plan_text(out))["shuffles"] - facts(plan_text(t.placed_telemetry))["shuffles"] == 1


def test_series_windows_are_cut(spark):
    """No window over rows is grouped by the series alone."""
    t = Tables(spark, FOLDER)
    placed = ordered.positions(t.telemetry, ["machineID"], ["datetime"], ordered.clock_cell("datetime"))
    out = windows.multi_lag(placed, ["machineID"], "pos", "volt", [1, 5])
    row_windows = [line for line in plan_text(out).splitlines() if "Window [lag(" in line or "row_number()" in line]
    assert row_windows and all("_block" in line or "__cell" in line for line in row_windows)


def test_scoring_input_needs_no_join(spark):
    t = Tables(spark, FOLDER)
    project = t.projects.orderBy("ProjectId").limit(1)
    text = plan_text(joins.cross_join_score_input(t.resumes, project, {"pt": "pt"}))
    assert "Join" not in text.split("Subquer")[0]


def test_small_aggregate_is_broadcast_and_the_rows_stay(spark):
    t = Tables(spark, FOLDER)
    cycles = t.cycles.select("id", "cycle")
    out = windows.rul_label(cycles, "id", "cycle")
    assert facts(plan_text(out))["shuffles"] == facts(plan_text(cycles))["shuffles"]


def test_splits_do_not_shuffle(spark):
    assert facts(plan_text(contract.queries()["repeatable_split"](spark, FOLDER)))["shuffles"] == 0


def test_everything_has_a_query(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
