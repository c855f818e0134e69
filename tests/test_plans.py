"""Plans stay free of nested loops, filters and columns reach the scan, and queries agree with their SQL."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

from check import compare, connect  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from millstream.plans import ORACLES, QUERIES  # noqa: E402

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="test tables are not here")

SAMPLE = [
    "rollup_grouping_filter", "full_outer_chain", "wildcard_match_join", "interval_join_first", "wo_period_join",
    "gap_segments", "resample_linear", "spc_imr", "dq_sequential_values", "do_dimension_anomalies",
    "alert_best_per_recipient", "shift_window", "upsert", "stream_session_segments", "cycle_boundaries",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_a_name_once():
    found, sqls = queries(), oracle_sql()
    assert set(sqls) <= set(found) and set(QUERIES) <= set(found)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", ["asof_backward_join", "interval_join_first", "lookback_interval_join", "wildcard_match_join", "ffill", "spc_xbar_r"])
def test_no_nested_loops(spark, name):
    text = plan(queries()[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_range_reaches_the_scan(spark):
    text = plan(queries()["jdbc_range_extract"](spark, SMALL))
    assert "GreaterThanOrEqual(ts" in text.split("PushedFilters")[1] and "props" not in text.split("ReadSchema")[1]


def test_hourly_range_reaches_the_scan(spark):
    text = plan(queries()["multi_level_time_agg"](spark, SMALL))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


def test_latest_needs_no_sort_of_the_key(spark):
    assert "Window" not in plan(queries()["latest_per_key"](spark, SMALL))
    assert "WindowGroupLimit" in plan(queries()["topk_per_group"](spark, SMALL))


@pytest.mark.parametrize("name", SAMPLE)
def test_agrees_with_sql(spark, name):
    df = queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = connect(SMALL).execute(oracle_sql()[name])
    verdict = compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description])
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    assert entry(spark).count() > 0
