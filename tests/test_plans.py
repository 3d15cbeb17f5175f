"""Plans stay what they should be: pruned scans, no Python, bounded shuffles."""

from __future__ import annotations

import re

import pytest

from skyledger.catalog.queries import REGISTRY

SMALL = "/root/testdata/sf0.001"


def plan(spark, name, executed=False):
    frame = REGISTRY[name](spark, SMALL)
    if executed:
        frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    return re.findall(r"ReadSchema: struct<([^>]*)>", text)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("comfort_distribution", "event_id:bigint"),
        ("temperature_distribution", "event_id:bigint"),
        ("batch_summary", "event_id:bigint"),
        ("temp_stats_by_city", "event_id:bigint,user_id:bigint"),
        ("growth_summary", "ts:timestamp_ntz,user_id:bigint"),
        ("total_count", ""),
        ("url_param", "page_id:bigint,url:string"),
    ],
)
def test_scans_read_only_what_is_used(spark, name, columns):
    assert read_columns(plan(spark, name)) == [columns]


@pytest.mark.parametrize("name", ["batch_summary", "profile_distributions", "describe_numeric"])
def test_many_reports_take_one_scan(spark, name):
    assert len(read_columns(plan(spark, name))) == 1


@pytest.mark.parametrize("name", ["latest_by_city", "latest_overall", "sample_projection"])
def test_newest_rows_are_not_a_full_sort(spark, name):
    text = plan(spark, name)
    assert "TakeOrderedAndProject" in text and "Exchange range" not in text


def test_the_scalar_total_reuses_the_grouped_rows(spark):
    assert "ReusedExchange" in plan(spark, "comfort_pct_scalar_total", executed=True)


# These run when built, and their frames only read what they wrote.
WRITERS = ("job_", "stream_", "sink_roundtrip", "sink_quarantine", "surrogate_", "run_counts")


@pytest.mark.parametrize("name", [n for n in sorted(REGISTRY) if not n.startswith(WRITERS)])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(spark, name)
    for bad in ("EvalPython", "PythonUDF", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text
