"""Plan-shape guards: the scale properties the design relies on."""

from conftest import SF_SMALL
from __spark_entry__ import queries


def _plan(spark, name):
    df = queries()[name](spark, SF_SMALL)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_family_filter_reaches_scan(spark):
    plan = _plan(spark, "sensor_avg")
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in plan


def test_admission_cap_limits_before_shuffle(spark):
    plan = _plan(spark, "admission_cap")
    assert plan.count("WindowGroupLimit") >= 4 and "Partial" in plan


def test_recent_latencies_limits_before_shuffle(spark):
    plan = _plan(spark, "recent_latencies")
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_flagship_reads_only_needed_columns(spark):
    plan = _plan(spark, "window_source_aggregates")
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double,props:string>" in plan


def test_arrival_scan_windows_are_bucket_partitioned(spark):
    # the per-row lag and running sum are partitioned by the sequence bucket
    plan = _plan(spark, "arrival_fragments")
    data_windows = [ln for ln in plan.splitlines() if "lag(_ws_us" in ln]
    assert data_windows and all("windowspecdefinition(_fr_bucket" in ln for ln in data_windows)


def test_kpi_history_limits_before_shuffle(spark):
    # nearly all samples predate the history and fall into one group
    plan = _plan(spark, "kpi_history")
    assert any("WindowGroupLimit [_g#" in ln and "Partial" in ln for ln in plan.splitlines())
