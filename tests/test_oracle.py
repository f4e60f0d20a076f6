"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from registry.core import QUERIES, oracle_texts
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
# One query per shape; `python tests/oracle.py <dir>` compares all of them.
NAMES = [
    "syslog_parse", "syslog_quarantine", "store_metrics_validate", "dq_store_metric_report", "dq_window_metrics",
    "perf_5min", "perf_by_location", "kpi_hourly", "events_enriched", "dim_stores", "scd2_merge", "snapshot_diff",
    "device_health", "store_health", "drive_through", "mv_order_complexity", "root_cause",
    "event_metric_correlation", "order_assessment", "call_quality_by_health", "call_quality_hourly",
    "sip_event_pairs_split", "sip_event_correlation", "regional_kpis", "subscriber_experience",
    "node_performance", "call_window_latency", "geo_top_bottom", "geo_saturation", "geo_nearest",
    "dash_critical_events", "event_impact", "timing_consistency", "zscore_outliers", "stream_rollup_5min",
    "stream_interval_join", "json_ingest", "rescued_data", "stream_schema_evolution", "scd2_history",
    "stream_trailing_counts", "geo_neighbour_counts", "geo_nearest_other_key", "geo_nearest_three_of_brand",
    "sip_failures_described", "node_performance_regional", "incremental_device_health",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, name):
    problem, rows = compare(spark, con, SF, name)
    assert problem is None
    assert rows > 0


def test_every_query_has_a_twin():
    assert set(oracle_texts()) == set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 5
