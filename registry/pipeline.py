"""Queries over the silver and gold tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconry.operators.dims import apply_changes, scd1_upsert, scd2_merge, snapshot_diff
from beaconry.operators.events import recent_event_counts, sliding_event_counts
from beaconry.operators.logs import read_fields
from beaconry.operators.metrics import type_metrics
from beaconry.operators.quality import data_quality_metrics, expectation_report, quarantine
from beaconry.operators.rollups import rollup_5min, rollup_by_place
from beaconry.profiles import NETWORK, RETAIL
from beaconry.sinks.tables import table_counts
from registry.core import add

_LOG = ["priority", "version", "log_timestamp", "hostname", "app_name", "proc_id", "msg_id", "structured_data",
        "message", "raw_message", "facility", "severity", "severity_name", "event_timestamp", "event_category",
        "is_critical"]


def _log(attributes: list[str]) -> str:
    return ", ".join(["event_id", *_LOG, *attributes])


add("syslog_parse", lambda lake: lake.net.parsed.select("event_id", *_LOG, "device_type", "location"),
    f"SELECT {_log(['device_type', 'location'])} FROM net_parsed")
add("store_log_parse", lambda lake: lake.ret.parsed.select("event_id", *_LOG, "region", "store_category"),
    f"SELECT {_log(['region', 'store_category'])} FROM ret_parsed")
add("syslog_category_counts",
    lambda lake: lake.net.parsed.groupBy("event_category", "severity_name").agg(
        F.count(F.lit(1)).alias("events"), F.count_if("is_critical").alias("critical")),
    "SELECT event_category, severity_name, count(*) AS events, count(*) FILTER (is_critical) AS critical"
    " FROM net_parsed GROUP BY 1,2")
add("syslog_quarantine",
    lambda lake: quarantine(read_fields(lake.fx("fx_syslog"), NETWORK), NETWORK.log_expectations).select(
        "event_id", "raw_message", "violations"),
    "SELECT event_id, raw_message, CASE WHEN priority IS NULL THEN 'valid_priority,valid_device_id'"
    " ELSE 'valid_priority' END AS violations FROM net_fields WHERE priority IS NULL OR priority>191")

_NET_COLUMNS = ["event_timestamp", "device_id", "device_type", "location", "vendor", "model", "ip_address", "oid",
                "metric_name", "value", "is_anomaly", "metric_unit", "severity_level", "source_file"]
_RET_COLUMNS = ["event_timestamp", "store_id", "store_category", "store_type", "region", "brand", "district",
                "address", "latitude", "longitude", "oid", "metric_name", "value", "is_anomaly", "metric_unit",
                "severity_level", "data_source", "sensor_type", "order_value", "item_count", "normalized",
                "source_file"]
add("metrics_validate", lambda lake: lake.net.metrics.select(*_NET_COLUMNS),
    f"SELECT {', '.join(_NET_COLUMNS)} FROM net_metrics", "value")
add("store_metrics_validate", lambda lake: lake.ret.metrics.select(*_RET_COLUMNS),
    f"SELECT {', '.join(_RET_COLUMNS)} FROM ret_metrics", "value latitude longitude order_value")
add("metrics_severity_counts",
    lambda lake: lake.net.metrics.groupBy("metric_name", "metric_unit", "severity_level").agg(
        F.count(F.lit(1)).alias("samples"), F.count_if("is_anomaly").alias("anomalies")),
    "SELECT metric_name, metric_unit, severity_level, count(*) AS samples,"
    " count(*) FILTER (is_anomaly) AS anomalies FROM net_metrics GROUP BY 1,2,3")


def _report_sql(source: str, rules) -> str:
    rows = [f"SELECT '{r.name}' AS rule, '{'drop' if r.drop else 'warn'}' AS policy, count(*) AS total_rows,"
            f" count(*) FILTER (({r.condition}) IS NOT TRUE) AS violations,"
            f" count(*) FILTER ({r.condition}) AS passed FROM {source}" for r in rules]
    return " UNION ALL ".join(rows)


add("dq_log_report",
    lambda lake: expectation_report(read_fields(lake.fx("fx_syslog"), NETWORK), NETWORK.log_expectations),
    _report_sql("net_fields", NETWORK.log_expectations))
add("dq_metric_report",
    lambda lake: expectation_report(type_metrics(lake.fx("fx_metrics"), NETWORK, "event_timestamp"),
                                    NETWORK.metric_expectations),
    _report_sql("fx_metrics", NETWORK.metric_expectations))
add("dq_store_metric_report",
    lambda lake: expectation_report(type_metrics(lake.fx("fx_store_metrics"), RETAIL, "event_timestamp"),
                                    RETAIL.metric_expectations),
    _report_sql("fx_store_metrics", RETAIL.metric_expectations))
add("dq_window_metrics",
    lambda lake: data_quality_metrics(lake.ret.parsed, lake.ret.metrics, "store_id", "arrival", "event_timestamp"),
    """SELECT time_bucket(INTERVAL '5 minutes', arrival) AS window_start,
         time_bucket(INTERVAL '5 minutes', arrival)+INTERVAL '5 minutes' AS window_end, 'events' AS source,
         count(*) AS total_records, count(DISTINCT hostname) AS unique_entities,
         count(*) FILTER (is_critical) AS critical_events, count(DISTINCT event_category) AS event_categories
       FROM ret_parsed GROUP BY 1,2
       UNION ALL
       SELECT time_bucket(INTERVAL '5 minutes', event_timestamp),
         time_bucket(INTERVAL '5 minutes', event_timestamp)+INTERVAL '5 minutes', 'metrics', count(*),
         count(DISTINCT store_id), count(*) FILTER (is_anomaly), count(DISTINCT metric_name)
       FROM ret_metrics GROUP BY 1,2""")

_STATS = "avg_value min_value max_value p50_value p95_value p99_value stddev_value max_anomaly_value"
add("perf_5min", lambda lake: lake.net.performance, "SELECT * FROM net_perf", _STATS)
add("store_perf_5min", lambda lake: lake.ret.performance, "SELECT * FROM ret_perf",
    _STATS + " latitude longitude avg_order_value_context avg_item_count_context")
add("perf_5min_approx_files",
    lambda lake: rollup_5min(lake.net.metrics, NETWORK, approximate_files=True).drop("source_file_count"),
    "SELECT * EXCLUDE (source_file_count) FROM net_perf", _STATS)
_PLACE = "{0}_avg_value {0}_max_value {0}_min_value {0}_p95_value"
add("perf_by_location", lambda lake: lake.net.by_place, "SELECT * FROM net_place", _PLACE.format("location"))
add("perf_by_region", lambda lake: lake.ret.by_place, "SELECT * FROM ret_place", _PLACE.format("region"))
add("perf_by_location_sketch",
    lambda lake: rollup_by_place(rollup_5min(lake.net.metrics, NETWORK, sketch=True), NETWORK).select(
        "window_start", "location", "metric_name", "location_true_p95_value", "total_samples"),
    """SELECT time_bucket(INTERVAL '5 minutes', event_timestamp) AS window_start, location, metric_name,
         quantile_disc(value,0.95) AS location_true_p95_value, count(*) AS total_samples
       FROM net_metrics GROUP BY 1,2,3""", "location_true_p95_value")
_KPI = "hourly_avg hourly_max hourly_p95"
add("kpi_hourly", lambda lake: lake.net.kpi, "SELECT * FROM net_kpi", _KPI)
add("retail_kpi_hourly", lambda lake: lake.ret.kpi, "SELECT * FROM ret_kpi", _KPI)

_EVENT = ["app_name", "event_type", "event_category", "severity", "severity_name", "is_critical", "event_message",
          "structured_data"]
add("events_dedup", lambda lake: lake.net.silver_events,
    f"SELECT event_timestamp, device_id, device_type, location, {', '.join(_EVENT)} FROM net_events")
add("store_events_dedup", lambda lake: lake.ret.silver_events,
    f"SELECT event_timestamp, store_id, store_category, region, {', '.join(_EVENT)} FROM ret_events")
add("events_enriched", lambda lake: lake.net.events, "SELECT * FROM net_events", "event_age_minutes")
add("store_events_enriched", lambda lake: lake.ret.events, "SELECT * FROM ret_events", "event_age_minutes")
add("recent_events_1h", lambda lake: recent_event_counts(lake.net.events, NETWORK, lake.net.as_of),
    "SELECT * FROM net_recent")
add("store_recent_events_1h", lambda lake: recent_event_counts(lake.ret.events, RETAIL, lake.ret.as_of),
    "SELECT * FROM ret_recent")
_SLIDING = """SELECT s AS window_start, s+INTERVAL 1 HOUR AS window_end, device_id, count(*) AS event_count,
         count(*) FILTER (is_critical) AS critical_event_count
       FROM (SELECT *, unnest(generate_series(time_bucket(INTERVAL '5 minutes', event_timestamp)
               -INTERVAL 55 MINUTE, time_bucket(INTERVAL '5 minutes', event_timestamp),
               INTERVAL 5 MINUTE)) AS s FROM net_events) GROUP BY 1,2,3"""
add("sliding_event_counts", lambda lake: sliding_event_counts(lake.net.silver_events, NETWORK), _SLIDING)

add("dim_devices", lambda lake: lake.net.dimension, "SELECT * FROM net_dim")
add("dim_stores", lambda lake: lake.ret.dimension, "SELECT * FROM ret_dim", "latitude longitude")

# Two snapshots that share most keys: the second is shifted by 100.
_OLD = "SELECT c_custkey AS k, c_mktsegment AS segment, c_nationkey AS nation FROM customer"
_NEW = "SELECT c_custkey+100 AS k, c_mktsegment AS segment, c_nationkey AS nation FROM customer"
_SIDES = f"FROM ({_OLD}) o FULL JOIN ({_NEW}) n ON o.k=n.k"
_CHANGED = "(o.segment IS DISTINCT FROM n.segment OR o.nation IS DISTINCT FROM n.nation)"


def _dimension(lake):
    return lake.sql(_OLD).withColumns({
        "effective_start_date": F.lit("2026-01-01").cast("timestamp"),
        "effective_end_date": F.lit(None).cast("timestamp"), "is_active": F.lit(True)})


add("snapshot_diff", lambda lake: snapshot_diff(lake.sql(_OLD), lake.sql(_NEW), ["k"]),
    f"""SELECT * FROM (SELECT CASE WHEN o.k IS NULL THEN 'insert' WHEN n.k IS NULL THEN 'delete'
          WHEN {_CHANGED} THEN 'update' END AS change_type, coalesce(n.k,o.k) AS k,
          CASE WHEN n.k IS NULL THEN o.segment ELSE n.segment END AS segment,
          CASE WHEN n.k IS NULL THEN o.nation ELSE n.nation END AS nation {_SIDES})
        WHERE change_type IS NOT NULL""")
add("snapshot_apply",
    lambda lake: apply_changes(lake.sql(_OLD), snapshot_diff(
        lake.sql(_OLD), lake.sql(_NEW), ["k"]), ["k"]), _NEW)
add("scd1_upsert", lambda lake: scd1_upsert(lake.sql(_OLD), lake.sql(_NEW), ["k"]),
    f"SELECT coalesce(n.k,o.k) AS k, CASE WHEN n.k IS NULL THEN o.segment ELSE n.segment END AS segment,"
    f" CASE WHEN n.k IS NULL THEN o.nation ELSE n.nation END AS nation {_SIDES}")
_SCD2 = f"""SELECT o.k AS k, o.segment AS segment, o.nation AS nation,
          TIMESTAMP '2026-01-01' AS effective_start_date,
          CASE WHEN n.k IS NOT NULL AND {_CHANGED} THEN TIMESTAMP '2026-02-01' END AS effective_end_date,
          NOT (n.k IS NOT NULL AND {_CHANGED}) AS is_active {_SIDES} WHERE o.k IS NOT NULL
        UNION ALL
        SELECT n.k, n.segment, n.nation, TIMESTAMP '2026-02-01', CAST(NULL AS TIMESTAMP), TRUE {_SIDES}
        WHERE n.k IS NOT NULL AND (o.k IS NULL OR {_CHANGED})"""
add("scd2_merge",
    lambda lake: scd2_merge(_dimension(lake), lake.sql(_NEW), ["k"], ["segment", "nation"], "2026-02-01"), _SCD2)

_NET_STATE = ("current_latency_ms current_packet_loss_pct current_throughput_mbps current_jitter_ms"
              " current_error_rate")
_RET_STATE = ("latitude longitude current_hourly_sales current_transactions current_traffic current_basket_size"
              " current_wait_time_sec current_conversion_pct current_return_rate_pct current_order_value"
              " current_dt_wait_time_sec current_dt_accuracy_pct current_kitchen_time_sec current_food_waste_pct")
add("device_health", lambda lake: lake.net.health, "SELECT * FROM net_health", _NET_STATE)
add("store_health", lambda lake: lake.ret.health, "SELECT * FROM ret_health", _RET_STATE)
_LANES = {
    "avg_wait_time_sec": ("drive_through_wait_time_sec", "avg_value"),
    "p95_wait_time_sec": ("drive_through_wait_time_sec", "p95_value"),
    "avg_throughput_per_hour": ("drive_through_throughput_per_hour", "avg_value"),
    "avg_order_accuracy_pct": ("drive_through_order_accuracy_pct", "avg_value"),
    "avg_speaker_to_window_sec": ("speaker_to_window_time_sec", "avg_value"),
    "p95_speaker_to_window_sec": ("speaker_to_window_time_sec", "p95_value"),
    "avg_mobile_pickup_sec": ("mobile_order_pickup_time_sec", "avg_value"),
    "avg_peak_service_time_sec": ("peak_hour_service_time_sec", "avg_value"),
}
add("drive_through", lambda lake: lake.ret.lanes,
    f"""SELECT *, CASE WHEN hour(window_start) BETWEEN 11 AND 13 THEN 'lunch_peak'
          WHEN hour(window_start) BETWEEN 17 AND 19 THEN 'dinner_peak'
          WHEN hour(window_start) BETWEEN 6 AND 9 THEN 'breakfast_peak' ELSE 'off_peak' END AS time_period,
          CASE WHEN avg_wait_time_sec<=180 AND avg_order_accuracy_pct>=95 THEN 'Excellent'
            WHEN avg_wait_time_sec<=300 AND avg_order_accuracy_pct>=90 THEN 'Good'
            WHEN avg_wait_time_sec<=420 AND avg_order_accuracy_pct>=85 THEN 'Fair'
            ELSE 'Needs_Improvement' END AS performance_grade
        FROM (SELECT window_start, window_end, store_id, store_type, region, brand, min(latitude) AS latitude,
            min(longitude) AS longitude,
            {", ".join(f"max(CASE WHEN metric_name='{m}' THEN {c} END) AS {n}" for n, (m, c) in _LANES.items())}
          FROM ret_perf WHERE store_category='fast_food'
            AND metric_name IN ({",".join(sorted({f"'{m}'" for m, _ in _LANES.values()}))})
          GROUP BY 1,2,3,4,5,6)""", "latitude longitude " + " ".join(_LANES))
add("table_counts",
    lambda lake: table_counts({"performance": lake.net.performance, "health": lake.net.health,
                               "events": lake.net.events, "by_location": lake.net.by_place,
                               "kpi": lake.net.kpi}),
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {s}" for n, s in [
        ("performance", "net_perf"), ("health", "net_health"), ("events", "net_events"),
        ("by_location", "net_place"), ("kpi", "net_kpi")]))
