"""Queries over the semantic views."""

from __future__ import annotations

from beaconry.plans import questions as q
from beaconry.plans import service
from beaconry.semantic import views as v
from registry.core import add

_SAMPLES = """avg(avg_value) AS "Average Value", max(max_value) AS "Max Value", min(min_value) AS "Min Value",
  avg(p50_value) AS "P50 Value", avg(p95_value) AS "P95 Value", avg(p99_value) AS "P99 Value",
  CAST(sum(sample_count) AS BIGINT) AS "Total Samples", CAST(sum(anomaly_count) AS BIGINT) AS "Anomaly Count",
  CAST(sum(anomaly_count) AS DOUBLE)/NULLIF(sum(sample_count),0)*100 AS "Anomaly Rate" """
_SAMPLES_D = "Average~Value Max~Value Min~Value P50~Value P95~Value P99~Value Anomaly~Rate"
_EVENTS = """count(*) AS "Event Count", count(*) FILTER (is_critical) AS "Critical Event Count",
  count(*) FILTER (is_critical)/CAST(count(*) AS DOUBLE)*100 AS "Critical Event Rate" """
_PLACES = """CAST(sum({n}_count) AS BIGINT) AS "{N} Count", avg({p}_avg_value) AS "Average Value",
  max({p}_max_value) AS "Max Value", min({p}_min_value) AS "Min Value", avg({p}_p95_value) AS "P95 Value",
  CAST(sum(total_anomalies) AS BIGINT) AS "Total Anomalies", CAST(sum(total_samples) AS BIGINT) AS "Total Samples",
  CAST(sum(total_anomalies) AS DOUBLE)/NULLIF(sum(total_samples),0)*100 AS "Anomaly Rate" """
_PLACES_D = "Average~Value Max~Value Min~Value P95~Value Anomaly~Rate"
_KPI = """CAST(sum({n}_count) AS BIGINT) AS "{N} Count", avg(hourly_avg) AS "Hourly Average",
  max(hourly_max) AS "Hourly Max", avg(hourly_p95) AS "Hourly P95",
  CAST(sum(hourly_anomalies) AS BIGINT) AS "Total Anomalies", CAST(sum(total_events) AS BIGINT) AS "Total Events",
  CAST(sum(critical_events) AS BIGINT) AS "Critical Events",
  CAST(sum(affected_{n}s) AS BIGINT) AS "Affected {N}s" """
_KPI_D = "Hourly~Average Hourly~Max Hourly~P95"
_FOOD_OTD = "metric_name='drive_through_total_experience_time_sec' AND store_category='fast_food'"


def _period(hour: str) -> str:
    return (f"CASE WHEN {hour} BETWEEN 11 AND 13 THEN 'Lunch Rush' WHEN {hour} BETWEEN 17 AND 19 THEN 'Dinner Rush'"
            f" WHEN {hour} BETWEEN 7 AND 10 THEN 'Breakfast' WHEN {hour} BETWEEN 14 AND 16 THEN 'Off-Peak Afternoon'"
            f" WHEN {hour} BETWEEN 20 AND 22 THEN 'Off-Peak Evening' ELSE 'Overnight' END")


def _rush(hour: str) -> str:
    return (f"CASE WHEN {hour} BETWEEN 11 AND 13 THEN 'Lunch Rush' WHEN {hour} BETWEEN 17 AND 19 THEN 'Dinner Rush'"
            f" ELSE 'Off-Peak' END")


_HARDWARE = ("event_type IN ('LOOP_SENSOR_MALFUNCTION','KDS_SCREEN_DOWN','POS_NETWORK_TIMEOUT','BUMP_BAR_STUCK',"
             "'HME_SYSTEM_REBOOT')")
_SIZE = ("CASE WHEN avg_order_value_context<15 THEN 'Small ($8-15)' WHEN avg_order_value_context<30 THEN"
         " 'Medium ($15-30)' WHEN avg_order_value_context<50 THEN 'Large ($30-50)'"
         " WHEN avg_order_value_context IS NULL THEN 'Unknown' ELSE 'Mega ($50+)' END")


def _all(view, source, dimensions):
    return lambda lake: view.query(source(lake), dimensions, list(view.measures))


add("mv_network_performance",
    _all(v.NETWORK_PERFORMANCE, lambda k: k.net.performance, ["Device Type", "Location", "Vendor", "Metric Name"]),
    f'SELECT device_type AS "Device Type", location AS "Location", vendor AS "Vendor", metric_name AS "Metric Name",'
    f' {_SAMPLES}, count(DISTINCT device_id) AS "Device Count" FROM net_perf GROUP BY 1,2,3,4', _SAMPLES_D)
add("mv_device_health",
    _all(v.DEVICE_HEALTH, lambda k: k.net.health, ["Device Type", "Health Status", "Requires Attention"]),
    """SELECT device_type AS "Device Type", health_status AS "Health Status",
         CASE WHEN requires_attention THEN 'Yes' ELSE 'No' END AS "Requires Attention",
         count(DISTINCT device_id) AS "Device Count", avg(health_score) AS "Average Health Score",
         min(health_score) AS "Min Health Score", avg(current_latency_ms) AS "Average Latency",
         avg(current_packet_loss_pct) AS "Average Packet Loss", avg(current_throughput_mbps) AS "Average Throughput",
         avg(current_jitter_ms) AS "Average Jitter", avg(current_error_rate) AS "Average Error Rate",
         CAST(sum(event_count_1h) AS BIGINT) AS "Total Events (1h)",
         CAST(sum(critical_event_count_1h) AS BIGINT) AS "Critical Events (1h)",
         count(*) FILTER (requires_attention) AS "Devices Needing Attention",
         count(*) FILTER (health_status='Critical') AS "Critical Device Count" FROM net_health GROUP BY 1,2,3""",
    "Average~Health~Score Average~Latency Average~Packet~Loss Average~Throughput Average~Jitter Average~Error~Rate")
add("mv_network_events",
    _all(v.NETWORK_EVENTS, lambda k: k.net.events,
         ["Event Type", "Event Category", "Is Critical", "Hour of Day", "Day of Week"]),
    f"""SELECT event_type AS "Event Type", event_category AS "Event Category",
         CASE WHEN is_critical THEN 'Critical' ELSE 'Non-Critical' END AS "Is Critical",
         hour_of_day AS "Hour of Day", day_of_week AS "Day of Week", {_EVENTS},
         count(DISTINCT device_id) AS "Affected Device Count", avg(event_age_minutes) AS "Average Event Age (min)"
       FROM net_events GROUP BY 1,2,3,4,5""", "Critical~Event~Rate Average~Event~Age~(min)")
add("mv_geographic", _all(v.GEOGRAPHIC_PERFORMANCE, lambda k: k.net.by_place, ["Location", "Metric Name", "Metric Unit"]),
    f'SELECT location AS "Location", metric_name AS "Metric Name", metric_unit AS "Metric Unit",'
    f' {_PLACES.format(n="device", N="Device", p="location")} FROM net_place GROUP BY 1,2,3', _PLACES_D)
add("mv_kpi", _all(v.NETWORK_KPI, lambda k: k.net.kpi, ["Hour", "Metric Name"]),
    f'SELECT hour_start AS "Hour", metric_name AS "Metric Name", {_KPI.format(n="device", N="Device")}'
    f' FROM net_kpi GROUP BY 1,2', _KPI_D)
add("mv_store_performance",
    _all(v.STORE_PERFORMANCE, lambda k: k.ret.performance, ["Store Category", "Region", "Brand", "Metric Name"]),
    f'SELECT store_category AS "Store Category", region AS "Region", brand AS "Brand", metric_name AS "Metric Name",'
    f' {_SAMPLES}, count(DISTINCT store_id) AS "Store Count" FROM ret_perf GROUP BY 1,2,3,4', _SAMPLES_D)
add("mv_store_health",
    _all(v.STORE_HEALTH, lambda k: k.ret.health, ["Store Category", "Region", "Health Status", "Requires Attention"]),
    """SELECT store_category AS "Store Category", region AS "Region", health_status AS "Health Status",
         CASE WHEN requires_attention THEN 'Yes' ELSE 'No' END AS "Requires Attention",
         count(DISTINCT store_id) AS "Store Count", avg(health_score) AS "Average Health Score",
         min(health_score) AS "Min Health Score", avg(current_hourly_sales) AS "Avg Hourly Sales",
         avg(current_wait_time_sec) AS "Avg Wait Time (sec)", avg(current_conversion_pct) AS "Avg Conversion Rate",
         avg(current_return_rate_pct) AS "Avg Return Rate", CAST(sum(event_count_1h) AS BIGINT) AS "Total Events (1h)",
         CAST(sum(critical_event_count_1h) AS BIGINT) AS "Critical Events (1h)",
         CAST(sum(inventory_issues_1h) AS BIGINT) AS "Inventory Issues (1h)",
         count(*) FILTER (requires_attention) AS "Stores Needing Attention",
         count(*) FILTER (health_status='Critical') AS "Critical Store Count" FROM ret_health GROUP BY 1,2,3,4""",
    "Average~Health~Score Avg~Hourly~Sales Avg~Wait~Time~(sec) Avg~Conversion~Rate Avg~Return~Rate")
add("mv_store_events",
    _all(v.STORE_EVENTS, lambda k: k.ret.events, ["Store Category", "Event Type", "Event Category", "Is Critical"]),
    f"""SELECT store_category AS "Store Category", event_type AS "Event Type", event_category AS "Event Category",
         CASE WHEN is_critical THEN 'Critical' ELSE 'Non-Critical' END AS "Is Critical", {_EVENTS},
         count(DISTINCT store_id) AS "Affected Store Count", avg(event_age_minutes) AS "Average Event Age (min)"
       FROM ret_events GROUP BY 1,2,3,4""", "Critical~Event~Rate Average~Event~Age~(min)")
add("mv_regional", _all(v.REGIONAL_PERFORMANCE, lambda k: k.ret.by_place, ["Region", "Metric Name", "Metric Unit"]),
    f'SELECT region AS "Region", metric_name AS "Metric Name", metric_unit AS "Metric Unit",'
    f' {_PLACES.format(n="store", N="Store", p="region")} FROM ret_place GROUP BY 1,2,3', _PLACES_D)
add("mv_kpi_retail", _all(v.RETAIL_KPI, lambda k: k.ret.kpi, ["Hour", "Metric Name"]),
    f'SELECT hour_start AS "Hour", metric_name AS "Metric Name", {_KPI.format(n="store", N="Store")}'
    f' FROM ret_kpi GROUP BY 1,2', _KPI_D)
add("mv_speed_of_service",
    _all(v.SPEED_OF_SERVICE, lambda k: k.ret.performance,
         ["Brand", "Metric Name", "Data Source", "Sensor Type", "Hour of Day", "Time Period"]),
    f"""SELECT brand AS "Brand", metric_name AS "Metric Name", data_source AS "Data Source",
         sensor_type AS "Sensor Type", hour(window_start) AS "Hour of Day", {_period("hour(window_start)")} AS "Time Period",
         {_SAMPLES}, count(DISTINCT store_id) AS "Store Count", avg(avg_order_value_context) AS "Avg Order Value",
         avg(avg_item_count_context) AS "Avg Item Count" FROM ret_perf GROUP BY 1,2,3,4,5,6""",
    _SAMPLES_D + " Avg~Order~Value Avg~Item~Count")
add("mv_event_causality",
    _all(v.EVENT_CAUSALITY, lambda k: k.ret.events,
         ["Store Category", "Region", "Is Hardware Event", "Severity Name", "Time Period"]),
    f"""SELECT store_category AS "Store Category", region AS "Region",
         CASE WHEN {_HARDWARE} THEN 'Hardware Failure' ELSE 'Operational Issue' END AS "Is Hardware Event",
         severity_name AS "Severity Name", {_rush("hour_of_day")} AS "Time Period", {_EVENTS},
         count(*) FILTER ({_HARDWARE}) AS "Hardware Event Count",
         count(*) FILTER (NOT {_HARDWARE}) AS "Operational Event Count",
         count(DISTINCT store_id) AS "Affected Store Count", avg(event_age_minutes) AS "Avg Event Age (min)",
         count(*)/CAST(NULLIF(count(DISTINCT store_id),0) AS DOUBLE) AS "Events Per Store"
       FROM ret_events GROUP BY 1,2,3,4,5""", "Critical~Event~Rate Avg~Event~Age~(min) Events~Per~Store")
add("mv_order_complexity",
    _all(v.ORDER_COMPLEXITY, lambda k: k.ret.performance,
         ["Store Category", "Brand", "Metric Name", "Order Size Category", "Is Normalized", "Time Period"]),
    f"""SELECT store_category AS "Store Category", brand AS "Brand", metric_name AS "Metric Name",
         {_SIZE} AS "Order Size Category",
         CASE WHEN normalized THEN 'Order-Normalized' ELSE 'Raw Timing' END AS "Is Normalized",
         {_rush("hour(window_start)")} AS "Time Period", avg(avg_value) AS "Average Timing (sec)",
         avg(p95_value) AS "P95 Timing (sec)", avg(avg_order_value_context) AS "Average Order Value",
         avg(avg_item_count_context) AS "Average Item Count", CAST(sum(sample_count) AS BIGINT) AS "Total Orders",
         count(DISTINCT store_id) AS "Store Count",
         avg(CASE WHEN normalized THEN avg_value END)/NULLIF(avg(CASE WHEN NOT normalized THEN avg_value END),0)
           AS "Normalized vs Baseline Ratio" FROM ret_perf GROUP BY 1,2,3,4,5,6""",
    "Average~Timing~(sec) P95~Timing~(sec) Average~Order~Value Average~Item~Count Normalized~vs~Baseline~Ratio")

_TOP = """SELECT metric_name AS "Metric Name", {place} AS "{Place}", avg(avg_value) AS "Average Value",
  max(max_value) AS "Max Value", CAST(sum(anomaly_count) AS BIGINT) AS "Anomaly Count",
  count(DISTINCT {n}_id) AS "{N} Count" FROM {source} WHERE metric_name='{metric}' GROUP BY 1,2
  ORDER BY "Average Value" DESC, "{Place}" LIMIT 10"""
add("latency_by_location",
    lambda k: q.metric_by(k.net.performance, v.NETWORK_PERFORMANCE, "latency_ms", "Location", "Device Count"),
    _TOP.format(place="location", Place="Location", n="device", N="Device", source="net_perf", metric="latency_ms"),
    "Average~Value Max~Value")
add("sales_by_region",
    lambda k: q.metric_by(k.ret.performance, v.STORE_PERFORMANCE, "hourly_sales", "Region", "Store Count"),
    _TOP.format(place="region", Place="Region", n="store", N="Store", source="ret_perf", metric="hourly_sales"),
    "Average~Value Max~Value")
_HEALTH = """SELECT health_status AS "Health Status", count(DISTINCT {n}_id) AS "{N} Count",
  avg(health_score) AS "Average Health Score", CAST(sum(critical_event_count_1h) AS BIGINT) AS "Critical Events (1h)",
  count(*) FILTER (requires_attention) AS "{N}s Needing Attention" FROM {source} GROUP BY 1"""
add("health_summary", lambda k: q.health_summary(k.net.health, v.DEVICE_HEALTH, "Device"),
    _HEALTH.format(n="device", N="Device", source="net_health"), "Average~Health~Score")
add("store_health_summary", lambda k: q.health_summary(k.ret.health, v.STORE_HEALTH, "Store"),
    _HEALTH.format(n="store", N="Store", source="ret_health"), "Average~Health~Score")
_CATEGORY = """SELECT event_category AS "Event Category", severity_name AS "Severity Name", count(*) AS "Event Count",
  count(*) FILTER (is_critical) AS "Critical Event Count", count(DISTINCT {n}_id) AS "Affected {N} Count"
  FROM {source} GROUP BY 1,2 ORDER BY 3 DESC,1,2 LIMIT 15"""
add("events_by_category", lambda k: q.events_by_category(k.net.events, v.NETWORK_EVENTS, "Device"),
    _CATEGORY.format(n="device", N="Device", source="net_events"))
add("store_events_by_category", lambda k: q.events_by_category(k.ret.events, v.STORE_EVENTS, "Store"),
    _CATEGORY.format(n="store", N="Store", source="ret_events"))
_ANOMALIES = """SELECT {p} AS "{P}", metric_name AS "Metric Name", CAST(sum({n}_count) AS BIGINT) AS "{N} Count",
  avg({p}_avg_value) AS "Average Value", CAST(sum(total_anomalies) AS BIGINT) AS "Total Anomalies",
  CAST(sum(total_anomalies) AS DOUBLE)/NULLIF(sum(total_samples),0)*100 AS "Anomaly Rate"
  FROM {source} GROUP BY 1,2"""
add("anomalies_by_location",
    lambda k: q.anomalies_by_place(k.net.by_place, v.GEOGRAPHIC_PERFORMANCE, "Location", "Device"),
    _ANOMALIES.format(p="location", P="Location", n="device", N="Device", source="net_place"),
    "Average~Value Anomaly~Rate")
add("anomalies_by_region",
    lambda k: q.anomalies_by_place(k.ret.by_place, v.REGIONAL_PERFORMANCE, "Region", "Store"),
    _ANOMALIES.format(p="region", P="Region", n="store", N="Store", source="ret_place"),
    "Average~Value Anomaly~Rate")
_KPIS = """SELECT metric_name AS "Metric Name", avg(hourly_avg) AS "Hourly Average", max(hourly_max) AS "Hourly Max",
  CAST(sum(hourly_anomalies) AS BIGINT) AS "Total Anomalies", CAST(sum(critical_events) AS BIGINT) AS "Critical Events"
  FROM {} GROUP BY 1"""
add("kpi_by_metric", lambda k: q.kpi_by_metric(k.net.kpi, v.NETWORK_KPI), _KPIS.format("net_kpi"),
    "Hourly~Average Hourly~Max")
add("retail_kpi_by_metric", lambda k: q.kpi_by_metric(k.ret.kpi, v.RETAIL_KPI), _KPIS.format("ret_kpi"),
    "Hourly~Average Hourly~Max")
add("latency_summary",
    lambda k: q.metric_summary(k.net.performance, v.NETWORK_PERFORMANCE, "latency_ms", ["Location", "Device Type"]),
    """SELECT location AS "Location", device_type AS "Device Type", avg(avg_value) AS avg_value,
         avg(p95_value) AS p95_value, CAST(sum(anomaly_count) AS DOUBLE)/sum(sample_count)*100 AS anomaly_pct
       FROM net_perf WHERE metric_name='latency_ms' GROUP BY 1,2""", "avg_value p95_value anomaly_pct")
add("service_by_period", lambda k: q.service_by_period(k.ret.performance),
    f"""SELECT {_period("hour(window_start)")} AS "Time Period", brand AS "Brand",
         count(DISTINCT store_id) AS "Store Count", avg(avg_value) AS avg_otd_seconds,
         avg(p95_value) AS p95_otd_seconds, CAST(sum(anomaly_count) AS DOUBLE)/sum(sample_count)*100 AS anomaly_pct
       FROM ret_perf GROUP BY 1,2 ORDER BY 4 DESC,1,2 LIMIT 10""", "avg_otd_seconds p95_otd_seconds anomaly_pct")
add("root_cause", lambda k: service.root_cause(k.ret.performance, 280),
    f"""SELECT * FROM (SELECT "Store ID", "Time Period",
           max(CASE WHEN m='drive_through_menu_board_time_sec' THEN t END) AS menu_board_sec,
           max(CASE WHEN m='drive_through_kds_bump_time_sec' THEN t END) AS kds_bump_sec,
           max(CASE WHEN m='drive_through_window_time_sec' THEN t END) AS window_sec,
           CASE WHEN menu_board_sec>60 THEN 'Menu Board Issue - Train Staff'
             WHEN kds_bump_sec>80 THEN 'Kitchen Production Issue' WHEN window_sec>90 THEN 'Window Bottleneck'
             ELSE 'Peak Hour Volume' END AS root_cause_diagnosis
         FROM (SELECT store_id AS "Store ID", {_period("hour(window_start)")} AS "Time Period", metric_name AS m,
             sensor_type, avg(avg_value) AS t FROM ret_perf
           WHERE metric_name IN ('drive_through_menu_board_time_sec','drive_through_kds_bump_time_sec',
             'drive_through_window_time_sec') GROUP BY 1,2,3,4) GROUP BY 1,2)
       WHERE menu_board_sec+kds_bump_sec+window_sec>280
       ORDER BY menu_board_sec+kds_bump_sec+window_sec DESC, 1, 2 LIMIT 20""",
    "menu_board_sec kds_bump_sec window_sec")
add("event_causality", lambda k: q.event_causality(k.ret.events),
    f"""SELECT event_type AS "Event Type",
         CASE WHEN {_HARDWARE} THEN 'Hardware Failure' ELSE 'Operational Issue' END AS "Is Hardware Event",
         severity_name AS "Severity Name", {_rush("hour_of_day")} AS "Time Period", count(*) AS "Event Count",
         count(*) FILTER (is_critical) AS "Critical Event Count", count(DISTINCT store_id) AS "Affected Store Count",
         count(*)/CAST(count(DISTINCT store_id) AS DOUBLE) AS "Events Per Store"
       FROM ret_events WHERE store_category='fast_food' GROUP BY 1,2,3,4 ORDER BY 5 DESC,1,2,3,4 LIMIT 20""",
    "Events~Per~Store")
_INCIDENTS = ("('EQUIPMENT_FAILURE','KDS_SCREEN_DOWN','LOOP_SENSOR_MALFUNCTION','POS_NETWORK_TIMEOUT',"
              "'HME_SYSTEM_REBOOT')")
add("event_metric_correlation", lambda k: service.event_metric_correlation(k.ret.events, k.ret.performance),
    f"""SELECT e.event_type, m.metric_name, count(DISTINCT m.store_id) AS affected_stores,
         avg(m.avg_value) AS avg_metric_during_incident,
         avg(date_sub('minute', e.event_timestamp, m.window_start)) AS avg_minutes_after_event,
         count(*) AS incident_count
       FROM ret_perf m JOIN ret_events e ON m.store_id=e.store_id
         AND m.window_start BETWEEN e.event_timestamp AND e.event_timestamp+INTERVAL 15 MINUTE
       WHERE m.store_category='fast_food' AND e.store_category='fast_food' AND e.is_critical
         AND e.event_type IN {_INCIDENTS}
         AND m.metric_name IN ('drive_through_total_experience_time_sec','drive_through_kds_bump_time_sec',
           'drive_through_window_time_sec','drive_through_cars_per_hour')
       GROUP BY 1,2""", "avg_metric_during_incident avg_minutes_after_event")
add("hardware_event_times", lambda k: service.hardware_event_times(k.ret.events, k.ret.performance),
    f"""SELECT event_type, count(DISTINCT store_id) AS affected_stores, avg(a) AS avg_otd_during_incident
       FROM (SELECT m.store_id, e.event_type, avg(m.avg_value) AS a FROM ret_perf m
         JOIN ret_events e ON m.store_id=e.store_id
           AND m.window_start BETWEEN e.event_timestamp AND e.event_timestamp+INTERVAL 15 MINUTE
         WHERE e.is_critical AND {_HARDWARE} AND m.metric_name='drive_through_total_experience_time_sec'
         GROUP BY 1,2) GROUP BY 1""", "avg_otd_during_incident")
add("order_size_timing", lambda k: q.order_size_timing(k.ret.performance),
    f"""SELECT {_SIZE} AS "Order Size Category", metric_name AS "Metric Name",
         {_rush("hour(window_start)")} AS "Time Period", count(DISTINCT store_id) AS "Store Count",
         avg(avg_value) AS avg_seconds, avg(avg_order_value_context) AS avg_order_dollars,
         avg(avg_item_count_context) AS avg_items, CAST(sum(sample_count) AS BIGINT) AS "Total Orders"
       FROM ret_perf WHERE {_FOOD_OTD} GROUP BY 1,2,3""", "avg_seconds avg_order_dollars avg_items")
add("order_assessment", lambda k: service.order_assessment(k.ret.performance),
    f"""SELECT store_id AS "Store ID", brand AS "Brand", avg(avg_order_value_context) AS avg_order_value,
         avg(avg_value) AS avg_time, avg(p95_value) AS p95_time,
         CASE WHEN avg_order_value>40 AND avg_time>300 THEN 'ACCEPTABLE - Large Orders'
           WHEN avg_order_value<20 AND avg_time>300 THEN 'PROBLEM - Small Orders Slow'
           WHEN avg_time>360 THEN 'CRITICAL - Review Operations' ELSE 'NORMAL' END AS assessment
       FROM ret_perf WHERE {_FOOD_OTD} AND normalized GROUP BY 1,2 HAVING avg(avg_value)>240
       ORDER BY avg_time DESC, 1 LIMIT 20""", "avg_order_value avg_time p95_time")
add("benchmark_gap", lambda k: service.benchmark_gap(k.ret.performance),
    f"""SELECT {_period("hour(window_start)")} AS "Time Period", metric_name AS "Metric Name",
         avg(avg_value) AS avg_seconds, avg(p95_value) AS p95_seconds,
         avg(avg_value) - CASE metric_name WHEN 'drive_through_total_experience_time_sec' THEN 270
           WHEN 'drive_through_menu_board_time_sec' THEN 25 WHEN 'drive_through_window_time_sec' THEN 50
           ELSE 40 END AS gap_from_industry_standard
       FROM ret_perf WHERE metric_name IN ('drive_through_total_experience_time_sec',
         'drive_through_menu_board_time_sec','drive_through_kds_bump_time_sec','drive_through_window_time_sec')
       GROUP BY 1,2""", "avg_seconds p95_seconds gap_from_industry_standard")
add("lowest_health", lambda k: q.lowest_health(k.net.health, v.DEVICE_HEALTH, "Device ID"),
    """SELECT device_id AS "Device ID", health_status AS "Health Status", min(health_score) AS "Min Health Score"
       FROM net_health GROUP BY 1,2 ORDER BY 3,1 LIMIT 5""")
add("locations_above", lambda k: q.places_above(k.net.performance, v.NETWORK_PERFORMANCE, "latency_ms", "Location", 50),
    """SELECT location AS "Location", avg(avg_value) AS "Average Value" FROM net_perf
       WHERE metric_name='latency_ms' GROUP BY 1 HAVING avg(avg_value)>50""", "Average~Value")
add("compare_locations",
    lambda k: q.compare_places(k.net.performance, v.NETWORK_PERFORMANCE, "throughput_mbps", "Location",
                               ["edge-north", "edge-south"]),
    """SELECT location AS "Location", avg(avg_value) AS "Average Value", avg(p95_value) AS "P95 Value",
         CAST(sum(anomaly_count) AS DOUBLE)/sum(sample_count)*100 AS "Anomaly Rate" FROM net_perf
       WHERE metric_name='throughput_mbps' AND location IN ('edge-north','edge-south') GROUP BY 1""",
    "Average~Value P95~Value Anomaly~Rate")
