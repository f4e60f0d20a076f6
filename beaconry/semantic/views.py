"""The thirteen views over network and retail tables."""

from __future__ import annotations

from beaconry.profiles.retail import HARDWARE_EVENTS, LARGEST_ORDER, ORDER_SIZES, RUSH_PERIODS, SERVICE_PERIODS
from beaconry.semantic.model import MetricView, Registry


def _period_sql(hour: str, periods) -> str:
    buckets, otherwise = periods
    cases = " ".join(f"WHEN {hour} BETWEEN {lo} AND {hi} THEN '{label}'" for lo, hi, label in buckets)
    return f"CASE {cases} ELSE '{otherwise}' END"


def _flag(column: str, yes: str, no: str) -> str:
    return f"CASE WHEN {column} THEN '{yes}' ELSE '{no}' END"


def _share(part: str, whole: str) -> str:
    return f"{part} / NULLIF({whole}, 0) * 100"


_HARDWARE = "event_type IN ({})".format(", ".join(f"'{e}'" for e in HARDWARE_EVENTS))
_ORDER_SIZE = "CASE WHEN avg_order_value_context IS NULL THEN 'Unknown' {} ELSE '{}' END".format(
    " ".join(f"WHEN avg_order_value_context {op} {bound} THEN '{label}'" for op, bound, label in ORDER_SIZES),
    LARGEST_ORDER)

_WINDOW = {"Time Window Start": "window_start", "Time Window End": "window_end"}
_METRIC = {"Metric Name": "metric_name", "Metric Unit": "metric_unit"}
_STORE = {"Store ID": "store_id", "Store Category": "store_category"}
_POINT = {"Latitude": "latitude", "Longitude": "longitude"}
_SAMPLES = {
    "Average Value": "AVG(avg_value)", "Max Value": "MAX(max_value)", "Min Value": "MIN(min_value)",
    "P50 Value": "AVG(p50_value)", "P95 Value": "AVG(p95_value)", "P99 Value": "AVG(p99_value)",
    "Total Samples": "SUM(sample_count)", "Anomaly Count": "SUM(anomaly_count)",
    "Anomaly Rate": _share("SUM(anomaly_count)", "SUM(sample_count)"),
}
_DEVICES = {"Device Count": "COUNT(DISTINCT device_id)"}
_STORES = {"Store Count": "COUNT(DISTINCT store_id)"}
_ATTENTION = {"Requires Attention": _flag("requires_attention", "Yes", "No")}


def _health_measures(noun: str, measures: dict[str, str], trouble: str) -> dict[str, str]:
    return {
        f"{noun} Count": f"COUNT(DISTINCT {noun.lower()}_id)",
        "Average Health Score": "AVG(health_score)", "Min Health Score": "MIN(health_score)",
        **measures,
        "Total Events (1h)": "SUM(event_count_1h)", "Critical Events (1h)": "SUM(critical_event_count_1h)",
        **({trouble: "SUM(inventory_issues_1h)"} if trouble else {}),
        f"{noun}s Needing Attention": "SUM(CASE WHEN requires_attention THEN 1 ELSE 0 END)",
        f"Critical {noun} Count": "SUM(CASE WHEN health_status = 'Critical' THEN 1 ELSE 0 END)",
    }


def _event_dimensions(entity: dict[str, str]) -> dict[str, str]:
    return {
        "Event Timestamp": "event_timestamp", **entity, "Event Type": "event_type",
        "Event Category": "event_category", "Severity": "severity", "Severity Name": "severity_name",
        "Is Critical": _flag("is_critical", "Critical", "Non-Critical"),
        "Hour of Day": "hour_of_day", "Day of Week": "day_of_week",
    }


_CRITICAL = "SUM(CASE WHEN is_critical THEN 1 ELSE 0 END)"


def _event_measures(noun: str) -> dict[str, str]:
    return {
        "Event Count": "COUNT(*)", "Critical Event Count": _CRITICAL,
        "Critical Event Rate": _share(_CRITICAL, "COUNT(*)"),
        f"Affected {noun} Count": f"COUNT(DISTINCT {noun.lower()}_id)",
        "Average Event Age (min)": "AVG(event_age_minutes)",
    }


def _place_measures(noun: str, prefix: str) -> dict[str, str]:
    return {
        f"{noun} Count": f"SUM({noun.lower()}_count)", "Average Value": f"AVG({prefix}_avg_value)",
        "Max Value": f"MAX({prefix}_max_value)", "Min Value": f"MIN({prefix}_min_value)",
        "P95 Value": f"AVG({prefix}_p95_value)", "Total Anomalies": "SUM(total_anomalies)",
        "Total Samples": "SUM(total_samples)",
        "Anomaly Rate": _share("SUM(total_anomalies)", "SUM(total_samples)"),
    }


def _kpi_measures(noun: str) -> dict[str, str]:
    return {
        f"{noun} Count": f"SUM({noun.lower()}_count)", "Hourly Average": "AVG(hourly_avg)",
        "Hourly Max": "MAX(hourly_max)", "Hourly P95": "AVG(hourly_p95)",
        "Total Anomalies": "SUM(hourly_anomalies)", "Total Events": "SUM(total_events)",
        "Critical Events": "SUM(critical_events)", f"Affected {noun}s": f"SUM(affected_{noun.lower()}s)",
    }


NETWORK_PERFORMANCE = MetricView(
    "network_performance", "network_performance_5min",
    {**_WINDOW, "Device ID": "device_id", "Device Type": "device_type", "Location": "location",
     "Vendor": "vendor", **_METRIC},
    {**_SAMPLES, **_DEVICES}, "Five-minute network measurements")
DEVICE_HEALTH = MetricView(
    "device_health", "device_health",
    {"Device ID": "device_id", "Device Type": "device_type", "Location": "location",
     "Health Status": "health_status", **_ATTENTION},
    _health_measures("Device", {
        "Average Latency": "AVG(current_latency_ms)", "Average Packet Loss": "AVG(current_packet_loss_pct)",
        "Average Throughput": "AVG(current_throughput_mbps)", "Average Jitter": "AVG(current_jitter_ms)",
        "Average Error Rate": "AVG(current_error_rate)"}, ""),
    "Device health scores and current measurements")
NETWORK_EVENTS = MetricView(
    "network_events", "network_events",
    _event_dimensions({"Device ID": "device_id", "Device Type": "device_type", "Location": "location"}),
    _event_measures("Device"), "Network log events")
GEOGRAPHIC_PERFORMANCE = MetricView(
    "geographic_performance", "metrics_by_location", {**_WINDOW, "Location": "location", **_METRIC},
    _place_measures("Device", "location"), "Network measurements by location")
NETWORK_KPI = MetricView(
    "network_kpi", "network_kpi_hourly", {"Hour": "hour_start", "Metric Name": "metric_name"},
    _kpi_measures("Device"), "Hourly network indicators")

STORE_PERFORMANCE = MetricView(
    "store_performance", "store_performance_5min",
    {**_WINDOW, **_STORE, "Store Type": "store_type", "Region": "region", "Brand": "brand",
     "District": "district", **_POINT, **_METRIC},
    {**_SAMPLES, **_STORES}, "Five-minute store measurements")
STORE_HEALTH = MetricView(
    "store_health", "store_health",
    {**_STORE, "Store Type": "store_type", "Region": "region", **_POINT,
     "Health Status": "health_status", **_ATTENTION},
    _health_measures("Store", {
        "Avg Hourly Sales": "AVG(current_hourly_sales)", "Avg Wait Time (sec)": "AVG(current_wait_time_sec)",
        "Avg Conversion Rate": "AVG(current_conversion_pct)",
        "Avg Return Rate": "AVG(current_return_rate_pct)"}, "Inventory Issues (1h)"),
    "Store health scores and current measurements")
STORE_EVENTS = MetricView(
    "store_events", "store_events", _event_dimensions({**_STORE, "Region": "region"}),
    _event_measures("Store"), "Store log events")
REGIONAL_PERFORMANCE = MetricView(
    "regional_performance", "metrics_by_region", {**_WINDOW, "Region": "region", **_METRIC},
    _place_measures("Store", "region"), "Store measurements by region")
RETAIL_KPI = MetricView(
    "retail_kpi", "retail_kpi_hourly", {"Hour": "hour_start", "Metric Name": "metric_name"},
    _kpi_measures("Store"), "Hourly store indicators")
SPEED_OF_SERVICE = MetricView(
    "speed_of_service", "store_performance_5min",
    {**_WINDOW, **_STORE, "Store Type": "store_type", "Region": "region", "Brand": "brand", **_POINT,
     "Metric Name": "metric_name", "Data Source": "data_source", "Sensor Type": "sensor_type",
     "Hour of Day": "HOUR(window_start)", "Time Period": _period_sql("HOUR(window_start)", SERVICE_PERIODS)},
    {**_SAMPLES, **_STORES, "Avg Order Value": "AVG(avg_order_value_context)",
     "Avg Item Count": "AVG(avg_item_count_context)"}, "Drive-through timings by part of the day")
EVENT_CAUSALITY = MetricView(
    "event_causality", "store_events",
    {"Event Timestamp": "event_timestamp", **_STORE, "Region": "region", "Event Type": "event_type",
     "Event Category": "event_category",
     "Is Hardware Event": _flag(_HARDWARE, "Hardware Failure", "Operational Issue"),
     "Severity": "severity", "Severity Name": "severity_name",
     "Is Critical": _flag("is_critical", "Critical", "Non-Critical"), "Hour of Day": "hour_of_day",
     "Time Period": _period_sql("hour_of_day", RUSH_PERIODS)},
    {"Event Count": "COUNT(*)", "Hardware Event Count": f"SUM(CASE WHEN {_HARDWARE} THEN 1 ELSE 0 END)",
     "Operational Event Count": f"SUM(CASE WHEN NOT ({_HARDWARE}) THEN 1 ELSE 0 END)",
     "Critical Event Count": _CRITICAL, "Critical Event Rate": _share(_CRITICAL, "COUNT(*)"),
     "Affected Store Count": "COUNT(DISTINCT store_id)", "Avg Event Age (min)": "AVG(event_age_minutes)",
     "Events Per Store": "COUNT(*) / NULLIF(COUNT(DISTINCT store_id), 0)"},
    "Hardware and operational events of restaurants")
ORDER_COMPLEXITY = MetricView(
    "order_complexity", "store_performance_5min",
    {"Time Window Start": "window_start", **_STORE, "Region": "region", "Brand": "brand",
     "Metric Name": "metric_name", "Order Size Category": _ORDER_SIZE,
     "Is Normalized": _flag("normalized", "Order-Normalized", "Raw Timing"),
     "Time Period": _period_sql("HOUR(window_start)", RUSH_PERIODS)},
    {"Average Timing (sec)": "AVG(avg_value)", "P95 Timing (sec)": "AVG(p95_value)",
     "Average Order Value": "AVG(avg_order_value_context)",
     "Average Item Count": "AVG(avg_item_count_context)", "Total Orders": "SUM(sample_count)", **_STORES,
     "Normalized vs Baseline Ratio": "AVG(CASE WHEN normalized THEN avg_value END)"
     " / NULLIF(AVG(CASE WHEN NOT normalized THEN avg_value END), 0)"},
    "Timings by order size")

VIEWS = Registry(
    NETWORK_PERFORMANCE, DEVICE_HEALTH, NETWORK_EVENTS, GEOGRAPHIC_PERFORMANCE, NETWORK_KPI,
    STORE_PERFORMANCE, STORE_HEALTH, STORE_EVENTS, REGIONAL_PERFORMANCE, RETAIL_KPI, SPEED_OF_SERVICE,
    EVENT_CAUSALITY, ORDER_COMPLEXITY)
