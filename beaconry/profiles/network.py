"""Network devices: routers, switches, firewalls, load balancers."""

from beaconry.functions.rules import Rule
from beaconry.profiles.base import Expectation, Penalty, Profile, Scoring

# ---------------------------------------------------------------------------
# Thresholds, codes and labels that results depend on.
# ---------------------------------------------------------------------------

SEVERITY_NAMES = {
    "Emergency": [0], "Alert": [1], "Critical": [2], "Error": [3],
    "Warning": [4], "Notice": [5], "Informational": [6], "Debug": [7],
}
CRITICAL_SEVERITY = 3

EVENT_CATEGORIES = {
    "interface_event": ["LINKUPDOWN", "IFDOWN", "IFUP"],
    "routing_event": ["ADJCHANGE", "OSPFADJCHG"],
    "security_event": ["SECURITY"],
    "availability_event": ["HASTATE"],
    "hardware_event": ["FANFAIL", "TEMPWARN"],
    "configuration_event": ["CFGCHANGE"],
}

ANOMALIES = [
    Rule("latency_ms", ">", 150), Rule("packet_loss_pct", ">", 3), Rule("throughput_mbps", ">", 9500),
    Rule("jitter_ms", ">", 40), Rule("error_rate", ">", 800),
]
MEDIUM = [
    Rule("latency_ms", ">", 100), Rule("packet_loss_pct", ">", 1), Rule("jitter_ms", ">", 20),
    Rule("error_rate", ">", 400),
]

UNITS_LIKE = [("%_ms", "milliseconds"), ("%_pct", "percent"), ("%_mbps", "megabits_per_second")]
UNITS_EXACT = {"count": ["error_rate"]}

REGION_PATTERNS = [("%east%", "east"), ("%west%", "west"), ("%central%", "central"),
                   ("%north%", "north"), ("%south%", "south")]
TIER_PATTERNS = [("%core%", "core"), ("%dist%", "distribution"), ("%access%", "access"),
                 ("%edge%", "edge")]

STATUS_BANDS = [(">=", 90, "Excellent"), (">=", 75, "Good"), (">=", 50, "Fair"), (">=", 25, "Poor")]

PENALTIES = [
    [Penalty("current_latency_ms", ">", 150, 30), Penalty("current_latency_ms", ">", 100, 15),
     Penalty("current_latency_ms", ">", 50, 5)],
    [Penalty("current_packet_loss_pct", ">", 3, 40), Penalty("current_packet_loss_pct", ">", 1, 20),
     Penalty("current_packet_loss_pct", ">", 0.5, 10)],
    [Penalty("current_jitter_ms", ">", 40, 20), Penalty("current_jitter_ms", ">", 20, 10)],
    [Penalty("critical_event_count_1h", ">", 10, 30), Penalty("critical_event_count_1h", ">", 5, 15),
     Penalty("critical_event_count_1h", ">", 0, 5)],
]
ATTENTION = [Rule("health_score", "<", 50), Rule("critical_event_count_1h", ">", 0)]

LOG_EXPECTATIONS = [
    Expectation("valid_priority", "priority BETWEEN 0 AND 191", drop=True),
    Expectation("valid_device_id", "hostname <> ''", drop=True),
    Expectation("valid_severity", "severity BETWEEN 0 AND 7"),
]
METRIC_EXPECTATIONS = [
    Expectation("valid_device_id", "device_id <> ''", drop=True),
    Expectation("valid_metric_name", "metric_name IS NOT NULL", drop=True),
    Expectation("valid_value", "value >= 0", drop=True),
]

# Type, then location, then a number: router-datacenter-east-007.
DEVICE_TYPE_PATTERN = r"^([^-]+)"
DEVICE_LOCATION_PATTERN = r"^[^-]+-(.+)-\d+$"

NETWORK = Profile(
    name="network",
    entity="device_id",
    entities="device",
    place="location",
    place_prefix="location",
    event_categories=EVENT_CATEGORIES,
    log_expectations=LOG_EXPECTATIONS,
    metric_expectations=METRIC_EXPECTATIONS,
    anomalies=ANOMALIES,
    severity_levels={"high": ANOMALIES, "medium": MEDIUM},
    units_like=UNITS_LIKE,
    units_exact=UNITS_EXACT,
    metric_columns={
        "device_id": "string", "device_type": "string", "location": "string", "vendor": "string",
        "model": "string", "ip_address": "string", "oid": "string", "metric_name": "string",
        "value": "double",
    },
    rollup_keys=["device_id", "device_type", "location", "vendor", "metric_name", "metric_unit"],
    health_metrics={
        "current_latency_ms": "latency_ms", "current_packet_loss_pct": "packet_loss_pct",
        "current_throughput_mbps": "throughput_mbps", "current_jitter_ms": "jitter_ms",
        "current_error_rate": "error_rate",
    },
    health_attributes=["device_type", "location"],
    recent_counts={},
    scoring={None: Scoring(PENALTIES, ATTENTION)},
    status_bands=STATUS_BANDS,
    status_otherwise="Critical",
    log_attributes={
        "device_type": f"nullif(regexp_extract(hostname, r'{DEVICE_TYPE_PATTERN}', 1), '')",
        "location": f"nullif(regexp_extract(hostname, r'{DEVICE_LOCATION_PATTERN}', 1), '')",
    },
)
