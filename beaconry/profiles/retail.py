"""Shops and restaurants, with drive-through lanes."""

from beaconry.functions.rules import Rule
from beaconry.profiles.base import Expectation, Penalty, Profile, Scoring
from beaconry.profiles.network import STATUS_BANDS

# ---------------------------------------------------------------------------
# Thresholds, codes and labels that results depend on.
# ---------------------------------------------------------------------------

EVENT_CATEGORIES = {
    "sales": ["TRANSACTION"],
    "checkout_issue": ["PAYMENT_DECLINED", "POS_ERROR", "CHECKOUT_TIMEOUT", "KIOSK_ERROR"],
    "returns": ["REFUND"],
    "inventory": ["INVENTORY_LOW", "STOCKOUT"],
    "security": ["THEFT_ALERT"],
    "loyalty": ["LOYALTY_SIGNUP"],
    "pricing": ["PRICE_OVERRIDE"],
    "drive_through": ["DRIVE_THROUGH_TIMEOUT", "ORDER_COMPLETE", "ORDER_DELAYED"],
    "kitchen_ops": ["EQUIPMENT_FAILURE"],
    "food_safety": ["FOOD_SAFETY_ALERT"],
    "mobile_order": ["MOBILE_ORDER_READY", "ONLINE_PICKUP_READY"],
    "customer_service": ["WRONG_ORDER_REPORTED"],
    "fitting_room": ["FITTING_ROOM_WAIT"],
}

HARDWARE_EVENTS = ["LOOP_SENSOR_MALFUNCTION", "KDS_SCREEN_DOWN", "POS_NETWORK_TIMEOUT",
                   "BUMP_BAR_STUCK", "HME_SYSTEM_REBOOT"]
# Two wider lists used by the correlation and the cluster report.
INCIDENT_EVENTS = ["EQUIPMENT_FAILURE", "KDS_SCREEN_DOWN", "LOOP_SENSOR_MALFUNCTION",
                   "POS_NETWORK_TIMEOUT", "HME_SYSTEM_REBOOT"]
INCIDENT_METRICS = ["drive_through_total_experience_time_sec", "drive_through_kds_bump_time_sec",
                    "drive_through_window_time_sec", "drive_through_cars_per_hour"]

ANOMALIES = [
    Rule("hourly_sales", ">", 22000), Rule("checkout_wait_time_sec", ">", 300),
    Rule("conversion_rate_pct", ">", 40), Rule("return_rate_pct", ">", 12),
    Rule("customer_traffic", ">", 1800), Rule("fitting_room_usage_pct", ">", 80),
    Rule("online_pickup_rate_pct", ">", 35), Rule("drive_through_wait_time_sec", ">", 420),
    Rule("drive_through_order_accuracy_pct", "<", 90), Rule("speaker_to_window_time_sec", ">", 270),
    Rule("kitchen_ticket_time_sec", ">", 540), Rule("peak_hour_service_time_sec", ">", 650),
    Rule("food_waste_pct", ">", 20), Rule("mobile_order_pickup_time_sec", ">", 220),
]
HIGH = [
    Rule("checkout_wait_time_sec", ">", 300), Rule("return_rate_pct", ">", 12),
    Rule("drive_through_wait_time_sec", ">", 420), Rule("drive_through_order_accuracy_pct", "<", 88),
    Rule("food_waste_pct", ">", 20),
]
MEDIUM = [
    Rule("checkout_wait_time_sec", ">", 180), Rule("return_rate_pct", ">", 8),
    Rule("drive_through_wait_time_sec", ">", 300), Rule("drive_through_order_accuracy_pct", "<", 92),
    Rule("kitchen_ticket_time_sec", ">", 420),
]

UNITS_LIKE = [("%_pct", "percent"), ("%_sec", "seconds")]
UNITS_EXACT = {
    "dollars": ["hourly_sales", "avg_basket_size", "avg_order_value"],
    "count": ["customer_traffic", "transactions_per_hour"],
    "cars_per_hour": ["drive_through_throughput_per_hour"],
    "tables_per_hour": ["dine_in_table_turnover_rate"],
    "dollars_per_staff": ["staff_productivity"],
}

CATEGORY_PATTERNS = [("%ff%", "fast_food"), ("%ap%", "apparel")]

STORE_TIERS = {
    ("apparel", "flagship"): "tier1", ("apparel", "mall"): "tier2",
    ("apparel", "outlet"): "tier3", ("apparel", "express"): "tier4",
    ("fast_food", "flagship_restaurant"): "tier1", ("fast_food", "drive_through"): "tier2",
    ("fast_food", "dine_in"): "tier2", ("fast_food", "express_counter"): "tier3",
    ("fast_food", "food_court"): "tier4",
}
OTHER_TIER = "tier4"

LOG_EXPECTATIONS = [
    Expectation("valid_priority", "priority BETWEEN 0 AND 191", drop=True),
    Expectation("valid_store_id", "hostname <> ''", drop=True),
    Expectation("valid_severity", "severity BETWEEN 0 AND 7"),
]


def _when(name: str, metric: str, condition: str) -> Expectation:
    return Expectation(name, f"metric_name <> '{metric}' OR ({condition})")


METRIC_EXPECTATIONS = [
    Expectation("valid_store_id", "store_id <> ''", drop=True),
    Expectation("valid_metric_name", "metric_name IS NOT NULL", drop=True),
    Expectation("valid_value", "value >= 0", drop=True),
    _when("valid_sales", "hourly_sales", "value <= 100000"),
    _when("valid_conversion", "conversion_rate_pct", "value BETWEEN 0 AND 100"),
    _when("valid_wait_time", "checkout_wait_time_sec", "value <= 1800"),
    _when("valid_return_rate", "return_rate_pct", "value BETWEEN 0 AND 100"),
    _when("valid_drive_through_wait", "drive_through_wait_time_sec", "value <= 600"),
    _when("valid_accuracy_pct", "drive_through_order_accuracy_pct", "value BETWEEN 0 AND 100"),
    _when("valid_waste_pct", "food_waste_pct", "value BETWEEN 0 AND 100"),
    _when("valid_fitting_room", "fitting_room_usage_pct", "value BETWEEN 0 AND 100"),
    _when("valid_pickup_rate", "online_pickup_rate_pct", "value BETWEEN 0 AND 100"),
]

APPAREL = Scoring(
    penalties=[
        [Penalty("current_wait_time_sec", ">", 300, 30), Penalty("current_wait_time_sec", ">", 180, 15),
         Penalty("current_wait_time_sec", ">", 120, 5)],
        [Penalty("current_return_rate_pct", ">", 12, 25), Penalty("current_return_rate_pct", ">", 8, 15),
         Penalty("current_return_rate_pct", ">", 5, 5)],
        [Penalty("critical_event_count_1h", ">", 10, 30), Penalty("critical_event_count_1h", ">", 5, 15),
         Penalty("critical_event_count_1h", ">", 0, 5)],
        [Penalty("inventory_issues_1h", ">", 5, 15), Penalty("inventory_issues_1h", ">", 2, 10)],
    ],
    status_penalties=[
        [Penalty("current_wait_time_sec", ">", 300, 30)],
        [Penalty("current_return_rate_pct", ">", 12, 25)],
        [Penalty("critical_event_count_1h", ">", 10, 30)],
    ],
    attention=[
        Rule("critical_event_count_1h", ">", 0), Rule("inventory_issues_1h", ">", 3),
        Rule("security_issues_1h", ">", 0), Rule("current_wait_time_sec", ">", 300),
        Rule("current_return_rate_pct", ">", 12),
    ],
)
FAST_FOOD = Scoring(
    penalties=[
        [Penalty("current_dt_wait_time_sec", ">", 420, 30), Penalty("current_dt_wait_time_sec", ">", 300, 15),
         Penalty("current_dt_wait_time_sec", ">", 200, 5)],
        [Penalty("current_dt_accuracy_pct", "<", 88, 25), Penalty("current_dt_accuracy_pct", "<", 92, 15),
         Penalty("current_dt_accuracy_pct", "<", 95, 5)],
        [Penalty("current_kitchen_time_sec", ">", 540, 20), Penalty("current_kitchen_time_sec", ">", 420, 10),
         Penalty("current_kitchen_time_sec", ">", 300, 5)],
        [Penalty("food_safety_issues_1h", ">", 0, 30), Penalty("kitchen_issues_1h", ">", 3, 15),
         Penalty("drive_through_issues_1h", ">", 5, 10)],
        [Penalty("current_food_waste_pct", ">", 20, 10), Penalty("current_food_waste_pct", ">", 15, 5)],
    ],
    status_penalties=[
        [Penalty("current_dt_wait_time_sec", ">", 420, 30)],
        [Penalty("current_dt_accuracy_pct", "<", 88, 25)],
        [Penalty("food_safety_issues_1h", ">", 0, 30)],
    ],
    attention=[
        Rule("food_safety_issues_1h", ">", 0), Rule("kitchen_issues_1h", ">", 3),
        Rule("current_dt_wait_time_sec", ">", 420), Rule("current_dt_accuracy_pct", "<", 88),
        Rule("current_food_waste_pct", ">", 20),
    ],
)
OTHER_SCORE = 50

# Drive-through table: output column -> (metric, 5-minute column).
DRIVE_THROUGH_MEASURES = {
    "avg_wait_time_sec": ("drive_through_wait_time_sec", "avg_value"),
    "p95_wait_time_sec": ("drive_through_wait_time_sec", "p95_value"),
    "avg_throughput_per_hour": ("drive_through_throughput_per_hour", "avg_value"),
    "avg_order_accuracy_pct": ("drive_through_order_accuracy_pct", "avg_value"),
    "avg_speaker_to_window_sec": ("speaker_to_window_time_sec", "avg_value"),
    "p95_speaker_to_window_sec": ("speaker_to_window_time_sec", "p95_value"),
    "avg_mobile_pickup_sec": ("mobile_order_pickup_time_sec", "avg_value"),
    "avg_peak_service_time_sec": ("peak_hour_service_time_sec", "avg_value"),
}
# (longest wait, lowest accuracy, grade), first match wins.
DRIVE_THROUGH_GRADES = [(180, 95, "Excellent"), (300, 90, "Good"), (420, 85, "Fair")]
DRIVE_THROUGH_OTHER_GRADE = "Needs_Improvement"

# Four vocabularies for the hour of day; each report keeps its own.
PEAK_PERIODS = ([(11, 13, "lunch_peak"), (17, 19, "dinner_peak"), (6, 9, "breakfast_peak")], "off_peak")
SERVICE_PERIODS = ([(11, 13, "Lunch Rush"), (17, 19, "Dinner Rush"), (7, 10, "Breakfast"),
                    (14, 16, "Off-Peak Afternoon"), (20, 22, "Off-Peak Evening")], "Overnight")
RUSH_PERIODS = ([(11, 13, "Lunch Rush"), (17, 19, "Dinner Rush")], "Off-Peak")
MAP_PERIODS = ([(6, 9, "Breakfast (6-9 AM)"), (11, 13, "Lunch (11-1 PM)"), (17, 19, "Dinner (5-7 PM)")],
               "Off-Peak")

ORDER_SIZES = [("<", 15, "Small ($8-15)"), ("<", 30, "Medium ($15-30)"), ("<", 50, "Large ($30-50)")]
LARGEST_ORDER = "Mega ($50+)"

ROOT_CAUSES = [("menu_board_sec", 60, "Menu Board Issue - Train Staff"),
               ("kds_bump_sec", 80, "Kitchen Production Issue"),
               ("window_sec", 90, "Window Bottleneck")]
ROOT_CAUSE_OTHER = "Peak Hour Volume"
ROOT_CAUSE_METRICS = {
    "menu_board_sec": "drive_through_menu_board_time_sec",
    "kds_bump_sec": "drive_through_kds_bump_time_sec",
    "window_sec": "drive_through_window_time_sec",
}

BENCHMARKS = {
    "drive_through_total_experience_time_sec": 270.0, "drive_through_menu_board_time_sec": 25.0,
    "drive_through_window_time_sec": 50.0, "drive_through_kds_bump_time_sec": 40.0,
    "drive_through_cars_per_hour": 100.0,
}

MAP_CATEGORIES = [(">=", 90, "Excellent"), (">=", 70, "Good"), (">=", 50, "Fair")]
DENSITY_BANDS = [(">=", 5, "Oversaturated"), (">=", 3, "Competitive"), (">=", 1, "Normal")]
PRESSURE_BANDS = [("<", 1, "High Pressure (<1km)"), ("<", 3, "Medium Pressure (1-3km)"),
                  ("<", 10, "Low Pressure (3-10km)")]

# Relative change of a metric while an event is active.
EVENT_IMPACTS = {
    "LOOP_SENSOR_MALFUNCTION": {"drive_through_total_experience_time_sec": 0.40,
                                "drive_through_cars_per_hour": -0.25},
    "KDS_SCREEN_DOWN": {"drive_through_kds_bump_time_sec": 0.80,
                        "drive_through_total_experience_time_sec": 0.60,
                        "drive_through_order_accuracy_pct": -0.15},
    "POS_NETWORK_TIMEOUT": {"drive_through_window_time_sec": 0.70,
                            "drive_through_total_experience_time_sec": 0.50,
                            "transactions_per_hour": -0.30},
    "BUMP_BAR_STUCK": {"drive_through_kds_bump_time_sec": 0.50, "drive_through_window_time_sec": 0.30},
    "HME_SYSTEM_REBOOT": {"drive_through_total_experience_time_sec": 0.90,
                          "drive_through_cars_per_hour": -0.60},
    "EQUIPMENT_FAILURE": {"drive_through_kds_bump_time_sec": 0.70,
                          "drive_through_total_experience_time_sec": 0.60,
                          "drive_through_window_time_sec": 0.40, "drive_through_cars_per_hour": -0.40},
    "INVENTORY_LOW": {"drive_through_menu_board_time_sec": 0.40, "drive_through_kds_bump_time_sec": 0.30,
                      "hourly_sales": -0.25, "customer_traffic": -0.10},
    "FOOD_SAFETY_ALERT": {"hourly_sales": -0.40, "customer_traffic": -0.30,
                          "drive_through_cars_per_hour": -0.35},
    "WRONG_ORDER_REPORTED": {"drive_through_order_accuracy_pct": -0.10,
                             "drive_through_window_time_sec": 0.25},
    "DRIVE_THROUGH_TIMEOUT": {"drive_through_total_experience_time_sec": 0.35,
                              "drive_through_window_time_sec": 0.40, "drive_through_cars_per_hour": -0.25},
    "KIOSK_ERROR": {"transactions_per_hour": -0.15, "customer_traffic": -0.08},
    "ORDER_DELAYED": {"drive_through_kds_bump_time_sec": 0.30,
                      "drive_through_total_experience_time_sec": 0.25},
}
IMPACT_WINDOW_MINUTES = 15

# Hours -> (multiplier of metrics that get worse with load, of those that grow with it).
HOUR_MULTIPLIERS = [
    ((11, 12), 1.5, 1.4), ((13,), 1.3, 1.2), ((17, 18), 1.4, 1.3), ((19,), 1.2, 1.1),
    ((14, 15, 16, 20, 21), 0.8, 0.9), ((22, 23, 0, 1, 2, 3, 4, 5, 6), 0.6, 0.7),
    ((7, 8, 9, 10), 1.1, 1.05),
]
# Metrics where less is better; they rise with load.
NEGATIVE_METRICS = ["drive_through_total_experience_time_sec", "drive_through_menu_board_time_sec",
                    "drive_through_window_time_sec", "drive_through_kds_bump_time_sec",
                    "peak_hour_service_time_sec", "mobile_order_pickup_time_sec", "food_waste_pct"]
# Order value below -> time allowance; the share of it each step gets.
ORDER_FACTORS = [("<", 15, 1.0), ("<", 30, 1.2), ("<", 50, 1.5)]
LARGEST_ORDER_FACTOR = 1.8
ORDER_FACTOR_SHARE = {"drive_through_menu_board_time_sec": 0.5, "drive_through_kds_bump_time_sec": 1.0,
                      "drive_through_window_time_sec": 0.7}
TRANSIT_SECONDS = (30.0, 60.0)
LANE_EFFICIENCY = (0.60, 0.80)

RETAIL = Profile(
    name="retail",
    entity="store_id",
    entities="store",
    place="region",
    place_prefix="region",
    category="store_category",
    event_categories=EVENT_CATEGORIES,
    log_expectations=LOG_EXPECTATIONS,
    metric_expectations=METRIC_EXPECTATIONS,
    anomalies=ANOMALIES,
    severity_levels={"high": HIGH, "medium": MEDIUM},
    units_like=UNITS_LIKE,
    units_exact=UNITS_EXACT,
    metric_columns={
        "store_id": "string", "store_category": "string", "store_type": "string", "region": "string",
        "brand": "string", "district": "string", "address": "string", "latitude": "double",
        "longitude": "double", "oid": "string", "metric_name": "string", "value": "double",
        "data_source": "string", "sensor_type": "string", "order_value": "double",
        "item_count": "int", "normalized": "boolean",
    },
    rollup_keys=["store_id", "store_category", "store_type", "region", "brand", "district",
                 "metric_name", "metric_unit"],
    rollup_first=["latitude", "longitude", "data_source", "sensor_type"],
    rollup_averages={"avg_order_value_context": "order_value", "avg_item_count_context": "item_count"},
    rollup_flags=["normalized"],
    health_metrics={
        "current_hourly_sales": "hourly_sales", "current_transactions": "transactions_per_hour",
        "current_traffic": "customer_traffic", "current_basket_size": "avg_basket_size",
        "current_wait_time_sec": "checkout_wait_time_sec",
        "current_conversion_pct": "conversion_rate_pct",
        "current_return_rate_pct": "return_rate_pct", "current_order_value": "avg_order_value",
        "current_dt_wait_time_sec": "drive_through_wait_time_sec",
        "current_dt_accuracy_pct": "drive_through_order_accuracy_pct",
        "current_kitchen_time_sec": "kitchen_ticket_time_sec",
        "current_food_waste_pct": "food_waste_pct",
    },
    health_attributes=["store_category", "store_type", "region"],
    recent_counts={
        "inventory_issues_1h": "inventory", "checkout_issues_1h": "checkout_issue",
        "security_issues_1h": "security", "drive_through_issues_1h": "drive_through",
        "kitchen_issues_1h": "kitchen_ops", "food_safety_issues_1h": "food_safety",
    },
    scoring={"apparel": APPAREL, "fast_food": FAST_FOOD},
    status_bands=STATUS_BANDS,
    status_otherwise="Critical",
    log_attributes={
        "region": "nullif(regexp_extract(hostname, r'^store-([^-]+)', 1), '')",
        "store_category":
            "nullif(regexp_extract(structured_data, r'storeCategory=\"([^\"]+)\"', 1), '')",
    },
)
