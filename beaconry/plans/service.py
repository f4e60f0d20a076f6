"""Restaurant service questions: bottlenecks, incidents, order size, benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.functions.rules import first_case
from beaconry.operators.joins import windows_after
from beaconry.profiles.retail import (
    BENCHMARKS, HARDWARE_EVENTS, INCIDENT_EVENTS, INCIDENT_METRICS, ROOT_CAUSE_METRICS, ROOT_CAUSE_OTHER,
    ROOT_CAUSES,
)
from beaconry.semantic.views import ORDER_COMPLEXITY, SPEED_OF_SERVICE


def root_cause(perf: DataFrame, slowest_total: float = 360, limit: int | None = 20) -> DataFrame:
    """Which step holds up a store in a part of the day."""
    names = ", ".join(f"'{m}'" for m in ROOT_CAUSE_METRICS.values())
    steps = SPEED_OF_SERVICE.query(
        perf, ["Store ID", "Time Period", "Metric Name", "Sensor Type"], {"avg_time": "Average Value"},
        where=f"`Metric Name` IN ({names})")
    wide = steps.groupBy("Store ID", "Time Period").agg(*[
        F.max(F.when(F.col("Metric Name") == metric, F.col("avg_time"))).alias(name)
        for name, metric in ROOT_CAUSE_METRICS.items()])
    total = F.col("menu_board_sec") + F.col("kds_bump_sec") + F.col("window_sec")
    causes = [(F.col(step) > bound, cause) for step, bound, cause in ROOT_CAUSES]
    found = wide.withColumn("root_cause_diagnosis", first_case(causes, ROOT_CAUSE_OTHER)).filter(
        total > slowest_total).orderBy(total.desc(), "Store ID", "Time Period")
    return found.limit(limit) if limit is not None else found


def event_metric_correlation(events: DataFrame, perf: DataFrame, reach: str = "15 minutes") -> DataFrame:
    """Metrics of the windows that start within ``reach`` after a critical incident.

    An event is repeated for the three or four windows it reaches and counted per store,
    window and type, so it meets measurements by plain equality and as a weight.
    """
    incidents = events.filter(
        (F.col("store_category") == "fast_food") & F.col("event_type").isin(INCIDENT_EVENTS) & F.col("is_critical"))
    reached = windows_after(incidents.select("store_id", "event_timestamp", "event_type"), "event_timestamp", reach)
    minutes = F.expr("timestampdiff(MINUTE, event_timestamp, window_start)")
    weights = reached.groupBy("store_id", "window_start", "event_type").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(minutes).alias("_minutes"))
    measured = perf.filter((F.col("store_category") == "fast_food") & F.col("metric_name").isin(INCIDENT_METRICS))
    joined = measured.join(weights, ["store_id", "window_start"])
    return joined.groupBy("event_type", "metric_name").agg(
        F.count_distinct("store_id").alias("affected_stores"),
        (F.sum(F.col("avg_value") * F.col("_n")) / F.sum("_n")).alias("avg_metric_during_incident"),
        (F.sum("_minutes") / F.sum("_n")).alias("avg_minutes_after_event"),
        F.sum("_n").alias("incident_count"),
    ).orderBy("event_type", "metric_name")


def hardware_event_times(events: DataFrame, perf: DataFrame, reach: str = "15 minutes") -> DataFrame:
    """Average total time of stores after critical hardware events: per store first, then overall."""
    hardware = events.filter(F.col("event_type").isin(HARDWARE_EVENTS) & F.col("is_critical"))
    weights = windows_after(hardware.select("store_id", "event_timestamp", "event_type"), "event_timestamp", reach
                            ).groupBy("store_id", "window_start", "event_type").agg(F.count(F.lit(1)).alias("_n"))
    totals = perf.filter(F.col("metric_name") == "drive_through_total_experience_time_sec")
    per_store = totals.join(weights, ["store_id", "window_start"]).groupBy("store_id", "event_type").agg(
        (F.sum(F.col("avg_value") * F.col("_n")) / F.sum("_n")).alias("_avg"))
    return per_store.groupBy("event_type").agg(
        F.count_distinct("store_id").alias("affected_stores"), F.avg("_avg").alias("avg_otd_during_incident"),
    ).orderBy(F.desc("avg_otd_during_incident"), "event_type")


def order_assessment(perf: DataFrame, limit: int | None = 20) -> DataFrame:
    """Are slow stores slow because their orders are large?"""
    return ORDER_COMPLEXITY.query(
        perf, ["Store ID", "Brand"],
        {"avg_order_value": "Average Order Value", "avg_time": "Average Timing (sec)",
         "p95_time": "P95 Timing (sec)"},
        where="`Metric Name` = 'drive_through_total_experience_time_sec' AND `Store Category` = 'fast_food'"
              " AND `Is Normalized` = 'Order-Normalized'",
        having="`Average Timing (sec)` > 240",
        derive={"assessment": "CASE WHEN avg_order_value > 40 AND avg_time > 300 THEN 'ACCEPTABLE - Large Orders'"
                " WHEN avg_order_value < 20 AND avg_time > 300 THEN 'PROBLEM - Small Orders Slow'"
                " WHEN avg_time > 360 THEN 'CRITICAL - Review Operations' ELSE 'NORMAL' END"},
        order_by=["`Average Timing (sec)` DESC", "`Store ID`"], limit=limit)


def benchmark_gap(perf: DataFrame) -> DataFrame:
    """Timings by part of the day against the industry target of the metric."""
    wanted = ", ".join(f"'{m}'" for m in BENCHMARKS if m.endswith("_sec"))
    timings = SPEED_OF_SERVICE.query(
        perf, ["Time Period", "Metric Name"], {"avg_seconds": "Average Value", "p95_seconds": "P95 Value"},
        where=f"`Metric Name` IN ({wanted})")
    target = first_case([(F.col("Metric Name") == m, b) for m, b in BENCHMARKS.items()], None)
    return timings.withColumn("gap_from_industry_standard", F.col("avg_seconds") - target).orderBy(
        "Time Period", "Metric Name")
