"""Everyday questions as queries of the semantic views.

Each function takes the view's source table.  They double as examples: any other question
of the kind (average or P95 by a dimension, top or bottom entities, threshold, comparison
of two values, trend, counts by status) is the same call with other names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from beaconry.semantic import views as v
from beaconry.semantic.model import MetricView


def metric_by(perf: DataFrame, view: MetricView, metric: str, place: str, count: str, limit: int = 10) -> DataFrame:
    """One metric by place, highest first."""
    return view.query(perf, ["Metric Name", place], ["Average Value", "Max Value", "Anomaly Count", count],
                      where=f"`Metric Name` = '{metric}'", order_by=["`Average Value` DESC", f"`{place}`"],
                      limit=limit)


def metric_summary(perf: DataFrame, view: MetricView, metric: str, by: Sequence[str]) -> DataFrame:
    return view.query(perf, by, {"avg_value": "Average Value", "p95_value": "P95 Value",
                                 "anomaly_pct": "Anomaly Rate"},
                      where=f"`Metric Name` = '{metric}'", order_by=["avg_value DESC", f"`{by[0]}`"])


def health_summary(health: DataFrame, view: MetricView, noun: str) -> DataFrame:
    return view.query(health, ["Health Status"],
                      [f"{noun} Count", "Average Health Score", "Critical Events (1h)",
                       f"{noun}s Needing Attention"],
                      order_by=["`Average Health Score`", "`Health Status`"])


def events_by_category(events: DataFrame, view: MetricView, noun: str, limit: int = 15) -> DataFrame:
    return view.query(events, ["Event Category", "Severity Name"],
                      ["Event Count", "Critical Event Count", f"Affected {noun} Count"],
                      order_by=["`Event Count` DESC", "`Event Category`", "`Severity Name`"], limit=limit)


def anomalies_by_place(by_place: DataFrame, view: MetricView, place: str, noun: str) -> DataFrame:
    return view.query(by_place, [place, "Metric Name"],
                      [f"{noun} Count", "Average Value", "Total Anomalies", "Anomaly Rate"],
                      order_by=[f"`{place}`", "`Metric Name`"])


def kpi_by_metric(kpi: DataFrame, view: MetricView) -> DataFrame:
    return view.query(kpi, ["Metric Name"], ["Hourly Average", "Hourly Max", "Total Anomalies", "Critical Events"],
                      order_by=["`Metric Name`"])


def service_by_period(perf: DataFrame, limit: int = 10) -> DataFrame:
    return v.SPEED_OF_SERVICE.query(
        perf, ["Time Period", "Brand"],
        {"Store Count": "Store Count", "avg_otd_seconds": "Average Value", "p95_otd_seconds": "P95 Value",
         "anomaly_pct": "Anomaly Rate"},
        order_by=["avg_otd_seconds DESC", "`Time Period`", "`Brand`"], limit=limit)


def event_causality(events: DataFrame, limit: int = 20) -> DataFrame:
    by = ["Event Type", "Is Hardware Event", "Severity Name", "Time Period"]
    return v.EVENT_CAUSALITY.query(
        events, by, ["Event Count", "Critical Event Count", "Affected Store Count", "Events Per Store"],
        where="`Store Category` = 'fast_food'", order_by=["`Event Count` DESC", *[f"`{d}`" for d in by]], limit=limit)


def order_size_timing(perf: DataFrame) -> DataFrame:
    return v.ORDER_COMPLEXITY.query(
        perf, ["Order Size Category", "Metric Name", "Time Period"],
        {"Store Count": "Store Count", "avg_seconds": "Average Timing (sec)",
         "avg_order_dollars": "Average Order Value", "avg_items": "Average Item Count",
         "Total Orders": "Total Orders"},
        where="`Metric Name` = 'drive_through_total_experience_time_sec' AND `Store Category` = 'fast_food'",
        order_by=["`Order Size Category`", "`Time Period`"])


def lowest_health(health: DataFrame, view: MetricView, entity: str, limit: int = 5) -> DataFrame:
    return view.query(health, [entity, "Health Status"], ["Min Health Score"],
                      order_by=["`Min Health Score`", f"`{entity}`"], limit=limit)


def places_above(perf: DataFrame, view: MetricView, metric: str, place: str, threshold: float) -> DataFrame:
    return view.query(perf, [place], ["Average Value"], where=f"`Metric Name` = '{metric}'",
                      having=f"`Average Value` > {threshold}", order_by=[f"`{place}`"])


def compare_places(perf: DataFrame, view: MetricView, metric: str, place: str, names: Sequence[str]) -> DataFrame:
    listed = ", ".join(f"'{n}'" for n in names)
    return view.query(perf, [place], ["Average Value", "P95 Value", "Anomaly Rate"],
                      where=f"`Metric Name` = '{metric}' AND `{place}` IN ({listed})", order_by=[f"`{place}`"])
