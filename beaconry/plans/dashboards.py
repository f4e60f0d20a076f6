"""Network dashboard and latency-benchmark queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.functions.time import AsOf, as_of_column


def _within(column: str, as_of: AsOf, last: str) -> Column:
    return F.col(column) >= as_of_column(as_of) - F.expr(f"INTERVAL {last}")


def total_devices(health: DataFrame) -> DataFrame:
    return health.agg(F.count_distinct("device_id").alias("total_devices"))


def critical_devices(health: DataFrame) -> DataFrame:
    return health.filter(F.col("health_status") == "Critical").agg(F.count(F.lit(1)).alias("critical_devices"))


def average_health(health: DataFrame, digits: int = 1) -> DataFrame:
    return health.agg(F.round(F.avg("health_score"), digits).alias("avg_health_score"))


def distribution(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), *columns)


def location_summary(health: DataFrame, digits: int = 1) -> DataFrame:
    return health.groupBy("location").agg(
        F.count(F.lit(1)).alias("devices"), F.round(F.avg("health_score"), digits).alias("avg_health"),
        F.sum("critical_event_count_1h").alias("critical_events")).orderBy("avg_health", "location")


def attention_list(health: DataFrame, limit: int = 50) -> DataFrame:
    wanted = F.col("requires_attention") | F.col("health_status").isin("Critical", "Poor")
    return health.filter(wanted).select(
        "device_id", "device_type", "location", "health_status", "health_score",
        F.col("current_latency_ms").alias("latency_ms"), F.col("current_packet_loss_pct").alias("packet_loss_pct"),
    ).orderBy("health_score", "device_id", "location").limit(limit)


def metric_trend(perf: DataFrame, metric: str, by: str, name: str, as_of: AsOf, last: str = "6 hours",
                 digits: int = 2) -> DataFrame:
    recent = perf.filter((F.col("metric_name") == metric) & _within("window_start", as_of, last))
    return recent.groupBy("window_start", by).agg(F.round(F.avg("avg_value"), digits).alias(name)).orderBy(
        "window_start", by)


def critical_events(events: DataFrame, as_of: AsOf, last: str = "24 hours", limit: int = 100) -> DataFrame:
    recent = events.filter(F.col("is_critical") & _within("event_timestamp", as_of, last))
    columns = ["event_timestamp", "device_id", "location", "severity_name", "event_message"]
    return recent.select(*columns).orderBy(F.desc("event_timestamp"), *columns[1:]).limit(limit)


def recent_distribution(events: DataFrame, column: str, as_of: AsOf, last: str = "24 hours") -> DataFrame:
    return distribution(events.filter(_within("event_timestamp", as_of, last)), column)


def live_averages(metrics: DataFrame, as_of: AsOf, kind: str = "device_type", place: str = "location",
                  last: str = "5 minutes") -> DataFrame:
    """Averages of the last minutes by type and place."""
    return metrics.filter(_within("event_timestamp", as_of, last)).groupBy(kind, place).agg(
        F.avg("value").alias("avg_value"))


def problem_entities(health: DataFrame, entity: str = "device_id", below: int = 50, limit: int = 100) -> DataFrame:
    return health.filter(F.col("health_score") < below).select(
        entity, "health_score", F.col("critical_event_count_1h").alias("critical_events"),
    ).orderBy("health_score", entity).limit(limit)


def todays_hours(perf: DataFrame, as_of: AsOf) -> DataFrame:
    """Hourly average and maximum of every metric since midnight."""
    today = perf.filter(F.col("window_start") >= F.date_trunc("day", as_of_column(as_of)))
    return today.groupBy(F.date_trunc("hour", "window_start").alias("hour"), "metric_name").agg(
        F.avg("avg_value").alias("avg_value"), F.max("max_value").alias("max_value")).orderBy("hour", "metric_name")
