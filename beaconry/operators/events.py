"""Event tables: de-duplication, ageing, recent counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.functions.time import AsOf, as_of_column, event_age_minutes
from beaconry.profiles.base import Profile


def dedup_events(parsed: DataFrame, profile: Profile, watermark: str | None = None) -> DataFrame:
    """One row per distinct event.

    Only business columns decide, so an event delivered again in a later batch is still a
    duplicate.  On a stream the same rule holds within the watermark.
    """
    category = profile.category
    attributes = [c for c in profile.log_attributes if c != category]
    events = parsed.select(
        "event_timestamp", F.col("hostname").alias(profile.entity),
        *([F.coalesce(F.col(category), F.lit("unknown")).alias(category)] if category else []),
        *attributes, "app_name", F.col("msg_id").alias("event_type"), "event_category", "severity",
        "severity_name", "is_critical", F.col("message").alias("event_message"), "structured_data",
    )
    if events.isStreaming:
        return (events.withWatermark("event_timestamp", watermark or "10 minutes")
                .dropDuplicatesWithinWatermark(events.columns))
    return events.distinct()


def with_store_region(events: DataFrame, stores: DataFrame) -> DataFrame:
    """Events with the region that the store dimension knows; a host name only hints at it.

    A store with several dimension rows takes the greatest region, so no event repeats.
    """
    regions = stores.groupBy(F.col("store_id").alias("_store")).agg(F.max("region").alias("_region"))
    joined = events.join(regions, F.col("store_id") == F.col("_store"), "left")
    return joined.withColumn("region", F.col("_region")).select(*events.columns)


def enrich_events(events: DataFrame, as_of: AsOf) -> DataFrame:
    return events.withColumns({
        "hour_of_day": F.hour("event_timestamp"),
        "day_of_week": F.dayofweek("event_timestamp"),
        "event_age_minutes": event_age_minutes(as_of, F.col("event_timestamp")),
    })


def recent_event_counts(events: DataFrame, profile: Profile, as_of: AsOf, last: str = "1 hour",
                        suffix: str = "1h") -> DataFrame:
    """Events of the trailing period per entity, in total, critical and per watched category."""
    keys = [profile.entity] + ([profile.category] if profile.category else [])
    recent = events.filter(F.col("event_timestamp") >= as_of_column(as_of) - F.expr(f"INTERVAL {last}"))
    return recent.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(f"event_count_{suffix}"),
        F.count_if("is_critical").alias(f"critical_event_count_{suffix}"),
        *[F.count_if(F.col("event_category") == category).alias(name)
          for name, category in profile.recent_counts.items()],
    )


def pane_keys(profile: Profile) -> list[str]:
    return ["window_start", "window_end", profile.entity, *([profile.category] if profile.category else [])]


def event_panes(events: DataFrame, profile: Profile, slide: str = "5 minutes") -> DataFrame:
    """Events per entity and pane: each event is counted in one."""
    keys = pane_keys(profile)[2:]
    counted = events.groupBy(F.window("event_timestamp", slide).alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("event_count"), F.count_if("is_critical").alias("critical_event_count"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys,
                          "event_count", "critical_event_count")


def sum_panes(panes: DataFrame, profile: Profile, width: str = "1 hour", slide: str = "5 minutes") -> DataFrame:
    """Sliding counts: a window is the sum of its panes, so rows are repeated per pane, not per event."""
    keys = pane_keys(profile)[2:]
    summed = panes.groupBy(F.window("window_start", width, slide).alias("w"), *keys).agg(
        F.sum("event_count").alias("event_count"), F.sum("critical_event_count").alias("critical_event_count"))
    return summed.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys,
                         "event_count", "critical_event_count")


def sliding_event_counts(events: DataFrame, profile: Profile, width: str = "1 hour",
                         slide: str = "5 minutes") -> DataFrame:
    """:func:`recent_event_counts` for every step of time: one row per entity and sliding window."""
    return sum_panes(event_panes(events, profile, slide), profile, width, slide)
