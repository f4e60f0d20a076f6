"""Five-minute, place and hourly rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.functions.rules import bucket_label, first_case
from beaconry.profiles.base import Profile
from beaconry.profiles.retail import (
    DRIVE_THROUGH_GRADES, DRIVE_THROUGH_MEASURES, DRIVE_THROUGH_OTHER_GRADE, PEAK_PERIODS,
)

QUANTILES = (0.50, 0.95, 0.99)


def rollup_5min(metrics: DataFrame, profile: Profile, width: str = "5 minutes",
                watermark: str | None = None, approximate_files: bool = False,
                sketch: bool = False) -> DataFrame:
    """Statistics per window, entity and metric.

    The files of a group are few (those of one entity and window), so they are counted as a set
    beside the other statistics: a distinct count would first group by file, with sketches and all,
    and shuffle twice.  On a stream, or with ``approximate_files``, the count is a HyperLogLog
    estimate, whose state does not grow.  ``sketch`` adds a mergeable quantile sketch from which coarser rollups take true percentiles.
    """
    if watermark:
        metrics = metrics.withWatermark("event_timestamp", watermark)
    value, anomaly = F.col("value"), F.col("is_anomaly")
    aggregates = [
        F.avg(value).alias("avg_value"), F.min(value).alias("min_value"), F.max(value).alias("max_value"),
        F.percentile_approx(value, list(QUANTILES)).alias("quantiles"),
        F.stddev(value).alias("stddev_value"), F.count(F.lit(1)).alias("sample_count"),
        F.count_if(anomaly).alias("anomaly_count"),
        F.max(F.when(anomaly, value).otherwise(0.0)).alias("max_anomaly_value"),
    ]
    # First by time instead of FIRST: the same answer on every run.
    aggregates += [
        F.min_by(F.col(c), F.struct("event_timestamp", c)).alias(c) for c in profile.rollup_first
    ]
    aggregates += [F.avg(c).alias(name) for name, c in profile.rollup_averages.items()]
    aggregates += [F.max(c).alias(c) for c in profile.rollup_flags]
    if sketch:
        aggregates.append(F.kll_sketch_agg_double(value).alias("value_sketch"))
    if "source_file" in metrics.columns:
        approximate = approximate_files or metrics.isStreaming
        files = F.approx_count_distinct("source_file") if approximate else F.size(F.collect_set("source_file")).cast("long")
        aggregates.append(files.alias("source_file_count"))

    rolled = metrics.groupBy(F.window("event_timestamp", width).alias("w"), *profile.rollup_keys)
    rolled = rolled.agg(*aggregates)
    skipped = {"w", "quantiles", *profile.rollup_keys}
    return rolled.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *profile.rollup_keys,
        *[F.col("quantiles")[i].alias(name) for i, name in enumerate(("p50_value", "p95_value", "p99_value"))],
        *[c for c in rolled.columns if c not in skipped],
    )


def _second_level(prefix: str, entity: str, count: str) -> list:
    # COUNT(entity) counts entity-windows; the distinct count stands beside it.
    return [
        F.count(entity).alias(count),
        F.avg("avg_value").alias(f"{prefix}_avg_value"), F.max("max_value").alias(f"{prefix}_max_value"),
        F.min("min_value").alias(f"{prefix}_min_value"), F.avg("p95_value").alias(f"{prefix}_p95_value"),
        F.sum("anomaly_count").alias("total_anomalies"), F.sum("sample_count").alias("total_samples"),
    ]


def rollup_by_place(perf: DataFrame, profile: Profile, distinct: bool = True) -> DataFrame:
    """5-minute statistics by location or region."""
    aggregates = _second_level(profile.place_prefix, profile.entity, f"{profile.entities}_count")
    if distinct:
        aggregates.append(
            F.count_distinct(profile.entity).alias(f"distinct_{profile.entities}_count"))
    if "value_sketch" in perf.columns:
        merged = F.kll_merge_agg_double("value_sketch")
        aggregates.append(F.kll_sketch_get_quantile_double(merged, F.lit(0.95))
                          .alias(f"{profile.place_prefix}_true_p95_value"))
    keys = ["window_start", "window_end", profile.place, "metric_name", "metric_unit"]
    return perf.groupBy(*keys).agg(*aggregates)


def kpi_hourly(perf: DataFrame, events: DataFrame, profile: Profile) -> DataFrame:
    """Hourly metric statistics beside the hour's event counts."""
    measured = perf.groupBy(F.date_trunc("hour", "window_start").alias("hour_start"), "metric_name").agg(
        F.count(profile.entity).alias(f"{profile.entities}_count"),
        F.avg("avg_value").alias("hourly_avg"), F.max("max_value").alias("hourly_max"),
        F.avg("p95_value").alias("hourly_p95"), F.sum("anomaly_count").alias("hourly_anomalies"),
    )
    affected = f"affected_{profile.entities}s"
    happened = events.groupBy(F.date_trunc("hour", "event_timestamp").alias("hour_start")).agg(
        F.count(F.lit(1)).alias("total_events"), F.count_if("is_critical").alias("critical_events"),
        F.count_distinct(profile.entity).alias(affected),
    )
    return measured.join(happened, "hour_start", "left").fillna(
        0, ["total_events", "critical_events", affected])


def drive_through(perf: DataFrame) -> DataFrame:
    """Lane measures side by side per window and store, graded."""
    metrics = sorted({metric for metric, _ in DRIVE_THROUGH_MEASURES.values()})
    lanes = perf.filter((F.col("store_category") == "fast_food") & F.col("metric_name").isin(metrics))
    keys = ["window_start", "window_end", "store_id", "store_type", "region", "brand"]
    wide = lanes.groupBy(*keys).agg(
        *[F.min(c).alias(c) for c in ("latitude", "longitude")],
        *[F.max(F.when(F.col("metric_name") == metric, F.col(column))).alias(name)
          for name, (metric, column) in DRIVE_THROUGH_MEASURES.items()],
    )
    grades = [((F.col("avg_wait_time_sec") <= wait) & (F.col("avg_order_accuracy_pct") >= accuracy), grade)
              for wait, accuracy, grade in DRIVE_THROUGH_GRADES]
    return wide.withColumns({
        "time_period": bucket_label(F.hour("window_start"), *PEAK_PERIODS),
        "performance_grade": first_case(grades, DRIVE_THROUGH_OTHER_GRADE),
    })
