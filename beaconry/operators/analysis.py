"""Event impact, order complexity, time-of-day baseline, consistency, outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.functions.rules import band_label, first_case
from beaconry.operators.joins import ROWS_PER_PART, interval_join
from beaconry.profiles.retail import (
    EVENT_IMPACTS, HOUR_MULTIPLIERS, IMPACT_WINDOW_MINUTES, LANE_EFFICIENCY, LARGEST_ORDER_FACTOR,
    ORDER_FACTOR_SHARE, ORDER_FACTORS, TRANSIT_SECONDS,
)


def _literal_map(mapping: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def event_impact(samples: DataFrame, events: DataFrame,
                 impacts: Mapping[str, Mapping[str, float]] = EVENT_IMPACTS,
                 minutes: int = IMPACT_WINDOW_MINUTES, category: str | None = "fast_food",
                 rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Samples with ``impact_factor``: the product of what recent events do to the metric.

    An event counts while it is less than ``minutes`` old; severe and fresh events weigh
    more.  Only events of stores of ``category`` count (None: of all).  Equal events at one instant collapse to a power, equal sample times to one point,
    so a store's bucket holds distinct times only, and pairs are reduced where they are formed.
    """
    keys = ["store_id", "metric_name"]
    by_event = F.create_map(*[x for event, effect in impacts.items()
                              for x in (F.lit(event), _literal_map(effect))])
    known = events.filter(F.col("event_type").isin(list(impacts)))
    if category is not None:
        known = known.filter(F.col("store_category") == category)
    active = (known.groupBy("store_id", "event_type", "severity", F.col("event_timestamp").alias("_event_time"))
              .agg(F.count(F.lit(1)).alias("_n"))
              .select("store_id", "_event_time", "severity", "_n",
                      F.explode(by_event[F.col("event_type")]).alias("metric_name", "_impact")))
    points = samples.select(*keys, "event_timestamp").distinct()
    pairs = interval_join(points, active, keys, "event_timestamp", "_event_time",
                          before=f"{minutes} minutes", closed=(False, True), rows_per_part=rows_per_part)
    age = (F.unix_micros("event_timestamp") - F.unix_micros("_event_time")) / F.lit(60e6)
    severity = F.greatest(F.lit(0.0), (F.lit(6) - F.col("severity")) / F.lit(4.0))
    decay = F.greatest(F.lit(0.3), F.lit(1.0) - age / F.lit(float(minutes)) * F.lit(0.7))
    factor = F.pow(F.lit(1.0) + F.col("_impact") * severity * decay, F.col("_n"))
    factors = pairs.groupBy(*keys, "event_timestamp").agg(F.product(factor).alias("impact_factor"))
    return samples.join(factors, [*keys, "event_timestamp"], "left").fillna(1.0, ["impact_factor"])


def order_factor(order_value: Column) -> Column:
    """Time allowance by order value; NULL stays NULL."""
    return F.when(order_value.isNotNull(), band_label(order_value, ORDER_FACTORS, LARGEST_ORDER_FACTOR))


def normalize_timing(df: DataFrame) -> DataFrame:
    """``normalized_value``: lane timings without the allowance for large orders."""
    factor = order_factor(F.col("order_value"))
    share = first_case([(F.col("metric_name") == m, s) for m, s in ORDER_FACTOR_SHARE.items()], 0.0)
    allowance = F.lit(1.0) + (factor - 1.0) * share
    return df.withColumns({
        "complexity_factor": factor,
        "normalized_value": F.col("value") / F.coalesce(allowance, F.lit(1.0)),
    })


def hour_multiplier(hour: Column, grows_with_load: Column) -> Column:
    rising = first_case([(hour.isin(*hours), up) for hours, _, up in HOUR_MULTIPLIERS], 1.0)
    falling = first_case([(hour.isin(*hours), down) for hours, down, _ in HOUR_MULTIPLIERS], 1.0)
    return F.when(grows_with_load, rising).otherwise(falling)


def deseasonalize(df: DataFrame, negative_metrics: Sequence[str], time: str = "event_timestamp") -> DataFrame:
    """Value without the usual effect of the hour.  Only restaurants have that effect."""
    multiplier = F.when(
        F.col("store_category") == "fast_food",
        hour_multiplier(F.hour(time), ~F.col("metric_name").isin(list(negative_metrics))),
    ).otherwise(1.0)
    return df.withColumns({"hour_multiplier": multiplier, "deseasonalized_value": F.col("value") / multiplier})


def timing_consistency(perf: DataFrame) -> DataFrame:
    """Does the measured total agree with its parts, and the throughput with the total?"""
    parts = {
        "menu_sec": "drive_through_menu_board_time_sec", "kitchen_sec": "drive_through_kds_bump_time_sec",
        "window_sec": "drive_through_window_time_sec",
        "total_sec": "drive_through_total_experience_time_sec",
        "cars_per_hour": "drive_through_cars_per_hour",
    }
    wide = perf.filter(F.col("metric_name").isin(list(parts.values()))).groupBy(
        "window_start", "store_id").agg(
        *[F.max(F.when(F.col("metric_name") == metric, F.col("avg_value"))).alias(name)
          for name, metric in parts.items()])

    def expected(transit: float) -> Column:
        lane = F.col("menu_sec") + F.lit(transit)
        return lane + F.col("window_sec") + F.greatest(F.lit(0.0), F.col("kitchen_sec") - lane)

    low, high = (expected(t) for t in TRANSIT_SECONDS)
    per_hour = F.lit(3600.0) / F.nullif(F.col("total_sec"), F.lit(0.0))
    slow, fast = (per_hour * share for share in LANE_EFFICIENCY)
    return wide.withColumns({
        "expected_total_low": low, "expected_total_high": high,
        "total_consistent": F.col("total_sec").between(low, high),
        "throughput_consistent": F.col("cars_per_hour").between(slow, fast),
    })


def zscore_flag(df: DataFrame, keys: Sequence[str], k: float = 3.0, value: str = "value") -> DataFrame:
    """``zscore`` and ``is_outlier`` against mean and deviation of the key.

    The statistics combine before the shuffle and come back by join; a window over the key
    would move and sort all its rows in one task.
    """
    stats = df.groupBy(*keys).agg(F.avg(value).alias("_mean"), F.stddev(value).alias("_sd"))
    score = (F.col(value) - F.col("_mean")) / F.nullif(F.col("_sd"), F.lit(0.0))
    return (df.join(stats, list(keys), "left").withColumn("zscore", score)
            .withColumn("is_outlier", F.coalesce(F.abs("zscore") > k, F.lit(False)))
            .drop("_mean", "_sd"))
