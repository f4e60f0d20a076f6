"""Metric records to validated measurements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from beaconry.functions.rules import any_metric_rule, first_case, like_label
from beaconry.operators.quality import enforce
from beaconry.profiles.base import Profile
from beaconry.profiles.retail import CATEGORY_PATTERNS


def type_metrics(df: DataFrame, profile: Profile, time: str = "timestamp") -> DataFrame:
    """All rows, typed and classified.  Columns the source lacks come out NULL."""
    present = {c.lower() for c in df.columns}

    def typed(name: str, dtype: str):
        column = F.col(name).try_cast(dtype) if name in present else F.lit(None).cast(dtype)
        return column.alias(name)

    stamp = F.col(time)
    if isinstance(df.schema[time].dataType, StringType):
        stamp = F.try_to_timestamp(stamp)
    passed = [c for c in ("ingestion_timestamp", "source_file", "processed_timestamp") if c in present]
    out = df.select(stamp.cast("timestamp").alias("event_timestamp"),
                    *[typed(n, t) for n, t in profile.metric_columns.items()], *passed)
    if profile.category:
        guess = like_label(F.col(profile.entity), CATEGORY_PATTERNS, "unknown")
        out = out.withColumn(profile.category, F.coalesce(F.col(profile.category), guess))

    metric, value = F.col("metric_name"), F.col("value")
    units = like_label(metric, profile.units_like, "unknown")
    exact = first_case([(metric.isin(*names), unit) for unit, names in profile.units_exact.items()], None)
    # LIKE patterns come first in both profiles, exact names only fill what they leave open.
    return out.withColumns({
        "is_anomaly": any_metric_rule(profile.anomalies, metric, value),
        "metric_unit": F.when(units != "unknown", units).otherwise(F.coalesce(exact, F.lit("unknown"))),
        "severity_level": first_case(
            [(any_metric_rule(rules, metric, value), level)
             for level, rules in profile.severity_levels.items()], "normal"),
    })


def validate_metrics(df: DataFrame, profile: Profile, time: str = "timestamp") -> DataFrame:
    """Typed measurements that satisfy the dropping rules.  Stateless: works on streams."""
    return enforce(type_metrics(df, profile, time), profile.metric_expectations)
