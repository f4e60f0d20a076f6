"""Declared row rules: drop, count, report, quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.profiles.base import Expectation


def holds(condition: str | Column) -> Column:
    """An undecided (NULL) condition counts as a violation."""
    column = F.expr(condition) if isinstance(condition, str) else condition
    return F.coalesce(column, F.lit(False))


def expect_or_drop(df: DataFrame, *conditions: str | Column) -> DataFrame:
    for condition in conditions:
        df = df.filter(holds(condition))
    return df


def expect(df: DataFrame, name: str, condition: str | Column) -> DataFrame:
    """Keep every row; a boolean column ``name`` tells whether the rule holds."""
    return df.withColumn(name, holds(condition))


def enforce(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Apply the dropping rules only."""
    return expect_or_drop(df, *[rule.condition for rule in rules if rule.drop])


def quarantine(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Rows that :func:`enforce` removes, with the names of the broken rules."""
    broken = F.concat_ws(
        ",", *[F.when(~holds(rule.condition), F.lit(rule.name)) for rule in rules if rule.drop]
    )
    return df.withColumn("violations", broken).filter(F.col("violations") != "")


def observe(df: DataFrame, rules: Sequence[Expectation], observation) -> DataFrame:
    """Attach violation counts to a batch or streaming run (``Observation`` or a name)."""
    counts = [F.count_if(~holds(rule.condition)).alias(rule.name) for rule in rules]
    return df.observe(observation, F.count(F.lit(1)).alias("total"), *counts)


def expectation_report(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """One row per rule; a single pass over the data."""
    wide = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(~holds(rule.condition)).alias(rule.name) for rule in rules],
    )
    policy = F.when(F.col("rule").isin([r.name for r in rules if r.drop]), "drop").otherwise("warn")
    return (
        wide.unpivot("total_rows", [rule.name for rule in rules], "rule", "violations")
        .select("rule", policy.alias("policy"), "total_rows", "violations",
                (F.col("total_rows") - F.col("violations")).alias("passed"))
    )


def window_quality(df: DataFrame, source: str, time: str, entity: str, alert: Column,
                   category: str, width: str = "5 minutes") -> DataFrame:
    """Per window: rows, distinct entities, alerts, distinct categories.

    Counts are first reduced to (window, entity, category); the two distinct counts
    then run over that small table instead of over copies of every row.
    """
    reduced = (
        df.groupBy(F.window(time, width).alias("w"), F.col(entity).alias("e"), F.col(category).alias("c"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(alert).alias("a"))
    )
    return reduced.groupBy("w").agg(
        F.sum("n").alias("total_records"),
        F.count_distinct("e").alias("unique_entities"),
        F.sum("a").alias("critical_events"),
        F.count_distinct("c").alias("event_categories"),
    ).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        F.lit(source).alias("source"), "total_records", "unique_entities", "critical_events",
        "event_categories",
    )


def data_quality_metrics(events: DataFrame, metrics: DataFrame, entity: str,
                         events_time: str = "processed_timestamp",
                         metrics_time: str = "processed_timestamp",
                         width: str = "5 minutes") -> DataFrame:
    """Quality counters of parsed logs and validated metrics, one row per window and source."""
    return window_quality(
        events, "events", events_time, "hostname", F.col("is_critical"), "event_category", width
    ).unionByName(window_quality(
        metrics, "metrics", metrics_time, entity, F.col("is_anomaly"), "metric_name", width
    ))
