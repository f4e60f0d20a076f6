"""Explicit "now" and time arithmetic."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = Column | datetime | str


def as_of_column(as_of: AsOf) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def latest_time(df: DataFrame, column: str = "event_timestamp") -> Column:
    """Newest time in a table as a scalar subquery, usable as ``as_of``."""
    return df.agg(F.max(column)).scalar()


def event_age_minutes(as_of: AsOf, event_time: Column) -> Column:
    now = F.unix_timestamp(as_of_column(as_of))
    return (now - F.unix_timestamp(event_time)) / F.lit(60)


def micros(value: Column) -> Column:
    return F.unix_micros(value.cast("timestamp"))


def interval_micros(text: str) -> int:
    """``'5 minutes'`` to microseconds, on the driver."""
    units = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
             "hour": 3_600_000_000, "day": 86_400_000_000}
    amount, unit = text.split()
    return round(float(amount) * units[unit.rstrip("s")])
