"""Log lines to typed events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.functions.rules import code_label
from beaconry.functions.syslog import syslog_fields, with_parts
from beaconry.operators.quality import enforce
from beaconry.profiles.base import Profile
from beaconry.profiles.network import CRITICAL_SEVERITY, SEVERITY_NAMES


def read_fields(df: DataFrame, profile: Profile, value: str = "value") -> DataFrame:
    """All rows with their parsed columns; rows that are no RFC 5424 line get NULLs."""
    kept = [c for c in df.columns if c != value]
    parsed = with_parts(df, value).select(*kept, F.col(value).alias("raw_message"), *[
        column.alias(name) for name, column in syslog_fields().items()
    ])
    parsed = parsed.withColumns({
        "facility": F.floor(F.col("priority") / 8).cast("int"),
        "severity": F.col("priority") % 8,
        "event_timestamp": F.col("log_timestamp").try_cast("timestamp"),
        "event_category": F.when(
            F.col("msg_id").isNotNull(), code_label(F.col("msg_id"), profile.event_categories, "other")
        ),
        **{name: F.expr(sql) for name, sql in profile.log_attributes.items()},
    })
    return parsed.withColumns({
        "severity_name": code_label(F.col("severity"), SEVERITY_NAMES, "Unknown"),
        "is_critical": F.col("severity") <= CRITICAL_SEVERITY,
    })


def parse_log(df: DataFrame, profile: Profile, value: str = "value") -> DataFrame:
    """Events of the profile, unusable lines removed.  Stateless: works on streams."""
    return enforce(read_fields(df, profile, value), profile.log_expectations)
