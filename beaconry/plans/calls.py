"""Call records against network health: quality, sessions, subscribers, nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.functions.rules import first_case, like_label
from beaconry.functions.time import AsOf, as_of_column
from beaconry.operators.joins import ROWS_PER_PART, enrich, interval_join, interval_sums, window_containment_join
from beaconry.profiles.network import REGION_PATTERNS


def with_event_time(df: DataFrame, *columns: str) -> DataFrame:
    """Shared tables carry ISO strings; cast once at load."""
    return df.withColumns({c: F.col(c).try_cast("timestamp") for c in columns})


def _rounded(column: Column, digits: int, rounded: bool) -> Column:
    return F.round(column, digits) if rounded else column


def _rate(hits: Column, total: Column) -> Column:
    return hits * F.lit(100.0) / total


def _health_columns(health: DataFrame) -> DataFrame:
    return health.select(
        "device_id", F.col("current_latency_ms").alias("device_latency_ms"),
        F.col("current_packet_loss_pct").alias("device_packet_loss"),
        F.col("current_jitter_ms").alias("device_jitter_ms"),
        F.col("health_score").alias("device_health_score"),
        F.col("health_status").alias("device_health_status"),
        F.col("event_count_1h").alias("device_events_1h"),
        F.col("critical_event_count_1h").alias("device_critical_events_1h"))


def _device_context(devices: DataFrame, health: DataFrame) -> DataFrame:
    """Device attributes with their health.  Both are one row per device, so joining them first
    leaves a single join for the calls."""
    attributes = devices.select("device_id", "location", "device_type", "vendor", "model", "device_tier")
    return enrich(attributes, _health_columns(health), ["device_id"], "left")


def call_quality(calls: DataFrame, devices: DataFrame, health: DataFrame) -> DataFrame:
    """Calls with their device and its current health."""
    renamed = calls.withColumnsRenamed({
        "mos_score": "call_mos_score", "jitter_ms": "call_jitter_ms", "packet_loss_pct": "call_packet_loss",
        "originating_device_id": "device_id", "originating_location": "location"})
    joined = enrich(renamed, _device_context(devices, health), ["device_id", "location"])
    return joined.withColumnRenamed("location", "originating_location")


def call_quality_by_health(calls: DataFrame, devices: DataFrame, health: DataFrame,
                           rounded: bool = True) -> DataFrame:
    """Answered-call quality by device health and vendor.

    Calls shrink to one row per device before the join: the device attributes hang on the
    device alone, so a device that carries a third of all calls is one row when it meets them.
    """
    measured = {"mos": "mos_score", "jit": "jitter_ms", "loss": "packet_loss_pct"}
    per_device = calls.filter(F.col("mos_score").isNotNull()).groupBy(
        F.col("originating_device_id").alias("device_id"), F.col("originating_location").alias("location")
    ).agg(F.count(F.lit(1)).alias("calls"), F.count_if("is_answered").alias("answered"),
          *[F.sum(c).alias(f"{s}_sum") for s, c in measured.items()],
          *[F.count(c).alias(f"{s}_n") for s, c in measured.items()])
    joined = enrich(per_device, _device_context(devices, health), ["device_id", "location"])

    def mean(short: str) -> Column:
        return F.sum(f"{short}_sum") / F.nullif(F.sum(f"{short}_n"), F.lit(0))

    def weighted(column: str) -> Column:
        weight = F.when(F.col(column).isNotNull(), F.col("calls"))
        return F.sum(F.col(column) * weight) / F.sum(weight)

    return joined.groupBy("device_health_status", "vendor").agg(
        F.sum("calls").alias("total_calls"),
        _rounded(mean("mos"), 2, rounded).alias("avg_mos_score"),
        _rounded(mean("jit"), 2, rounded).alias("avg_call_jitter_ms"),
        _rounded(mean("loss"), 3, rounded).alias("avg_call_packet_loss"),
        _rounded(_rate(F.sum("answered"), F.sum("calls")), 2, rounded).alias("answer_rate_pct"),
        _rounded(weighted("device_latency_ms"), 2, rounded).alias("avg_device_latency_ms"),
        _rounded(weighted("device_health_score"), 1, rounded).alias("avg_device_health_score"),
    ).orderBy("device_health_status", "vendor")


def call_quality_hourly(calls: DataFrame, devices: DataFrame, health: DataFrame,
                        rounded: bool = True) -> DataFrame:
    """Hourly call quality by type, region, vendor, device type and device health."""
    joined = call_quality(calls, devices, health)
    keys = [F.date_trunc("hour", "call_start_time").alias("hour_start"), "call_type",
            F.col("originating_region").alias("region"), "vendor", "device_type", "device_health_status"]
    answered = F.count_if("is_answered")
    return joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_calls"), answered.alias("answered_calls"),
        _rounded(_rate(answered, F.count(F.lit(1))), 2, rounded).alias("answer_rate_pct"),
        _rounded(F.avg("call_duration_seconds"), 1, rounded).alias("avg_call_duration_sec"),
        F.sum("call_duration_seconds").alias("total_call_seconds"),
        _rounded(F.avg("call_mos_score"), 2, rounded).alias("avg_mos_score"),
        _rounded(F.min("call_mos_score"), 2, rounded).alias("min_mos_score"),
        _rounded(F.percentile_approx("call_mos_score", 0.05), 2, rounded).alias("p5_mos_score"),
        _rounded(F.avg("call_jitter_ms"), 2, rounded).alias("avg_jitter_ms"),
        _rounded(F.avg("call_packet_loss"), 3, rounded).alias("avg_packet_loss_pct"),
        _rounded(F.avg("device_health_score"), 1, rounded).alias("avg_device_health_score"),
        _rounded(F.avg("device_latency_ms"), 2, rounded).alias("avg_device_latency_ms"),
        F.sum("device_critical_events_1h").alias("total_critical_device_events"),
    )


def session_events(sessions: DataFrame, events: DataFrame, reach: str = "5 minutes") -> DataFrame:
    """Sessions with every event of their device within ``reach``; sessions without stay."""
    nearby = events.select("device_id", F.col("event_timestamp").alias("network_event_time"), "event_type",
                           "event_category", "severity_name",
                           F.col("is_critical").alias("network_event_critical"))
    return interval_join(sessions, nearby, ["device_id"], "session_start_time", "network_event_time",
                         before=reach, after=reach, how="left", rows_per_part=ROWS_PER_PART)


def session_failures(sessions: DataFrame, events: DataFrame, reach: str = "5 minutes",
                     rounded: bool = True) -> DataFrame:
    """Session outcomes beside nearby network events.

    ``pair_count`` is the number of session-event pairs (a session without events counts
    once), and failures and averages weigh each session by its pairs, as a join would.  The
    pairs themselves are never formed.
    """
    counted = interval_sums(sessions, events, ["device_id"], "session_start_time", "event_timestamp",
                            reach, reach, {"_events": F.lit(1), "_critical": F.col("is_critical").cast("int")})
    pairs = F.greatest(F.col("_events"), F.lit(1))
    timings = {"avg_invite_response_ms": "invite_response_time_ms", "avg_setup_time_ms": "session_setup_time_ms"}
    keys = ["sip_method", "final_response_code", *(c for c in ("final_response_desc",) if c in sessions.columns)]
    # Down to one row per session first: the two distinct counts become plain counts.
    sessions = counted.groupBy(*keys, "session_id").agg(
        F.sum(pairs).alias("_pairs"),
        F.sum(F.when(F.col("is_successful"), F.lit(0)).otherwise(pairs)).alias("_failed"),
        F.max(F.col("_critical") > 0).alias("_hit"),
        *[F.sum(F.col(c) * pairs).alias(f"_{c}_sum") for c in timings.values()],
        *[F.sum(F.when(F.col(c).isNotNull(), pairs)).alias(f"_{c}_n") for c in timings.values()])
    return sessions.groupBy(*keys).agg(
        F.sum("_pairs").alias("pair_count"), F.count("session_id").alias("session_count"),
        F.sum("_failed").alias("failed_sessions"),
        F.count(F.when(F.col("_hit"), F.col("session_id"))).alias("sessions_with_critical_events"),
        *[_rounded(F.sum(f"_{c}_sum") / F.sum(f"_{c}_n"), 2, rounded).alias(name) for name, c in timings.items()],
    ).orderBy(F.desc("failed_sessions"), *keys)


def regional_kpis(hourly_calls: DataFrame, perf: DataFrame, as_of: AsOf | None = None,
                  last: str = "24 hours") -> DataFrame:
    """Hourly call quality beside the latency of the same region and hour.

    Measurements come per location and five minutes, so they are first brought to region and
    hour.  With ``as_of`` only the trailing period is shown.
    """
    latency = perf.filter(F.col("metric_name") == "latency_ms").groupBy(
        like_label(F.col("location"), REGION_PATTERNS, "unknown").alias("region"),
        F.date_trunc("hour", "window_start").alias("hour_start"),
    ).agg(F.avg("avg_value").alias("network_avg_latency_ms"), F.avg("p95_value").alias("network_p95_latency_ms"),
          F.sum("anomaly_count").alias("network_anomaly_count"),
          F.count_distinct("device_id").alias("monitored_devices"))
    if as_of is not None:
        since = as_of_column(as_of) - F.expr(f"INTERVAL {last}")
        hourly_calls = hourly_calls.filter(F.col("hour_start") >= since)
        latency = latency.filter(F.col("hour_start") >= since)
    joined = enrich(hourly_calls, latency, ["region", "hour_start"], "left")
    mos, anomalies = F.col("avg_mos_score"), F.col("network_anomaly_count")
    status = first_case([
        ((mos >= 4.0) & (anomalies == 0), "Excellent"), ((mos >= 3.5) & (anomalies < 5), "Good"),
        ((mos >= 3.0) | (anomalies < 10), "Fair")], "Poor")
    return joined.select(
        "region", "hour_start", "call_type", "vendor", "device_type", "device_health_status", "total_calls",
        "answer_rate_pct", "avg_mos_score", F.col("avg_jitter_ms").alias("ims_avg_jitter_ms"),
        "network_avg_latency_ms", "network_p95_latency_ms", "network_anomaly_count", "monitored_devices",
        status.alias("combined_health_status"))


def _per_device(facts: DataFrame, keys: list[str], sums: dict[str, str], flags: dict[str, Column]) -> DataFrame:
    return facts.groupBy(*keys, "device_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(c).alias(f"_{c}_sum") for c in sums.values()],
        *[F.count(c).alias(f"_{c}_n") for c in sums.values()],
        *[F.sum(column).alias(name) for name, column in flags.items()])


def _mean(column: str) -> Column:
    return F.sum(f"_{column}_sum") / F.nullif(F.sum(f"_{column}_n"), F.lit(0))


def _health_mean() -> Column:
    weight = F.when(F.col("health_score").isNotNull(), F.col("_rows"))
    return F.sum(F.col("health_score") * weight) / F.sum(weight)


def subscriber_experience(sessions: DataFrame, health: DataFrame, rounded: bool = True) -> DataFrame:
    """Usage and quality by subscription, home, region and access, with network health.

    Sessions shrink to one row per group and device before they meet the device's health.
    """
    optional = [c for c in ("region",) if c in sessions.columns]
    keys = ["subscription_type", "home_location", *optional, "access_technology"]
    means = {"avg_voice_minutes": ("voice_minutes_used", 2), "avg_video_minutes": ("video_minutes_used", 2),
             "avg_data_mb": ("data_mb_used", 2), "avg_subscriber_mos": ("avg_call_mos_score", 2)}
    means = {name: spec for name, spec in means.items() if spec[0] in sessions.columns}
    reduced = _per_device(sessions, keys, {n: c for n, (c, _) in means.items()},
                          {"_dropped": F.col("dropped_calls"), "_failed": F.col("failed_call_setups")})
    joined = enrich(reduced, health.select("device_id", "health_score", "health_status"), ["device_id"], "left")
    return joined.groupBy(*keys).agg(
        F.sum("_rows").alias("total_sessions"),
        *[_rounded(_mean(c), digits, rounded).alias(name) for name, (c, digits) in means.items()],
        F.sum("_dropped").alias("total_dropped_calls"), F.sum("_failed").alias("total_failed_setups"),
        _rounded(_health_mean(), 1, rounded).alias("avg_network_health_score"),
        F.count_distinct(F.when(F.col("health_status") == "Critical", F.col("device_id")))
        .alias("critical_device_count"),
    ).orderBy(F.desc("total_sessions"), *keys)


def node_performance(nodes: DataFrame, health: DataFrame, rounded: bool = True) -> DataFrame:
    """Core nodes by type and place beside the health of the devices under them."""
    optional = [c for c in ("region",) if c in nodes.columns]
    keys = ["ims_node_type", "ims_node_location", *optional]
    means = {"avg_active_sessions": ("active_sessions", 0), "avg_cpu_pct": ("cpu_utilization_pct", 2),
             "avg_memory_pct": ("memory_utilization_pct", 2), "avg_response_time_ms": ("avg_response_time_ms", 2),
             "avg_error_rate_pct": ("error_rate_pct", 3)}
    means = {name: spec for name, spec in means.items() if spec[0] in nodes.columns}
    reduced = _per_device(nodes, keys, {n: c for n, (c, _) in means.items()},
                          {"_anomalies": F.col("is_anomaly").cast("int")})
    joined = enrich(reduced, health.select("device_id", "health_score", "critical_event_count_1h"),
                    ["device_id"], "left")
    return joined.groupBy(*keys).agg(
        F.sum("_rows").alias("metric_samples"),
        *[_rounded(_mean(c), digits, rounded).alias(name) for name, (c, digits) in means.items()],
        F.sum("_anomalies").alias("ims_anomaly_count"),
        _rounded(_health_mean(), 1, rounded).alias("avg_underlying_device_health"),
        F.sum(F.col("critical_event_count_1h") * F.col("_rows")).alias("total_network_critical_events"),
    ).orderBy(F.desc("ims_anomaly_count"), F.desc("avg_error_rate_pct"), *keys)


def call_window_latency(calls: DataFrame, devices: DataFrame, perf: DataFrame) -> DataFrame:
    """Calls with the latency of their device in the five minutes they started in."""
    latency = perf.filter(F.col("metric_name") == "latency_ms").select(
        "device_id", "window_start", F.col("avg_value").alias("network_latency_ms"),
        F.col("anomaly_count").alias("network_anomalies"))
    known = devices.select(F.col("device_id"), F.col("location"), "device_type", "vendor")
    keyed = calls.withColumnsRenamed({"originating_device_id": "device_id", "originating_location": "location"})
    joined = window_containment_join(enrich(keyed, known, ["device_id", "location"]), latency,
                                     ["device_id"], "call_start_time")
    return joined.select("cdr_id", "call_start_time", "call_duration_seconds", "mos_score", "device_id",
                         "device_type", "vendor", "network_latency_ms", "network_anomalies")


def call_join_keys(calls: DataFrame) -> DataFrame:
    return calls.select(
        F.col("originating_device_id").alias("device_id"), F.col("originating_location").alias("location"),
        F.concat("originating_device_id", F.lit("_"), "originating_location").alias("device_key"),
        F.col("originating_region").alias("region")).distinct()
