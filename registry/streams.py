"""Streaming and file queries: data derived from the tables, drained, and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.operators.dims import History
from beaconry.operators.events import dedup_events
from beaconry.operators.logs import parse_log
from beaconry.operators.metrics import validate_metrics
from beaconry.plans.incremental import IncrementalTables
from beaconry.profiles import NETWORK, RETAIL
from beaconry.session import scratch_path
from beaconry.sinks.streams import read_latest, upsert_batches
from beaconry.plans.tables import Tables, refresh
from beaconry.sinks.tables import compact, latest_table, register_view, set_table_props, table_writer, write_table
from beaconry.sources.readers import external_table, read_csv_stream, read_json, read_json_stream, stream_table, table
from beaconry.sources.schema import infer_schema, with_rescued_data
from beaconry.streaming.pipelines import (
    drain, ingest_json, read_ingested, refresh_panes, stream_interval_join, stream_rollup, trailing_counts,
)
from registry.core import add
from registry.lake import Lake
from registry.pipeline import _KPI, _LOG, _NET_STATE, _NEW, _OLD, _SCD2, _SLIDING, _STATS


def _cores(lake: Lake) -> int:
    return lake.spark.sparkContext.defaultParallelism


def _drained(lake: Lake, df: DataFrame, label: str) -> DataFrame:
    home = scratch_path(lake.spark, label)
    drain(df, f"{home}/data", f"{home}/checkpoint", state_partitions=_cores(lake))
    return lake.spark.read.parquet(f"{home}/data")


def _stream_parse(lake: Lake) -> DataFrame:
    parsed = parse_log(lake.stream("fx_syslog", "events"), NETWORK)
    return _drained(lake, parsed.select("event_id", *_LOG, "device_type", "location"), "parse")


add("stream_parse", _stream_parse, f"SELECT event_id, {', '.join(_LOG)}, device_type, location FROM net_parsed")


def _stream_dedup(lake: Lake) -> DataFrame:
    parsed = parse_log(lake.stream("fx_syslog", "events"), NETWORK)
    return _drained(lake, dedup_events(parsed, NETWORK, "1 hour"), "dedup")


add("stream_dedup", _stream_dedup,
    "SELECT event_timestamp, device_id, device_type, location, app_name, event_type, event_category, severity,"
    " severity_name, is_critical, event_message, structured_data FROM net_events")


def _stream_rollup(lake: Lake) -> DataFrame:
    rolled = stream_rollup(lake.stream("fx_metrics", "events"), NETWORK, "event_timestamp")
    home, keys = scratch_path(lake.spark, "rollup"), ["window_start", "window_end", *NETWORK.rollup_keys]
    upsert_batches(rolled, f"{home}/data", f"{home}/checkpoint", keys, once=True,
                   state_partitions=_cores(lake)).awaitTermination()
    return read_latest(lake.spark, f"{home}/data", keys)


add("stream_rollup_5min", _stream_rollup, "SELECT * FROM net_perf", _STATS)


def _stream_panes(lake: Lake) -> DataFrame:
    """Trailing hours from five-minute panes that a stream keeps."""
    events = dedup_events(parse_log(lake.stream("fx_syslog_once", "events"), NETWORK), NETWORK, "1 hour")
    home = scratch_path(lake.spark, "panes")
    refresh_panes(events, NETWORK, f"{home}/data", f"{home}/checkpoint", watermark=None,
                  state_partitions=_cores(lake)).awaitTermination()
    return trailing_counts(lake.spark, NETWORK, f"{home}/data")


add("stream_trailing_counts", _stream_panes, _SLIDING)


def _stream_join(lake: Lake) -> DataFrame:
    sessions = lake.stream("fx_sip", "orders").withColumn(
        "session_start_time", F.col("session_start_time").cast("timestamp"))
    events = parse_log(lake.stream("fx_syslog", "events"), NETWORK).select(
        F.col("hostname").alias("device_id"), F.col("event_timestamp").alias("event_time"),
        F.col("msg_id").alias("event_type"), "is_critical")
    pairs = stream_interval_join(
        sessions.select("session_id", "device_id", "session_start_time", "sip_method"), events, ["device_id"],
        "session_start_time", "event_time", "5 minutes", "5 minutes")
    return _drained(lake, pairs, "pairs").groupBy("sip_method", "event_type").agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if("is_critical").alias("critical_pairs"))


add("stream_interval_join", _stream_join,
    """SELECT sip_method, e.msg_id AS event_type, count(*) AS pairs,
         count(*) FILTER (is_critical) AS critical_pairs
       FROM fx_sip s JOIN net_parsed e ON s.device_id=e.hostname
         AND e.event_timestamp BETWEEN s.session_start_time-INTERVAL 5 MINUTE
           AND s.session_start_time+INTERVAL 5 MINUTE GROUP BY 1,2""")

_RECORD = ["timestamp", "device_id", "device_type", "location", "vendor", "model", "ip_address", "oid",
           "metric_name", "value"]
_ISO = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"


def _records(lake: Lake) -> DataFrame:
    """Metric records as their source writes them: ISO text with an offset."""
    metrics = lake.fx("fx_metrics")
    return metrics.withColumn("timestamp", F.date_format(F.col("event_timestamp").cast("timestamp"), _ISO)).select(
        "event_id", *_RECORD)


_SEEN = ["event_timestamp", "device_id", "location", "metric_name", "metric_unit", "value", "is_anomaly"]
_SEEN_SQL = f"SELECT {', '.join(_SEEN)} FROM net_metrics"


def _json_ingest(lake: Lake) -> DataFrame:
    home = scratch_path(lake.spark, "json")
    _records(lake).select(*_RECORD).write.json(f"{home}/in")
    schema = infer_schema(lake.spark, f"{home}/in")
    stream = read_json_stream(lake.spark, f"{home}/in", schema)
    drain(stream, f"{home}/data", f"{home}/checkpoint")
    return validate_metrics(lake.spark.read.parquet(f"{home}/data"), NETWORK).select(*_SEEN)


def _csv_ingest(lake: Lake) -> DataFrame:
    home = scratch_path(lake.spark, "csv")
    records = _records(lake).select(*_RECORD)
    records.write.option("header", True).csv(f"{home}/in")
    stream = read_csv_stream(lake.spark, f"{home}/in", records.schema)
    drain(stream, f"{home}/data", f"{home}/checkpoint")
    return validate_metrics(lake.spark.read.parquet(f"{home}/data"), NETWORK).select(*_SEEN)


add("json_ingest", _json_ingest, _SEEN_SQL, "value")
add("csv_ingest", _csv_ingest, _SEEN_SQL, "value")


def _lines(lake: Lake) -> DataFrame:
    """JSON lines of which some carry an extra key, some a word for the value, some are cut short."""
    records = _records(lake)
    body = F.to_json(F.struct("event_id", "device_id", "value"), {"ignoreNullFields": "false"})
    bad = F.to_json(F.struct("event_id", "device_id", F.lit("n/a").alias("value")))
    extra = F.to_json(F.struct("event_id", "device_id", "value", F.col("model").alias("firmware_version"),
                               (F.col("event_id") % 1000).alias("uptime_hours")))
    kind = F.col("event_id") % 5
    line = F.when(kind == 1, bad).when(kind == 2, extra).when(
        kind == 3, F.concat(F.lit("cut "), F.col("event_id").cast("string"))).otherwise(body)
    return records.select(line.alias("value"))


_LINE_SQL = "FROM fx_metrics"


def _rescued(lake: Lake) -> DataFrame:
    schema = lake.spark.createDataFrame([], "event_id long, device_id string, value double").schema
    return with_rescued_data(_lines(lake), schema)


add("rescued_data", _rescued,
    f"""SELECT CASE WHEN event_id%5<>3 THEN event_id END AS event_id,
          CASE WHEN event_id%5<>3 THEN device_id END AS device_id,
          CASE WHEN event_id%5 NOT IN (1,3) THEN value END AS value,
          CASE WHEN event_id%5=1 THEN '{{"value":"n/a"}}'
            WHEN event_id%5=2 THEN '{{"firmware_version":"'||model||'","uptime_hours":"'||(event_id%1000)||'"}}'
            END AS _rescued_data,
          CASE WHEN event_id%5=3 THEN 'cut '||event_id END AS _corrupt_record {_LINE_SQL}""", "value")


def _evolution(lake: Lake) -> DataFrame:
    """Two runs of one ingest; new keys appear and join the schema."""
    home = scratch_path(lake.spark, "evolve")
    first = lake.spark.createDataFrame([], "event_id long, device_id string, value double").schema
    _lines(lake).write.text(f"{home}/in/run=1")
    ingest_json(lake.spark, f"{home}/in", f"{home}/data", home, first, glob="*.txt")
    _lines(lake).write.text(f"{home}/in/run=2")
    schema = ingest_json(lake.spark, f"{home}/in", f"{home}/data", home, glob="*.txt")
    rows = read_ingested(lake.spark, f"{home}/data", schema)
    return rows.select("event_id", "device_id", "value", "firmware_version", "uptime_hours")


add("stream_schema_evolution", _evolution,
    f"""SELECT CASE WHEN event_id%5<>3 THEN event_id END AS event_id,
          CASE WHEN event_id%5<>3 THEN device_id END AS device_id,
          CASE WHEN event_id%5 NOT IN (1,3) THEN value END AS value,
          CASE WHEN event_id%5=2 THEN model END AS firmware_version,
          CASE WHEN event_id%5=2 THEN event_id%1000 END AS uptime_hours
        FROM (SELECT * {_LINE_SQL} UNION ALL SELECT * {_LINE_SQL})""", "value")


def _compacted(lake: Lake) -> DataFrame:
    home = scratch_path(lake.spark, "compact")
    lake.net.metrics.write.partitionBy("metric_name").parquet(f"{home}/in")
    return compact(lake.spark, f"{home}/in", f"{home}/out", ["metric_name"], ["device_id", "event_timestamp"]).groupBy(
        "metric_name").agg(F.count(F.lit(1)).alias("rows"), F.min("event_timestamp").alias("first_time"),
                           F.max("value").alias("max_value"))


add("partitioned_compaction", _compacted,
    "SELECT metric_name, count(*) AS rows, min(event_timestamp) AS first_time, max(value) AS max_value"
    " FROM net_metrics GROUP BY 1", "max_value")


# --- tables: write, register, read back ---------------------------------------
def _name(lake: Lake, label: str) -> tuple[str, str]:
    """A table name and folder of their own."""
    path = scratch_path(lake.spark, label)
    return path.rsplit("/", 1)[1].replace("-", "_"), path


_PER_METRIC = ("SELECT metric_name, count(*) AS rows, count(DISTINCT device_id) AS devices, max(value) AS max_value"
               " FROM net_metrics GROUP BY 1")


def _per_metric(df: DataFrame) -> DataFrame:
    return df.groupBy("metric_name").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("device_id").alias("devices"),
                                         F.max("value").alias("max_value"))


def _table_written(lake: Lake) -> DataFrame:
    """Partitioned overwrite, properties and comment, a view over the table, read by name."""
    name, path = _name(lake, "written")
    write_table(lake.net.metrics.limit(0), name, ["metric_name"], sort_by=["device_id"], path=path)
    write_table(lake.net.metrics, name, ["metric_name"], sort_by=["device_id"], path=path)
    set_table_props(lake.spark, name, {"quality": "silver"}, "measurements that passed the rules")
    register_view(table(lake.spark, name), f"{name}_view")
    return _per_metric(table(lake.spark, f"{name}_view"))


def _table_streamed(lake: Lake) -> DataFrame:
    """A stream over a table; a second run on the same checkpoint adds what was appended, once."""
    name, path = _name(lake, "appended")
    silver = lake.net.metrics.select("event_timestamp", "device_id", "metric_name", "value")
    early = F.pmod(F.xxhash64("event_timestamp", "device_id"), F.lit(2)) == 0
    write_table(silver.filter(early), name, path=path)
    home = scratch_path(lake.spark, "streamed")
    drain(stream_table(lake.spark, name), f"{home}/data", f"{home}/checkpoint")
    write_table(silver.filter(~early), name, mode="append", path=path)
    for _ in range(2):
        drain(stream_table(lake.spark, name), f"{home}/data", f"{home}/checkpoint")
    return _per_metric(lake.spark.read.parquet(f"{home}/data"))


def _shared_table(lake: Lake) -> DataFrame:
    """Columnar files that another platform keeps, by their path."""
    home = scratch_path(lake.spark, "shared")
    lake.net.metrics.write.partitionBy("metric_name").parquet(home)
    return _per_metric(external_table(lake.spark, home, merge_schema=True))


def _file_lineage(lake: Lake) -> DataFrame:
    """Each row knows the file it came from."""
    home = scratch_path(lake.spark, "lineage")
    rows = lake.fx("fx_metrics").select("event_id", "device_id", F.col("source_file").alias("origin"))
    rows.withColumn("part", F.col("origin")).write.partitionBy("part").json(home)
    read = read_json(lake.spark, home, rows.schema)
    part = F.regexp_extract("source_file", "part=([^/]+)/", 1)
    return read.select("event_id", "device_id", part.alias("read_from"), (part == F.col("origin")).alias("right_file"))


add("table_written", _table_written, _PER_METRIC, "max_value")
add("table_streamed", _table_streamed, _PER_METRIC, "max_value")
add("shared_table", _shared_table, _PER_METRIC, "max_value")
add("file_lineage", _file_lineage,
    "SELECT event_id, device_id, source_file AS read_from, TRUE AS right_file FROM fx_metrics")


def _refreshed_twice(lake: Lake) -> DataFrame:
    """Gold after a second refresh, which finds the rows that arrived since the first."""
    home, spark = scratch_path(lake.spark, "refreshed"), lake.spark
    records, early = lake.fx("fx_metrics"), F.col("event_id") % 2 == 0
    records.filter(early).write.parquet(f"{home}/raw")
    tables = Tables(NETWORK, lambda: spark.read.parquet(f"{home}/raw"), lake.fx("fx_syslog"))
    wanted = ["network_metrics", "network_performance_5min", "metrics_by_location"]
    refresh(tables, table_writer(spark, f"{home}/gold"), only=wanted)
    records.filter(~early).write.mode("append").parquet(f"{home}/raw")
    refresh(tables, table_writer(spark, f"{home}/gold"), only=wanted)
    return latest_table(spark, f"{home}/gold", "metrics_by_location").drop("processed_timestamp")


add("refresh_after_arrival", _refreshed_twice, "SELECT * FROM net_place",
    "location_avg_value location_max_value location_min_value location_p95_value")


def _in_batches(lake: Lake, profile, records: DataFrame, lines: DataFrame) -> IncrementalTables:
    """Three batches: most rows, then late and new ones of every hour, then the rest together with repeats."""
    tables = IncrementalTables(lake.spark, profile, scratch_path(lake.spark, "incremental"))
    kind = F.pmod(F.col("event_id"), F.lit(7))
    for chosen in (kind > 1, kind == 1, kind == 0):
        tables.refresh(records.filter(chosen), lines.filter(chosen | (kind == 3)))
    return tables


def _incremental(lake: Lake, name: str) -> DataFrame:
    tables = _in_batches(lake, NETWORK, lake.fx("fx_metrics"), lake.fx("fx_syslog"))
    return tables.table(name).drop("processed_timestamp")


add("incremental_refresh", lambda lake: _incremental(lake, "network_kpi_hourly"), "SELECT * FROM net_kpi", _KPI)
add("incremental_device_health", lambda lake: _incremental(lake, "device_health"), "SELECT * FROM net_health", _NET_STATE)
add("incremental_store_events",
    lambda lake: _in_batches(lake, RETAIL, lake.fx("fx_store_metrics"), lake.fx("fx_store_log")).table("store_events").drop(
        "processed_timestamp"),
    "SELECT * FROM ret_events", "event_age_minutes")


def _late(lake: Lake) -> DataFrame:
    """A stream of three batches; what comes behind the watermark stands beside the rollup, not in it."""
    home, spark = scratch_path(lake.spark, "late"), lake.spark
    records, number = lake.fx("fx_metrics"), F.col("event_id")
    half = records.agg(F.floor(F.max("event_id") / 2)).scalar()
    tables = IncrementalTables(spark, NETWORK, f"{home}/gold", watermark="10 minutes")
    for chosen in ((number <= half) & (number % 10 != 7), (number > half) & (number % 10 != 7), number % 10 == 7):
        records.filter(chosen).write.mode("append").parquet(f"{home}/raw")
        stream = spark.readStream.schema(records.schema).parquet(f"{home}/raw")
        tables.follow(stream, "records", f"{home}/checkpoint").awaitTermination()
    rolled = tables.table("network_performance_5min").groupBy("window_start").agg(F.sum("sample_count").alias("rows"))
    late = tables.table("late_records").groupBy(F.window("event_timestamp", "5 minutes")["start"].alias("window_start")).agg(
        F.count(F.lit(1)).alias("rows"))
    return rolled.withColumn("kind", F.lit("rollup")).unionByName(late.withColumn("kind", F.lit("late")))


_LATE_ROWS = """(SELECT time_bucket(INTERVAL '5 minutes', event_timestamp) AS window_start, event_timestamp AS t,
      event_id%10=7 AS last, event_id>(SELECT max(event_id)//2 FROM fx_metrics) AS second FROM net_metrics)"""
_LATE_SQL = f"""
    SELECT CASE WHEN last AND window_start+INTERVAL 5 MINUTE<=m2-INTERVAL 10 MINUTE
        OR NOT last AND second AND window_start+INTERVAL 5 MINUTE<=m1-INTERVAL 10 MINUTE THEN 'late' ELSE 'rollup' END AS kind,
      window_start, count(*) AS rows
    FROM {_LATE_ROWS} r, (SELECT max(t) FILTER (NOT last AND NOT second) AS m1, max(t) FILTER (NOT last) AS m2
      FROM {_LATE_ROWS} q) m GROUP BY 1,2"""
add("stream_late_records", _late, _LATE_SQL)


def _history(lake: Lake) -> DataFrame:
    """Three snapshots of a dimension, merged into stored history; the third repeats the second."""
    old, new = (lake.sql(text) for text in (_OLD, _NEW))
    kept = History(lake.spark, scratch_path(lake.spark, "history"), ["k"], ["segment", "nation"])
    for snapshot, day in ((old, "2026-01-01"), (new, "2026-02-01"), (new, "2026-03-01")):
        kept.merge(snapshot, day)
    return kept.read()


add("scd2_history", _history, _SCD2)
