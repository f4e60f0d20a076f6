"""Streaming pipelines: parse, roll up, de-duplicate, join, evolve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from beaconry.operators.events import dedup_events, event_panes, pane_keys, sum_panes
from beaconry.operators.joins import interval_join
from beaconry.operators.logs import parse_log
from beaconry.operators.metrics import validate_metrics
from beaconry.operators.rollups import rollup_5min
from beaconry.profiles.base import Profile
from beaconry.sinks.parts import PartStore
from beaconry.sinks.streams import read_latest, upsert_batches, write_batches, write_stream
from beaconry.sources.readers import read_text_stream
from beaconry.sources.schema import (
    RESCUED, evolve_schema, load_schema, save_schema, with_rescued_data,
)


def stream_events(lines: DataFrame, profile: Profile, watermark: str = "10 minutes") -> DataFrame:
    """Log lines to events without repeats."""
    return dedup_events(parse_log(lines, profile), profile, watermark)


def stream_rollup(records: DataFrame, profile: Profile, time: str = "timestamp",
                  watermark: str = "10 minutes") -> DataFrame:
    """Metric records to five-minute statistics; rows later than the watermark are left out."""
    return rollup_5min(validate_metrics(records, profile, time), profile, watermark=watermark)


def stream_interval_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str,
                         right_time: str, before: str, after: str, watermark: str = "10 minutes",
                         how: str = "inner") -> DataFrame:
    """Interval join of two streams; state is kept for the interval plus the watermark."""
    return interval_join(left.withWatermark(left_time, watermark), right.withWatermark(right_time, watermark),
                         on, left_time, right_time, before, after, how)


def refresh_windows(silver: DataFrame, profile: Profile, path: str, checkpoint: str,
                    watermark: str = "10 minutes", once: bool = True, **options):
    """Keep a rollup current: every batch writes only the windows it touched."""
    return upsert_batches(rollup_5min(silver, profile, watermark=watermark), path, checkpoint,
                          ["window_start", "window_end", *profile.rollup_keys], once=once, **options)


def refresh_panes(events: DataFrame, profile: Profile, path: str, checkpoint: str, slide: str = "5 minutes",
                  watermark: str | None = "10 minutes", once: bool = True, **options):
    """Keep event counts per pane current; :func:`trailing_counts` adds panes up to hours.

    State and files hold one row per entity and pane, not one per window that the pane is part of.
    ``watermark`` is None for events that have one.
    """
    panes = event_panes(events.withWatermark("event_timestamp", watermark) if watermark else events, profile, slide)
    return upsert_batches(panes, path, checkpoint, pane_keys(profile), once=once, **options)


def trailing_counts(spark: SparkSession, profile: Profile, path: str, width: str = "1 hour",
                    slide: str = "5 minutes") -> DataFrame:
    """Sliding event counts from the panes of :func:`refresh_panes`."""
    return sum_panes(read_latest(spark, path, pane_keys(profile)), profile, width, slide)


def drain(df: DataFrame, target: str, checkpoint: str, timeout: int | None = None,
          state_partitions: int | None = None) -> None:
    """Process everything available, then stop; with ``timeout`` seconds, stop and raise after them."""
    query = write_stream(df, target, checkpoint, once=True, state_partitions=state_partitions)
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError("stream did not drain in time")


def ingest_json(spark: SparkSession, source: str, target: str, home: str, first_schema: StructType | None = None,
                glob: str = "*.json", max_files: int | None = None, max_new_keys: int = 1000) -> StructType:
    """Drain new NDJSON files into ``target``; returns the schema after the run.

    The schema is remembered under ``home``.  Keys it lacks are rescued as text during the
    run, so nothing is lost, and join the schema for the next run on the same checkpoint.
    :func:`read_ingested` shows all rows under the newest schema.  More than ``max_new_keys`` new
    keys in one run are taken for ids used as keys: an error says so, and all stay rescued.
    """
    schema = load_schema(spark, f"{home}/schema") or first_schema
    if schema is None:
        raise ValueError("give first_schema, or infer one with infer_schema")
    lines = read_text_stream(spark, source, glob, max_files)
    typed = with_rescued_data(lines, schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        own = f"{target}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(own)
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or home
        _note_kinds(spark, f"{home}/kinds", spark.read.parquet(own), schema, query, batch_id)

    write_batches(typed, write, f"{home}/checkpoint", once=True).awaitTermination()
    schema = evolve_schema(schema, _schema_of_kinds(spark, f"{home}/kinds", schema, max_new_keys))
    save_schema(spark, schema, f"{home}/schema")
    return schema


def read_ingested(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """Rows of :func:`ingest_json`: values rescued before their column existed move into it."""
    rows = spark.read.option("mergeSchema", True).parquet(target)
    stored = {c.lower() for c in rows.columns}
    rescued = F.from_json(RESCUED, "map<string,string>")
    columns = []
    for f in schema.fields:
        late = rescued[f.name].try_cast(f.dataType)
        columns.append((F.coalesce(F.col(f.name), late) if f.name.lower() in stored else late).alias(f.name))
    extra = [c for c in rows.columns if c not in schema.fieldNames() and c != "batch"]
    return rows.select(*columns, *extra)


_KINDS = ("bigint", "double", "boolean")


def _note_kinds(spark: SparkSession, path: str, batch: DataFrame, schema: StructType, source: str, number: int) -> None:
    """Add to the statistics of rescued keys what one batch says: values, and whether all fit a type.

    They are sums and conjunctions, so batches combine in any order and no batch is read twice.
    """
    change = PartStore(spark, path).current()
    if int(change.marks.get(source, -1)) >= number:
        return
    change.marks[source] = str(number)
    pairs = batch.filter(F.col(RESCUED).isNotNull()).select(F.explode(F.from_json(RESCUED, "map<string,string>")).alias("key", "text"))
    pairs = pairs.filter(~F.col("key").isin([f.name for f in schema.fields]) & F.col("text").isNotNull())
    found = pairs.groupBy("key").agg(F.count(F.lit(1)).alias("values"),
                                     *[F.bool_and(F.col("text").try_cast(k).isNotNull()).alias(k) for k in _KINDS])
    rows = found.unionByName(change.read("kinds").drop("part")) if "kinds" in change.schemas else found
    change.replace("kinds", rows.groupBy("key").agg(F.sum("values").alias("values"), *[F.bool_and(k).alias(k) for k in _KINDS]))
    change.publish()


def _schema_of_kinds(spark: SparkSession, path: str, schema: StructType, max_new_keys: int) -> StructType:
    """Types of the rescued keys: the narrowest of long, double, boolean, string that fits all values."""
    change = PartStore(spark, path).current()
    if "kinds" not in change.schemas:
        return StructType([])
    kinds = change.read("kinds").filter(~F.col("key").isin([f.name for f in schema.fields]))
    kind = F.coalesce(*[F.when(F.col(k), k) for k in _KINDS], F.lit("string"))
    new = kinds.select("key", kind.alias("kind")).orderBy("key").limit(max_new_keys + 1).collect()
    if len(new) > max_new_keys:
        raise ValueError(f"more than {max_new_keys} new keys in one run; their values stay in {RESCUED}")
    ddl = ", ".join(f"`{r.key}` {r.kind}" for r in new)
    return StructType.fromDDL(ddl) if ddl else StructType([])
