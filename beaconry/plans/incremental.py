"""Tables kept current by what has changed.

A batch of records or log lines touches some hours. Only these hours of the rollups are computed
again, from the measurements and events of these hours; nothing else of the history is read or
written. What is kept per entity instead of per hour (newest values, attributes) is merged with
the batch: its size is that of the entities. Values that depend on "now", such as the age of an
event, are put on when a table is read, for they would change in every row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.functions.time import AsOf, as_of_column, interval_micros, micros
from beaconry.operators.dims import dim_devices, dim_stores
from beaconry.operators.events import dedup_events, enrich_events, with_store_region
from beaconry.operators.health import health
from beaconry.operators.logs import parse_log
from beaconry.operators.metrics import validate_metrics
from beaconry.operators.rollups import drive_through, kpi_hourly, rollup_5min, rollup_by_place
from beaconry.plans.tables import GRAPHS
from beaconry.profiles import NETWORK, Profile
from beaconry.sinks.parts import FEW, TIMELESS, WHOLE, Change, PartStore, hour_part
from beaconry.sinks.streams import write_batches

RECENT = "1 hour"  # of events that health looks at
MERGE_ABOVE = 16   # versions of a part and level before they are rewritten as one
LATE = "late_records"


def _spread(rows: DataFrame) -> int:
    """How many hours the rows are of, counted as far as it matters: no more than a few, or more."""
    return rows.select(hour_part("event_timestamp").alias("part")).distinct().limit(FEW + 1).count()


class IncrementalTables:
    """The table graph of a profile below ``root``, moved on batch by batch.

    ``as_of`` fixes "now"; otherwise it is the newest measurement. Tables have the names of the graph.
    With a ``watermark``, as of a stream, a measurement is late if its five minutes ended that long before
    the newest one of earlier batches: it changes nothing and goes to the table ``late_records``.
    """

    def __init__(self, spark: SparkSession, profile: Profile, root: str, as_of: AsOf | None = None,
                 time: str = "event_timestamp", merge_above: int = MERGE_ABOVE, watermark: str | None = None):
        self.spark, self.profile, self.time, self.merge_above, self.watermark = spark, profile, time, merge_above, watermark
        self.store, self._as_of = PartStore(spark, root), as_of
        self._order = [profile.entity, "event_timestamp"]  # of rows in a file
        # What the graph computes -> its table.
        self.name = {attribute: table for table, (attribute, _) in GRAPHS[profile.name].items()}

    def refresh(self, records: DataFrame | None = None, lines: DataFrame | None = None, source: str | None = None,
                batch: int = 0, processed_at: AsOf | None = None) -> dict[str, list[str]]:
        """Take in a batch of new records, new log lines or both; returns the parts written per table.

        With a ``source``, batches are counted, and one that was published before is left out: a stream
        may hand over a batch again after a failure. A part's rows in the tables above it are replaced, so
        late rows and rows of many hours need nothing of their own. Records without a time are stored,
        but have no place in a window.
        """
        change = self.store.current()
        if source is not None:
            if int(change.marks.get(source, -1)) >= batch:
                return {}
            change.marks[source] = str(batch)
        stamp = (F.current_timestamp() if processed_at is None else as_of_column(processed_at)).alias("processed_timestamp")
        measured = self._take_records(change, records, stamp) if records is not None else []
        happened = self._take_lines(change, lines, stamp) if lines is not None else []
        if measured:
            self._roll_up(change, measured, stamp)
        hours = sorted({*measured, *happened} - {TIMELESS})
        if hours and self.name["performance"] in change.schemas and self.name["silver_events"] in change.schemas:
            if self.name["kpi"] not in change.schemas:  # until now one of the two was missing
                hours = sorted({*hours, *change.names(self.name["performance"])})
            kpi = kpi_hourly(self._read(change, "performance", hours), self._read(change, "silver_events", hours), self.profile)
            change.replace(self.name["kpi"], kpi.select("*", hour_part("hour_start").alias("part"), stamp), hours, ["hour_start"])
            self._health(change, stamp)
        change.publish()
        return change.written

    def follow(self, stream: DataFrame, source: str, checkpoint: str, once: bool = True, every: str = "5 minutes",
               measured: bool = True):
        """Refresh by every micro-batch of a stream of records, or of log lines if not ``measured``."""
        def step(batch: DataFrame, number: int) -> None:
            self.refresh(**{"records" if measured else "lines": batch}, source=source, batch=number)

        return write_batches(stream, step, checkpoint, once=once, every=every)

    # --- one table after another -------------------------------------------------
    def _read(self, change: Change, attribute: str, parts: list[str] | None = None) -> DataFrame:
        return change.read(self.name[attribute], parts).drop("processed_timestamp", "part")

    def _take_records(self, change: Change, records: DataFrame, stamp: Column) -> list[str]:
        silver = validate_metrics(records, self.profile, self.time).drop("processed_timestamp")
        table = self.name["metrics"]
        if self.watermark and "clock" in change.schemas:
            passed = change.read("clock").select(F.col("event_timestamp") - F.expr(f"INTERVAL {self.watermark}")).scalar()
            # Stored first: the batch is read for either side.
            silver = change.stage("new_records", silver.withColumns({"watermark": passed, "part": F.lit(WHOLE)})).drop("part")
            spread = _spread(silver)
            at, width = micros(F.col("event_timestamp")), interval_micros("5 minutes")
            late = F.coalesce(at - F.pmod(at, F.lit(width)) + width <= micros(F.col("watermark")), F.lit(False))
            change.append(LATE, silver.filter(late).select("*", hour_part("event_timestamp").alias("part"), stamp), spread=spread)
            silver = silver.filter(~late).drop("watermark")
        else:
            spread = _spread(silver)
        fresh = change.append(table, silver.select("*", hour_part("event_timestamp").alias("part"), stamp), self._order, spread)
        touched = change.written.get(table, [])
        if not touched:
            return []
        change.merge_versions(table, self.merge_above, sort_by=self._order)
        self._merge(change, "clock", fresh.agg(F.max("event_timestamp").alias("event_timestamp")),
                    lambda rows: rows.agg(F.max("event_timestamp").alias("event_timestamp")))
        dimension = ["device_id", "device_type", "location", "vendor", "model", "ip_address"] if self.profile is NETWORK else [
            "store_id", "store_category", "store_type", "region", "brand", "district", "address", "latitude", "longitude"]

        def first_seen(rows: DataFrame) -> DataFrame:
            return rows.groupBy(*dimension).agg(F.min("event_timestamp").alias("event_timestamp"))

        self._merge(change, "entities", first_seen(fresh), first_seen)
        build = dim_devices if self.profile is NETWORK else dim_stores
        change.replace(self.name["dimension"], build(change.read("entities"), self._now(change)).select("*", stamp))
        return touched

    def _merge(self, change: Change, table: str, new: DataFrame, combine: Callable[[DataFrame], DataFrame],
               old: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
        """Combine what a table of entities holds with new rows."""
        rows = new if table not in change.schemas else old(change.read(table).drop("part")).unionByName(new)
        change.replace(table, combine(rows))

    def _take_lines(self, change: Change, lines: DataFrame, stamp: Column) -> list[str]:
        """New events only: an event is a repeat if its hour has the same one already."""
        table = self.name["silver_events"]
        events = dedup_events(parse_log(lines, self.profile), self.profile)
        fresh = change.stage("new_events", events.withColumn("part", hour_part("event_timestamp")), FEW + 1)
        hours = sorted(r.part for r in fresh.select("part").distinct().collect())
        if table in change.schemas:
            fresh = fresh.subtract(change.read(table, hours).drop("processed_timestamp").select(*fresh.columns))
        change.append(table, fresh.select("*", stamp), self._order, len(hours))
        change.merge_versions(table, self.merge_above, sort_by=self._order)
        return change.written.get(table, [])

    def _roll_up(self, change: Change, touched: list[str], stamp: Column) -> None:
        hours = [h for h in touched if h != TIMELESS]
        if not hours:
            return
        part = hour_part("window_start").alias("part")
        order = [self.profile.entity, "window_start"]
        rolled = rollup_5min(self._read(change, "metrics", hours), self.profile)
        change.replace(self.name["performance"], rolled.select("*", part, stamp), hours, order)
        current = self._read(change, "performance", hours)
        change.replace(self.name["by_place"], rollup_by_place(current, self.profile).select("*", part, stamp), hours, order)
        if "lanes" in self.name:
            change.replace(self.name["lanes"], drive_through(current).select("*", part, stamp), hours, order)

        place = [c for c in ("latitude", "longitude") if c in current.columns]
        keys = list(dict.fromkeys([self.profile.entity, "metric_name", *self.profile.health_attributes,
                                   *(k for k in self.profile.rollup_keys if k in current.columns)]))
        values = ["avg_value", *place, "hour"]

        def newest(rows: DataFrame) -> DataFrame:
            return rows.groupBy(*keys).agg(F.max("window_end").alias("window_end"), *[F.max_by(v, "window_end").alias(v) for v in values])

        again = self.spark.createDataFrame([(h,) for h in hours], "hour string")
        self._merge(change, "newest", current.withColumn("hour", hour_part("window_start")).select(*keys, "window_end", *values),
                    newest, lambda rows: rows.join(again, "hour", "left_anti").select(*keys, "window_end", *values))

    def _now(self, change: Change) -> Column:
        return as_of_column(self._as_of) if self._as_of is not None else change.read("clock").select("event_timestamp").scalar()

    def _health(self, change: Change, stamp: Column) -> None:
        now = self._now(change)
        since = self.spark.range(1).select(hour_part(now - F.expr(f"INTERVAL {RECENT}")).alias("h")).first()["h"]
        events = [p for p in change.names(self.name["silver_events"]) if p != TIMELESS and p >= since]
        state = health(change.read("newest").drop("part", "hour"), self._read(change, "silver_events", events), self.profile, now)
        change.replace(self.name["health"], state.select("*", stamp))

    # --- reading ------------------------------------------------------------------
    def table(self, name: str, hours: list[str] | None = None) -> DataFrame:
        """A table of the graph, or ``late_records``, as it stands, or some hours of it."""
        change = self.store.current()
        if name == LATE:
            return change.read(LATE, hours).drop("part")
        attribute = GRAPHS[self.profile.name][name][0]
        if attribute not in ("silver_events", "events"):
            return change.read(name, hours).drop("part")
        events = change.read(self.name["silver_events"], hours).drop("part")
        if self.profile is not NETWORK:
            events = with_store_region(events, self._read(change, "dimension"))
        if attribute == "silver_events":
            return events
        return enrich_events(events, self._now(change))
