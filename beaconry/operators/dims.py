"""Dimensions, their history, and snapshot comparison."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.functions.rules import first_case, like_label
from beaconry.functions.time import AsOf, as_of_column
from beaconry.profiles.network import REGION_PATTERNS, TIER_PATTERNS
from beaconry.profiles.retail import OTHER_TIER, STORE_TIERS
from beaconry.sinks.parts import PartStore, day_part


def _validity(as_of: AsOf) -> dict[str, Column]:
    now = as_of_column(as_of)
    return {
        "effective_start_date": now,
        "effective_end_date": F.lit(None).cast("timestamp"),
        "is_active": F.lit(True),
        "last_updated": now,
    }


def dim_devices(metrics: DataFrame, as_of: AsOf) -> DataFrame:
    devices = metrics.select("device_id", "device_type", "location", "vendor", "model", "ip_address").distinct()
    return devices.withColumns({
        "device_key": F.concat("device_id", F.lit("_"), "location"),
        "region": like_label(F.col("location"), REGION_PATTERNS, "unknown"),
        "device_tier": like_label(F.col("device_id"), TIER_PATTERNS, "unknown"),
        "device_sk": F.md5("device_id"),
        **_validity(as_of),
    })


def dim_stores(metrics: DataFrame, as_of: AsOf) -> DataFrame:
    keys = ["store_id", "store_category", "store_type", "region", "brand", "district", "address"]
    point = ["latitude", "longitude"]
    # Distinct positions first, by hash; only those few are then ordered by time.
    positions = metrics.groupBy(*keys, *point).agg(F.min("event_timestamp").alias("_since"))
    stores = positions.groupBy(*keys).agg(*[F.min_by(c, F.struct("_since", *point)).alias(c) for c in point])
    tiers = [((F.col("store_category") == category) & (F.col("store_type") == kind), tier)
             for (category, kind), tier in STORE_TIERS.items()]
    return stores.withColumns({
        "store_key": F.concat("store_id", F.lit("_"), "region"),
        "store_tier": first_case(tiers, OTHER_TIER),
        "store_sk": F.md5("store_id"),
        "supply_chain_integration_ready": F.lit(True),
        **_validity(as_of),
    })


def _differs(attributes: Sequence[str], left: str, right: str) -> Column:
    changed = [~F.col(f"{left}.{a}").eqNullSafe(F.col(f"{right}.{a}")) for a in attributes]
    return reduce(lambda a, b: a | b, changed, F.lit(False))


def _side_by_side(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join with each whole side packed in a struct: columns ``o`` and ``n``."""
    left = old.select(*[F.col(k).alias(f"_ok{i}") for i, k in enumerate(keys)], F.struct("*").alias("o"))
    right = new.select(*[F.col(k).alias(f"_nk{i}") for i, k in enumerate(keys)], F.struct("*").alias("n"))
    on = reduce(lambda a, b: a & b, [F.col(f"_ok{i}").eqNullSafe(F.col(f"_nk{i}")) for i in range(len(keys))])
    return left.join(right, on, "full_outer").select("o", "n")


def scd1_upsert(dim: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows replace old rows of the same key; the rest stays."""
    return dim.join(new.select(*keys), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def scd2_merge(dim: DataFrame, new: DataFrame, keys: Sequence[str], attributes: Sequence[str],
               as_of: AsOf, close_missing: bool = False) -> DataFrame:
    """Close changed rows at ``as_of`` and open their successors; one join over the open rows."""
    now = as_of_column(as_of)
    columns = list(dict.fromkeys([*keys, *attributes]))
    validity = ["effective_start_date", "effective_end_date", "is_active"]
    history = dim.filter(~F.col("is_active")).select(*columns, *validity)
    both = _side_by_side(dim.filter("is_active").select(*columns, *validity), new.select(*columns), keys)

    def row(side: str, start: Column, end: Column, active: bool) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in columns],
                        start.cast("timestamp").alias(validity[0]), end.cast("timestamp").alias(validity[1]),
                        F.lit(active).alias(validity[2]))

    open_end = F.lit(None).cast("timestamp")
    kept = row("o", F.col("o.effective_start_date"), open_end, True)
    closed = row("o", F.col("o.effective_start_date"), now, False)
    opened = row("n", now, open_end, True)
    gone = closed if close_missing else kept
    rows = (F.when(F.col("o").isNull(), F.array(opened))
            .when(F.col("n").isNull(), F.array(gone))
            .when(_differs(attributes, "o", "n"), F.array(closed, opened))
            .otherwise(F.array(kept)))
    return both.select(F.inline(rows)).unionByName(history)


class History:
    """A type-2 dimension kept below ``root``: open rows in one part, closed ones by the day they ended.

    A merge reads and replaces the open rows, and adds the rows it closes; closed history is neither
    read nor written again, however long it grows.
    """

    TABLE, OPEN = "history", "open"

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], attributes: Sequence[str]):
        self.store, self.keys, self.attributes = PartStore(spark, root), list(keys), list(attributes)

    def merge(self, new: DataFrame, as_of: AsOf, close_missing: bool = False) -> list[str]:
        """Take in a snapshot; returns the parts written. The same snapshot and time again change nothing."""
        change = self.store.current()
        if self.TABLE in change.schemas:
            dim = change.read(self.TABLE, [self.OPEN]).drop("part")
        else:
            dim = new.select(*dict.fromkeys([*self.keys, *self.attributes]), F.lit(None).cast("timestamp").alias("effective_start_date"),
                             F.lit(None).cast("timestamp").alias("effective_end_date"), F.lit(True).alias("is_active")).limit(0)
        merged = scd2_merge(dim, new, self.keys, self.attributes, as_of, close_missing)
        part = F.when(F.col("is_active"), self.OPEN).otherwise(day_part("effective_end_date"))
        change.put(self.TABLE, merged.withColumn("part", part), [self.OPEN], self.keys)
        change.publish()
        return change.written[self.TABLE]

    def read(self) -> DataFrame:
        return self.store.read(self.TABLE).drop("part")

    def current(self) -> DataFrame:
        return self.store.read(self.TABLE, [self.OPEN]).drop("part")

    def at(self, time: AsOf) -> DataFrame:
        """Rows that were valid at a time: open ones, and closed ones of that day and later only."""
        moment = as_of_column(time)
        change = self.store.current()
        day = change.store.spark.range(1).select(day_part(moment).alias("d")).first()["d"]
        rows = change.read(self.TABLE, [p for p in change.names(self.TABLE) if p == self.OPEN or p >= day]).drop("part")
        return rows.filter((F.col("effective_start_date") <= moment) & (F.col("is_active") | (F.col("effective_end_date") > moment)))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changed rows between two snapshots: insert and update carry new values, delete the old."""
    attributes = [c for c in new.columns if c not in keys]
    both = _side_by_side(old.select(*new.columns), new, keys)
    change = (F.when(F.col("o").isNull(), "insert").when(F.col("n").isNull(), "delete")
              .when(_differs(attributes, "o", "n"), "update"))
    changed = both.withColumn("change_type", change).filter(F.col("change_type").isNotNull())
    return changed.select("change_type", F.coalesce("n", "o").alias("row")).select("change_type", "row.*")


def apply_changes(old: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Snapshot after the changes of :func:`snapshot_diff`."""
    untouched = old.join(changes.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(changes.filter("change_type <> 'delete'").drop("change_type"))
