"""Joins on time: intervals, windows, lookups.

A plain join on the entity compares every pair of an entity's rows.  Here the time axis is
cut into buckets that become part of the join key, so a busy entity spreads over many
tasks and only neighbours in time meet.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.functions.time import interval_micros, micros
from beaconry.session import persist_table


# Rows of one key and time bucket that a task should still take in one piece.
ROWS_PER_PART = 1_000_000


def enrich(fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join with a dimension.  No hint: the size of the dimension, read from its files or
    measured at run time, decides between broadcast and shuffle; skewed keys are split."""
    return fact.join(dim, list(on), how)


def _bucket(value: Column, width: int) -> Column:
    return value - F.pmod(value, F.lit(width))


def split_hot_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], rows_per_part: int,
                     row: str = "_row") -> tuple[DataFrame, DataFrame]:
    """Add ``_part`` to both sides so that no (keys, _part) group is large on either.

    A group over ``rows_per_part`` rows is cut by row number, so that equal rows spread too, and the
    other side's rows are repeated once per piece; a group hot on both sides becomes a raster of
    pieces.  For inner joins: each pair meets in one piece.  How the table of hot groups is joined is
    left to Spark, which measures it.
    """
    def sizes(df: DataFrame, name: str) -> DataFrame:
        return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_per_part)
                .select(*keys, F.ceil(F.col("_n") / rows_per_part).cast("int").alias(name)))

    hot = sizes(left, "_left").join(sizes(right, "_right"), list(keys), "full_outer").fillna(1, ["_left", "_right"])

    def piece(df: DataFrame, own: str, other: str, part: str) -> DataFrame:
        df = df.join(hot, list(keys), "left").fillna(1, ["_left", "_right"])
        mine = F.pmod(F.xxhash64(row), F.col(own)).cast("int")
        theirs = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return (df.withColumns({"_mine": mine, "_theirs": theirs})
                .withColumn("_part", F.expr(part)).drop("_left", "_right", "_mine", "_theirs"))

    return (piece(left, "_left", "_right", "_mine * _right + _theirs"),
            piece(right, "_right", "_left", "_theirs * _right + _mine"))


def _stored_rows(df: DataFrame, label: str) -> DataFrame:
    return persist_table(df.withColumn("_row", F.monotonically_increasing_id()), label)


def _split_interval_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str,
                         before: str | None, after: str | None, how: str, closed: tuple[bool, bool],
                         rows_per_part: int) -> DataFrame:
    """:func:`interval_join` in pieces of bounded size.

    Both inputs are stored first: they are counted and then joined.  A left join is its pairs and the left
    rows without one.  Which these are follows from :func:`interval_sums`, which forms no pairs, so that
    hot groups can be cut on both sides.
    """
    left, right = _stored_rows(left, "interval-left"), _stored_rows(right, "interval-right")
    pairs = interval_join(left, right.withColumnRenamed("_row", "_right_row"), on, left_time, right_time, before, after, "inner",
                          closed, _parts=rows_per_part).drop("_row", "_right_row")
    if how == "inner":
        return pairs
    counted = interval_sums(left, right, on, left_time, right_time, before or "0 seconds", after or "0 seconds",
                            {"_partners": F.lit(1)}, closed)
    alone = counted.filter("_partners = 0").drop("_partners", "_row")
    return pairs.unionByName(alone, allowMissingColumns=True)


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str,
                  before: str | None = None, after: str | None = None, how: str = "inner",
                  closed: tuple[bool, bool] = (True, True), rows_per_part: int | None = None,
                  _parts: int | None = None) -> DataFrame:
    """Pairs with equal keys and ``right_time`` in [left_time - before, left_time + after].

    Every left row sits in one bucket and every right row is repeated into the buckets its
    partners can be in (two at most), so no pair appears twice and outer joins stay correct.
    ``closed`` says whether the ends belong to the interval.  With ``rows_per_part`` buckets
    measured to be hot are split further, on both sides (batch only, inner and left joins: the inputs are
    stored, and the rows per bucket counted first).  Without it both sides may be streams with watermarks.
    """
    if rows_per_part:
        if how not in ("inner", "left"):
            raise ValueError("hot buckets are split in inner and left joins")
        return _split_interval_join(left, right, on, left_time, right_time, before, after, how, closed, rows_per_part)
    back, ahead = (interval_micros(before) if before else 0), (interval_micros(after) if after else 0)
    width = max(back + ahead, 1)
    lt, rt = micros(F.col(left_time)), micros(F.col(right_time))
    lhs = left.withColumn("_bucket", _bucket(lt, width))
    first, last = _bucket(rt - ahead, width), _bucket(rt + back, width)
    rhs = right.withColumn("_bucket", F.explode(F.sequence(first, last, F.lit(width))))
    keys = [*on, "_bucket"]
    if _parts:
        lhs, rhs = split_hot_groups(lhs, rhs.withColumnRenamed("_right_row", "_row"), keys, _parts)
        rhs = rhs.withColumnRenamed("_row", "_right_row")
        keys.append("_part")
    rhs = rhs.withColumnsRenamed({k: f"_r_{k}" for k in keys})

    # Interval arithmetic on the time columns themselves, which is the form from which
    # Structured Streaming derives how long join state has to be kept.
    low = F.col(left_time) - F.expr(f"INTERVAL '{back / 1e6:.6f}' SECOND")
    high = F.col(left_time) + F.expr(f"INTERVAL '{ahead / 1e6:.6f}' SECOND")
    time = F.col(right_time)
    conditions = [F.col(k) == F.col(f"_r_{k}") for k in keys]
    conditions.append(time >= low if closed[0] else time > low)
    conditions.append(time <= high if closed[1] else time < high)
    joined = lhs.join(rhs, reduce(lambda a, b: a & b, conditions), how)
    return joined.drop(*[k for k in keys if k.startswith("_")], *[f"_r_{k}" for k in keys])


def interval_sums(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str,
                  before: str, after: str, sums: dict[str, Column],
                  closed: tuple[bool, bool] = (True, True)) -> DataFrame:
    """Every left row with integer sums over the right rows in [t - before, t + after].

    Same partners as :func:`interval_join`, but no pair is ever formed.  Right rows collapse
    to one per key and time; two marks per distinct left time are laid between them on one
    sorted line, and the sum is the running total at the upper mark minus that at the lower.
    Work is n log n where pairing would be n squared.  A sorted line holds the distinct
    times of one key in one bucket, never its raw rows.
    """
    back, ahead = interval_micros(before), interval_micros(after)
    width = max(back + ahead, 1)
    names = list(sums)
    points = (left.select(*on, micros(F.col(left_time)).alias("_t")).dropna().distinct()
              .withColumn("_bucket", _bucket(F.col("_t"), width)))
    marks = points.select(*on, "_bucket", F.col("_t").alias("_point"), F.inline(F.array(
        F.struct((F.col("_t") - back - int(closed[0])).alias("_at"), F.lit(-1).alias("_sign")),
        F.struct((F.col("_t") + ahead - int(not closed[1])).alias("_at"), F.lit(1).alias("_sign")))))
    marks = marks.withColumns({name: F.lit(0).cast("long") for name in names})

    facts = right.groupBy(*on, micros(F.col(right_time)).alias("_at")).agg(
        *[F.sum(column).cast("long").alias(name) for name, column in sums.items()]).dropna(subset=[*on, "_at"])
    facts = facts.select("*", F.explode(F.sequence(
        _bucket(F.col("_at") - ahead, width), _bucket(F.col("_at") + back, width), F.lit(width))
    ).alias("_bucket"), F.lit(None).cast("long").alias("_point"), F.lit(0).alias("_sign"))

    line = Window.partitionBy(*on, "_bucket").orderBy("_at", F.abs("_sign")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    running = facts.unionByName(marks).withColumns({name: F.sum(name).over(line) for name in names})
    totals = running.filter("_sign <> 0").groupBy(*on, "_bucket", "_point").agg(
        *[F.sum(F.col("_sign") * F.col(name)).alias(name) for name in names])
    totals = totals.select(*on, F.col("_point").alias("_t"), *names)
    return (left.withColumn("_t", micros(F.col(left_time))).join(totals, [*on, "_t"], "left")
            .fillna(0, names).drop("_t"))


def window_containment_join(points: DataFrame, windows: DataFrame, on: Sequence[str], time: str,
                            width: str = "5 minutes", how: str = "left") -> DataFrame:
    """Point in [window_start, window_end).

    Tumbling windows tile the time axis, so a point's window is computed and the join is a
    plain equality on key and window start.
    """
    placed = points.withColumn("window_start", F.window(time, width)["start"])
    return placed.join(windows, [*on, "window_start"], how)


def windows_after(events: DataFrame, time: str, reach: str, width: str = "5 minutes") -> DataFrame:
    """Repeat each event for every tumbling window that starts within ``reach`` after it."""
    size, span = interval_micros(width), interval_micros(reach)
    at = micros(F.col(time))
    first = _bucket(at + (size - 1), size)       # first window start not before the event
    last = _bucket(at + span, size)
    starts = F.when(last >= first, F.sequence(first, last, F.lit(size)))
    repeated = events.withColumn("window_start", F.explode(starts))
    return repeated.withColumn("window_start", F.timestamp_micros("window_start"))
