"""Streaming sinks: append, drain, merge by key."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from beaconry.sinks.parts import PartStore, day_part


@contextmanager
def _state_partitions(spark: SparkSession, count: int | None) -> Iterator[None]:
    """Number of state partitions of queries started inside; their checkpoint keeps it for good."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        if count:
            spark.conf.set(key, count)
        yield
    finally:
        spark.conf.set(key, before)


def _triggered(writer, every: str, once: bool):
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)


def write_stream(df: DataFrame, target: str, checkpoint: str, every: str = "5 seconds", once: bool = False,
                 partition_by: Sequence[str] = (), as_table: bool = False,
                 state_partitions: int | None = None) -> StreamingQuery:
    """Append to files or a table, exactly once through the checkpoint.

    ``once`` processes what is there and stops.  Delete the checkpoint for a full refresh.
    ``state_partitions`` sizes a stateful query on its first start; the number of cores of
    the cluster is a good value.
    """
    writer = _triggered(df.writeStream.outputMode("append").format("parquet")
                        .option("checkpointLocation", checkpoint), every, once)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _state_partitions(df.sparkSession, state_partitions):
        return writer.toTable(target) if as_table else writer.start(target)


def write_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "append", every: str = "5 seconds", once: bool = False,
                  state_partitions: int | None = None) -> StreamingQuery:
    """Hand every micro-batch to ``write(batch, batch_id)``, which must be repeatable."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    with _state_partitions(df.sparkSession, state_partitions):
        return _triggered(writer, every, once).start()


def append_batches(df: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Append with a schema that may grow between runs.

    A batch owns the folder ``batch=<id>``, so replaying it after a failure replaces its own
    files; read the parent with mergeSchema.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write_batches(df, write, checkpoint, **options)


ROWS, FAN = "rows", 8


def upsert(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], time: str = "window_start",
           source: str | None = None, batch: int = 0, fan: int = FAN) -> None:
    """Add changed rows of a keyed table, unless ``batch`` of ``source`` was added before.

    Rows go to the date of their time as a run of their own. ``fan`` runs of one level are merged to one
    of the next, which keeps the newest row per key; a date that has passed and had no rows in this
    batch becomes one run. So a date has few runs, however many batches there were, and a row is
    rewritten once per level.
    """
    store = PartStore(spark, path)
    change = store.current()
    if source is not None:
        if int(change.marks.get(source, -1)) >= batch:
            return
        change.marks[source] = str(batch)
    dated = rows.withColumns({"part": day_part(time), "batch": F.lit(change.number)})
    change.append(ROWS, dated, [*keys])
    newest, touched = max(change.names(ROWS), default=""), set(change.written[ROWS])
    closed = [d for d in change.names(ROWS) if d < newest and d not in touched]
    merges = len([v for d in closed for v in change.parts[ROWS][d]]) > len(closed) or any(
        len(v) >= fan for v in change.parts[ROWS].values())
    change.merge_versions(ROWS, fan, lambda df: newest_per(df, [*keys, "part"], "batch"), [*keys], closed)
    change.publish()
    if merges:
        store.vacuum(keep=fan)


def newest_per(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row of the highest ``order`` per key, all columns."""
    values = [c for c in rows.columns if c not in (*keys, order)]
    newest = rows.groupBy(*keys).agg(F.max(order).alias(order), F.max_by(F.struct(*values), order).alias("_row"))
    return newest.select(*[F.col(f"_row.`{c}`").alias(c) if c in values else F.col(c) for c in rows.columns])


def upsert_batches(df: DataFrame, path: str, checkpoint: str, keys: Sequence[str], time: str = "window_start",
                   fan: int = FAN, **options) -> StreamingQuery:
    """Changed aggregate rows of every batch of a query in update mode, see :func:`upsert`.

    A batch that is handed over again after a failure is left out. A new checkpoint counts as a new source.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        upsert(batch.sparkSession, path, batch, keys, time, query, batch_id, fan)

    return write_batches(df, write, checkpoint, mode="update", **options)


def read_latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Newest row of every key written by :func:`upsert_batches`.

    Only dates of several runs are grouped by key; of the others every row is the newest.
    """
    change = PartStore(spark, path).current()
    several = {d for d, runs in change.parts.get(ROWS, {}).items() if len(runs) > 1}
    single = change.read(ROWS, [d for d in change.names(ROWS) if d not in several])
    merged = newest_per(change.read(ROWS, sorted(several)), [*keys, "part"], "batch")
    return single.unionByName(merged).drop("batch", "part")
