"""Tables: write, register, describe, compact, inspect."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.sinks.files import exists, names_in


def write_table(df: DataFrame, name: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                sort_by: Sequence[str] = (), fmt: str = "parquet", path: str | None = None) -> DataFrame:
    """Save as a table.

    Rows are clustered by the partition columns plus a spread over ``spark.sql.shuffle.partitions``
    only where AQE finds it useful (``rebalance`` splits large and merges small partitions), and
    sorted inside files so that row-group statistics skip on ``sort_by``.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def table_writer(spark: SparkSession, root: str) -> Callable[[str, DataFrame], DataFrame]:
    """``save(name, df)`` for a refresh: rows of one entity and time close together so that later
    filters skip row groups.  Each writer has a version folder of its own under ``root/name``, so
    readers of the version before are not disturbed; :func:`latest_table` finds the newest."""
    version = time.time_ns()

    def save(name: str, df: DataFrame) -> DataFrame:
        order = [c for c in ("device_id", "store_id", "window_start", "event_timestamp", "hour_start")
                 if c in df.columns]
        out = df.hint("rebalance")
        path = f"{root}/{name}/version={version}"
        (out.sortWithinPartitions(*order) if order else out).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return save


def latest_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest version that :func:`table_writer` wrote to its end; a run that died left no mark of success."""
    for version in reversed(names_in(spark, f"{root}/{name}")):
        if version.startswith("version=") and exists(spark, f"{root}/{name}/{version}/_SUCCESS"):
            return spark.read.parquet(f"{root}/{name}/{version}")
    raise FileNotFoundError(f"no version of {name} below {root}")


def append_merging_schema(df: DataFrame, path: str) -> None:
    """Append files whose columns may be more or fewer than before; read with mergeSchema."""
    df.write.mode("append").parquet(path)


def read_merging_schema(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def set_table_props(spark: SparkSession, name: str, props: Mapping[str, str], comment: str | None = None) -> None:
    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    if props:
        pairs = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in props.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {name} IS {quoted(comment)}")


def compact(spark: SparkSession, source: str, target: str, partition_by: Sequence[str] = (),
            sort_by: Sequence[str] = ()) -> DataFrame:
    """Rewrite many small files as few; the source stays until the caller drops it."""
    df = read_merging_schema(spark, source).hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)
    return spark.read.parquet(target)


def analyze(spark: SparkSession, name: str) -> None:
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name and row count, one row per table."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))


def describe(df: DataFrame) -> Iterable[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
