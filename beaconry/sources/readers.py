"""Readers: message queues, files as stream or batch, tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from beaconry.functions.time import AsOf, as_of_column


def with_source_file(df: DataFrame, column: str = "source_file") -> DataFrame:
    return df.withColumn(column, F.col("_metadata.file_path"))


def with_ingest_time(df: DataFrame, as_of: AsOf | None = None, column: str = "ingestion_timestamp") -> DataFrame:
    """Arrival time; a pinned ``as_of`` makes a replay repeatable."""
    return df.withColumn(column, F.current_timestamp() if as_of is None else as_of_column(as_of))


def messages_from(raw: DataFrame, message_id: str, payload: str, publish_millis: str,
                  as_of: AsOf | None = None) -> DataFrame:
    """Queue records in the common shape: id, text, publish time, arrival time."""
    return with_ingest_time(raw.select(
        F.col(message_id).cast("string").alias("message_id"), F.col(payload).cast("string").alias("value"),
        F.col(publish_millis).cast("long").alias("publish_ts_millis")), as_of)


def read_messages(spark: SparkSession, options: Mapping[str, str], fmt: str = "kafka") -> DataFrame:
    """Message stream from any Spark source.  Kafka columns are known; other sources are
    expected to deliver ``messageId``, ``payload`` and ``publishTimestampInMillis``."""
    raw = spark.readStream.format(fmt).options(**options).load()
    if fmt == "kafka":
        raw = raw.select(F.concat_ws("-", "topic", "partition", "offset").alias("messageId"),
                         F.col("value").alias("payload"),
                         F.unix_millis("timestamp").alias("publishTimestampInMillis"))
    return messages_from(raw, "messageId", "payload", "publishTimestampInMillis")


def _file_stream(spark: SparkSession, glob: str, max_files: int | None, options: Mapping[str, str]):
    reader = spark.readStream.option("pathGlobFilter", glob).options(**options)
    return reader.option("maxFilesPerTrigger", max_files) if max_files else reader


def read_json_stream(spark: SparkSession, path: str, schema: StructType, glob: str = "*.json",
                     max_files: int | None = None, **options: str) -> DataFrame:
    """New NDJSON files, existing ones first, with lineage and arrival time."""
    df = _file_stream(spark, glob, max_files, options).schema(schema).json(path)
    return with_ingest_time(with_source_file(df))


def read_text_stream(spark: SparkSession, path: str, glob: str = "*.txt", max_files: int | None = None,
                     **options: str) -> DataFrame:
    df = _file_stream(spark, glob, max_files, options).text(path)
    return with_ingest_time(with_source_file(df))


def read_csv_stream(spark: SparkSession, path: str, schema: StructType, glob: str = "*.csv",
                    max_files: int | None = None, **options: str) -> DataFrame:
    df = _file_stream(spark, glob, max_files, options).schema(schema).option("header", True).csv(path)
    return with_ingest_time(with_source_file(df))


def read_json(spark: SparkSession, path: str, schema: StructType, glob: str = "*.json") -> DataFrame:
    return with_source_file(spark.read.schema(schema).option("pathGlobFilter", glob).json(path))


def read_csv(spark: SparkSession, path: str, schema: StructType, glob: str = "*.csv") -> DataFrame:
    reader = spark.read.schema(schema).option("pathGlobFilter", glob).option("header", True)
    return with_source_file(reader.csv(path))


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def stream_table(spark: SparkSession, name: str) -> DataFrame:
    """Rows appended to a table."""
    return spark.readStream.table(name)


def stream_parquet(spark: SparkSession, path: str, schema: StructType, glob: str = "*.parquet",
                   max_files: int | None = None) -> DataFrame:
    return _file_stream(spark, glob, max_files, {}).schema(schema).parquet(path)


def external_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Columnar table another platform shares; partitions and columns are pruned at the scan."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)
