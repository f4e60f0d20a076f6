"""Schemas of file sources: inference, memory, additive evolution, rescued values."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

RESCUED = "_rescued_data"
CORRUPT = "_corrupt_record"


def infer_schema(spark: SparkSession, path: str, glob: str = "*.json", sampling: float = 1.0) -> StructType:
    """Types found in the files.  Inference reads them on the executors."""
    reader = spark.read.option("pathGlobFilter", glob).option("samplingRatio", sampling)
    return reader.json(path).schema


def save_schema(spark: SparkSession, schema: StructType, location: str) -> None:
    """Remember a schema in shared storage, next to the checkpoint of its stream."""
    spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").text(location)


def load_schema(spark: SparkSession, location: str) -> StructType | None:
    """Remembered schema, or None when there is none yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    text = "".join(row.value for row in spark.read.text(location).take(1))
    return StructType.fromJson(json.loads(text)) if text else None


def evolve_schema(old: StructType, new: StructType) -> StructType:
    """Add the columns ``old`` lacks; known columns keep their type."""
    known = {f.name.lower() for f in old.fields}
    added = [StructField(f.name, f.dataType, True) for f in new.fields if f.name.lower() not in known]
    return StructType([*old.fields, *added])


def _rescued_map(line: Column, schema: StructType, typed: Column) -> tuple[Column, Column]:
    """Values as text, and those of them the schema cannot hold."""
    text = F.from_json(line, "map<string,string>")
    names = [f.name for f in schema.fields]
    # A value that is present in the text but NULL after typing did not fit its column.
    lost = [F.when(typed[n].isNull() & text[n].isNotNull(), F.lit(n)) for n in names]
    misfits = F.array_compact(F.array(*lost)) if lost else F.array().cast("array<string>")
    unknown = F.map_filter(text, lambda k, v: ~k.isin(names) | F.array_contains(misfits, k))
    return text, unknown


def with_rescued_data(lines: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Parse JSON lines; what the schema cannot hold stays readable.

    Unknown keys and values of the wrong type go to ``_rescued_data`` as JSON text, lines
    that are no JSON object go to ``_corrupt_record``.  Works on streams.
    """
    passed = [c for c in lines.columns if c != value]
    line = F.col("_line")
    parsed = lines.withColumnRenamed(value, "_line").withColumn("_typed", F.from_json(line, schema))
    text, unknown = _rescued_map(line, schema, F.col("_typed"))
    return parsed.select(
        *[F.col("_typed")[f.name].alias(f.name) for f in schema.fields],
        F.when(F.size(unknown) > 0, F.to_json(unknown)).alias(RESCUED),
        F.when(text.isNull() & line.isNotNull(), line).alias(CORRUPT), *passed)


def unknown_columns(lines: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Keys the schema lacks, with the number of rows that carry them: the evolution signal."""
    names = [f.name for f in schema.fields]
    keys = lines.select(F.explode(F.map_keys(F.from_json(value, "map<string,string>"))).alias("column_name"))
    return keys.filter(~F.col("column_name").isin(names)).groupBy("column_name").agg(
        F.count(F.lit(1)).alias("row_count"))
