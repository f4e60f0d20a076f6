"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

from beaconry.sinks.files import remove

# Runtime re-planning (partition coalescing, skew splitting, broadcast on measured
# size) carries most of the scale work, so it is stated rather than assumed.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    # Percentile sketches stay in a hash table up to this many groups per task; beyond, Spark sorts.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "beaconry", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own; on a cluster a
    machine-local folder would be lost with the machine, so that is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="beaconry-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


_area: ContextVar[tuple | None] = ContextVar("area", default=None)


@contextmanager
def scratch(spark: SparkSession):
    """Tables stored inside are removed at the end; those stored with ``keep`` pass to the area around, if any."""
    paths: list[str] = []
    token = _area.set((paths, _area.get()))
    try:
        yield
    finally:
        _area.reset(token)
        for path in paths:
            remove(spark, path)


def persist_table(df, label: str, keep: bool = False):
    """Cut the lineage by writing to the shared folder and reading back."""
    path = scratch_path(df.sparkSession, label)
    area = _area.get()
    if area and keep:
        area = area[1]
    if area:
        area[0].append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
