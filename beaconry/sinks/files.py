"""Folders in the storage that Spark reads, whatever it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    files, location = _at(spark, path)
    return files.exists(location)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    files, location = _at(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(location)) if files.exists(location) else []


def move(spark: SparkSession, old: str, new: str) -> None:
    """Rename a folder to a name that must be free."""
    files, source = _at(spark, old)
    target = spark._jvm.org.apache.hadoop.fs.Path(new)
    if files.exists(target) or not files.rename(source, target):
        raise FileExistsError(f"cannot rename {old} to {new}")


def remove(spark: SparkSession, path: str) -> None:
    files, location = _at(spark, path)
    files.delete(location, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    files, location = _at(spark, path)
    out = files.create(location, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    files, location = _at(spark, path)
    content = files.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(content, "UTF-8")
    finally:
        content.close()
