"""Folders on the file system Spark is configured with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, name: str) -> bool:
    path, system = _path(spark, name)
    return system.exists(path)


def remove(spark: SparkSession, name: str) -> None:
    path, system = _path(spark, name)
    system.delete(path, True)


def children(spark: SparkSession, name: str) -> list[str]:
    """Names in a folder, none if it is missing."""
    path, system = _path(spark, name)
    return [entry.getPath().getName() for entry in system.listStatus(path)] if system.exists(path) else []
