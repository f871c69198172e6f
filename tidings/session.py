"""Session settings the operators rely on, and tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import count

from pyspark.sql import DataFrame, SparkSession

from tidings.sources.files import remove

# Skewed joins are split and small shuffles are merged at run time. Static settings such as
# memory and executor counts belong to the cluster and are left alone.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session. The session must use UTC: timestamps are
    stored without a zone and read as UTC."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str | None:
    """The folder in `spark.checkpoint.dir`, or the one given to `setCheckpointDir`."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or spark.sparkContext.getCheckpointDir()


def shared_folder(spark: SparkSession, name: str = "work") -> str:
    """A new folder under `spark.checkpoint.dir`, which every executor must be able to reach."""
    root = shared_root(spark)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def own_folder(spark: SparkSession) -> None:
    """For trial runs on one machine: a temporary shared folder where none is set."""
    if not shared_root(spark) and spark.sparkContext.master.startswith("local["):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidings-"))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """`with scratch(spark) as store:` - `store(df)` writes `df` to the shared folder and returns
    the written table.

    For a job that overwrites what it has read, or reads a costly result several times. The
    table is computed once, survives the loss of executors and goes away with the block."""
    folder = shared_folder(spark, "scratch")
    numbers = count()

    def store(df: DataFrame) -> DataFrame:
        path = f"{folder}/{next(numbers)}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield store
    finally:
        remove(spark, folder)
