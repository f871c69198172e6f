"""Which months hold a story: a directory of story ids, bucketed by their hash.

A lookup reads the buckets of its ids only, whatever the size of the history. Entries are only ever
added, and before the version they belong to is committed: an entry can name a month that does not hold
the story (then a month is read for nothing), but none is missing. `history.compact` writes a new generation.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "headline_id string, month string"
BUCKETS = 64


def bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def entries(spark: SparkSession, folder: str, ids: DataFrame) -> DataFrame:
    """The entries of the buckets of `ids` (headline_id): at most as many buckets as ids."""
    wanted = sorted(r["b"] for r in ids.select(bucket(F.col("headline_id")).alias("b")).distinct().collect())
    if wanted:
        # a pattern, as a bucket without entries has no folder
        path = f"{folder}/bucket={{{','.join(map(str, wanted))}}}"
        try:
            return spark.read.schema(ENTRY).option("basePath", folder).parquet(path).drop("bucket")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], ENTRY)


def months_of(spark: SparkSession, folder: str, ids: DataFrame) -> set[str]:
    """Months that may hold one of `ids`."""
    found = entries(spark, folder, ids).join(ids.select("headline_id"), "headline_id", "left_semi")
    return {r["month"] for r in found.select("month").distinct().collect()}


def add(spark: SparkSession, folder: str, rows: DataFrame, known: bool = True) -> None:
    """Add the (headline_id, month) of `rows` that have no entry yet; with `known` false there are
    none to look up."""
    new = rows.select("headline_id", "month").distinct()
    if known:
        new = new.join(entries(spark, folder, new), ["headline_id", "month"], "left_anti")
    new.withColumn("bucket", bucket(F.col("headline_id"))).repartition("bucket").sortWithinPartitions("bucket", "headline_id").write.mode(
        "append").option("compression", "zstd").partitionBy("bucket").parquet(folder)
