"""Report documents as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_document(report: DataFrame) -> DataFrame:
    """One `value` column with a JSON document per row; null fields are kept."""
    fields = F.struct(*[F.col(name) for name in report.columns])
    return report.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))


def write_document(report: DataFrame, path: str) -> None:
    """Write a one-row report as one text file in the folder `path`."""
    to_document(report).coalesce(1).write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A written document as a one-row frame."""
    text = spark.read.text(path)
    return text.select(F.from_json("value", schema).alias("d")).select("d.*")
