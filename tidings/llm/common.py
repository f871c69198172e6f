"""What the operators share: ASCII lower case, words, splits by id, stored tables."""

from __future__ import annotations

import string
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.session import shared_folder

# functions of this package travel to the executors as code, so nothing has to be installed there
cloudpickle.register_pickle_by_value(sys.modules["tidings.llm"])


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is. `lower` does it where all is ASCII."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words(text: Column, separators: str) -> Column:
    """The non-empty pieces between runs of `separators`; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def remainder(doc_id: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; null ids count as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % divisor


def spare(name: str, columns: list[str]) -> str:
    """`name`, lengthened until no column is called so, whatever the case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back: computed once, independent of executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
