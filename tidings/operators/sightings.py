"""From raw sightings to the headlines table: typing, batch collapse, upsert, rebuild."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.functions.links import dedup_key
from tidings.functions.times import parse_iso
from tidings.schemas import HEADLINES

KEY = ["headline_id", "topic"]
ATTRIBUTES = ["title", "source", "link", "published_at"]
COLUMNS = HEADLINES.fieldNames()


def normalize(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed sightings from raw text records.

    Empty source and link become null, ISO text becomes UTC timestamps and the dedup key is
    added. An `ord` column (arrival position) is kept when present; it must be stored data,
    because row numbers handed out inside a job change when a task is retried. `keep` names more
    columns to carry along."""
    derived = {
        "headline_id": dedup_key(F.col("link"), F.col("title"), F.col("source")),
        "source": F.nullif(F.col("source"), F.lit("")),
        "link": F.nullif(F.col("link"), F.lit("")),
        "published_at": parse_iso(F.col("published_at")),
        "collected_at": parse_iso(F.col("collected_at")),
        "run_date": F.to_date("run_date"),
    }
    names = ["headline_id", "topic", *ATTRIBUTES, "collected_at", "run_date"]
    kept = [name for name in ("ord", "date", *keep) if name in records.columns]
    return records.select(
        *[derived[name].alias(name) if name in derived else F.col(name) for name in names], *kept
    )


def _arrival(sightings: DataFrame, order: list[str]) -> Column:
    """Sort key of sightings: the given columns, then the attributes so that ties are stable."""
    names = [name for name in order if name in sightings.columns]
    return F.struct(*names, "title", "link", "source", "published_at")


def collapse(sightings: DataFrame, order: tuple[str, ...] = ("collected_at", "ord")) -> DataFrame:
    """One row per story and topic: attributes of the earliest sighting, first and last times.

    A single aggregate: copies of a hot story are combined before the shuffle."""
    return (
        sightings.groupBy(*KEY)
        .agg(
            F.min_by(F.struct(*ATTRIBUTES), _arrival(sightings, list(order))).alias("first"),
            F.min("collected_at").alias("first_seen_at"),
            F.max("collected_at").alias("last_seen_at"),
            F.min("run_date").alias("first_run_date"),
            F.max("run_date").alias("last_run_date"),
        )
        .select(
            *KEY,
            *[F.col(f"first.{name}").alias(name) for name in ATTRIBUTES],
            "first_seen_at", "last_seen_at", "first_run_date", "last_run_date",
        )
    )


def seen_again(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Keys of the batch that are stored already. Reads only the two key columns of the store."""
    return stored.select(*KEY).join(batch.select(*KEY), KEY, "left_semi")


def inserted(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of the batch that are not stored yet."""
    return batch.join(seen_again(stored, batch), KEY, "left_anti")


def upsert(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The headlines table after loading one collapsed batch.

    A stored row keeps its attributes and only its first and last columns move; a new row is
    taken from the batch. The store is the streamed side of both joins: when the batch is small
    enough for Spark to broadcast it, the store is not shuffled at all, otherwise both sides
    meet on the key, which is unique on either side and so cannot be skewed."""
    moved = {"first_seen_at": F.least, "first_run_date": F.least,
             "last_seen_at": F.greatest, "last_run_date": F.greatest}
    news = batch.select(*KEY, *[F.col(name).alias(f"new_{name}") for name in moved])
    updated = stored.join(news, KEY, "left").select(
        *[
            moved[name](F.col(name), F.col(f"new_{name}")).alias(name)
            if name in moved else F.col(name)
            for name in COLUMNS
        ]
    )
    return updated.unionByName(inserted(stored, batch).select(*COLUMNS))


def upsert_counts(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """One row: inserted and seen_again, in distinct (story, topic) pairs."""
    known = seen_again(stored, batch).withColumn("known", F.lit(True))
    return batch.select(*KEY).join(known, KEY, "left").agg(
        F.count_if(F.col("known").isNull()).alias("inserted"),
        F.count_if(F.col("known")).alias("seen_again"),
    )


def rebuild(sightings: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """The headlines table from every landed partition in one pass.

    Same result as loading the partitions one after the other by date: the first loaded
    partition decides the attributes, so the partition date ranks before the collection time.
    Rows stored before outrank all of them. `sightings` carries the partition as `date`."""
    fresh = collapse(sightings, ("date", "collected_at", "ord")).select(*COLUMNS)
    return fresh if stored is None else upsert(stored, fresh)
