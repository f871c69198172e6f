"""The daily edition, its scores, and the dedup and cap of collected items."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.config import MAX_PER_TOPIC
from tidings.operators.activity import latest_run_date
from tidings.operators.dimensions import date_column

EDITION_COLUMNS = ["topic", "headline_id", "title", "source", "link", "published_at"]


def edition_date(good: DataFrame, run_date: date | str | Column | None = None) -> Column:
    """The given run date, or the latest one in the table as a scalar subquery."""
    return latest_run_date(good).scalar() if run_date is None else date_column(run_date)


def edition(
    good: DataFrame, run_date: date | str | Column | None = None, limit: int = MAX_PER_TOPIC
) -> DataFrame:
    """Headlines seen on a run date, the newest `limit` per topic, in `place` order.

    Spark keeps the best rows of each topic before the shuffle, so a topic that holds most of
    the rows sends `limit` rows per task and no more."""
    newest = Window.partitionBy("topic").orderBy(
        F.col("published_at").desc_nulls_last(), "headline_id"
    )
    day = edition_date(good, run_date)
    return (
        good.filter(day.between(F.col("first_run_date"), F.col("last_run_date")))
        .select(*EDITION_COLUMNS, F.row_number().over(newest).alias("place"))
        .filter(F.col("place") <= limit)
    )


def scores_by_story(sentiment: DataFrame, stories: DataFrame) -> DataFrame:
    """(headline_id, scores) with scores as map<model, struct<label, score>> for the listed
    stories. A map holds one entry per model."""
    entries = F.collect_list(F.struct("model", F.struct("label", "score")))
    return (
        sentiment.join(stories.select("headline_id"), "headline_id", "left_semi")
        .groupBy("headline_id")
        .agg(F.map_from_entries(F.array_sort(entries)).alias("scores"))
    )


def dedup_and_cap(
    items: DataFrame,
    feed: list[str],
    *,
    newest: str = "published_at",
    position: list[str],
    limit: int = MAX_PER_TOPIC,
) -> DataFrame:
    """The newest `limit` distinct stories of every feed, numbered from 1 in `place`.

    `feed` names the grouping columns, `position` the order of items in the feed, which decides
    between items of the same time. Both ranks drop rows before their shuffle: repeated links of
    a hot story first, then everything beyond the cap."""
    order = [F.col(newest).desc_nulls_last(), *position]
    copy = F.row_number().over(Window.partitionBy(*feed, "headline_id").orderBy(*order))
    place = F.row_number().over(Window.partitionBy(*feed).orderBy(*order))
    return (
        items.withColumn("_copy", copy)
        .filter("_copy = 1")
        .drop("_copy")
        .withColumn("place", place)
        .filter(F.col("place") <= limit)
    )
