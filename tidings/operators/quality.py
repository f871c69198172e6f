"""The quality view: stories flagged by a title, and the rows that remain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.functions.quality import RULES, is_low_quality, low_quality_reason


def with_reason(records: DataFrame, rules=RULES) -> DataFrame:
    return records.withColumn("reason", low_quality_reason(F.col("title"), rules))


def split(records: DataFrame, rules=RULES) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped) records."""
    low = is_low_quality(F.col("title"), rules)
    return records.filter(~low), records.filter(low)


def flagged_stories(headlines: DataFrame, rules=RULES) -> DataFrame:
    """headline_id, reason for every story with a failing title under any topic; the reason
    comes from the first failing title.

    The rules run where the titles are read and only failing rows are shuffled. Collapsing
    equal titles first would shuffle every title to save a few pattern matches."""
    failing = with_reason(headlines.select("headline_id", "title"), rules)
    return (
        failing.filter(F.col("reason").isNotNull())
        .groupBy("headline_id")
        .agg(F.min_by("reason", "title").alias("reason"))
    )


def good_headlines(headlines: DataFrame, flagged: DataFrame | None = None) -> DataFrame:
    """Headlines without flagged stories. Spark broadcasts the flagged ids when it measures
    them as small and meets on the id otherwise.

    `flagged` takes a stored result of `flagged_stories`. Several reports can then share the
    pattern matching, and each still reads only the columns and days it needs."""
    ids = flagged_stories(headlines) if flagged is None else flagged
    return headlines.join(ids.select("headline_id"), "headline_id", "left_anti").select(
        *headlines.columns
    )


def hidden_rows(headlines: DataFrame, flagged: DataFrame | None = None) -> DataFrame:
    """One row: how many (story, topic) rows the filter hides."""
    ids = flagged_stories(headlines) if flagged is None else flagged
    hidden = headlines.select("headline_id").join(ids.select("headline_id"), "headline_id", "left_semi")
    return hidden.agg(F.count("*").alias("excluded_low_quality"))
