"""Small frames made from settings: topics and calendars."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.config import TOPICS, topic_list
from tidings.functions.times import backfill_dates


def topic_frame(spark: SparkSession, topics=TOPICS) -> DataFrame:
    """(ord, topic, query) in display order. The list is settings; Spark knows the
    size of literals."""
    rows = [
        F.struct(
            F.lit(i).alias("ord"), F.lit(t.label).alias("topic"), F.lit(t.query).alias("query")
        )
        for i, t in enumerate(topic_list(topics))
    ]
    if not rows:
        return spark.range(0).selectExpr("0 AS ord", "'' AS topic", "'' AS query")
    return spark.range(1).select(F.inline(F.array(*rows)))


def date_column(value: date | str | Column) -> Column:
    """A date literal, or a date column passed through (a scalar subquery, for instance)."""
    return value if isinstance(value, Column) else F.to_date(F.lit(str(value)))


def topic_calendar(spark: SparkSession, topics, end: date | str | Column, days: int) -> DataFrame:
    """(ord, topic, day) for the last `days` days up to `end`: each topic row explodes into its
    days, no cross join."""
    if days < 1:
        raise ValueError("days must be at least 1")
    last = date_column(end)
    span = F.sequence(F.date_sub(last, days - 1), last)
    return topic_frame(spark, topics).select("ord", "topic", F.explode(span).alias("day"))


def missing_dates(landed: DataFrame, today: date | str | Column, days: int) -> DataFrame:
    """run_date for each date a backfill covers that has no landed partition; `landed` has one
    row per partition in `run_date`."""
    spark = landed.sparkSession
    wanted = spark.range(1).select(
        F.explode(backfill_dates(date_column(today), days)).alias("run_date")
    )
    return wanted.join(landed.select("run_date"), "run_date", "left_anti")
