"""History analytics over the good headlines: counts, activity per run date, sources."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.config import LABELS, STATUS_DAILY_RUNS, STATUS_TOP_SOURCES, UNKNOWN_SOURCE
from tidings.operators.dimensions import date_column


def latest_run_date(good: DataFrame) -> DataFrame:
    return good.agg(F.max("last_run_date").alias("run_date"))


def _first_seen_within(good: DataFrame, start, end) -> DataFrame:
    return good.filter(F.col("first_run_date").between(date_column(start), date_column(end)))


def _counted(good: DataFrame) -> bool:
    """Whether the table holds counts of rows, not rows."""
    return "n" in good.columns and "headline_id" not in good.columns


def daily_counts(good: DataFrame, start: date | str | Column, end: date | str | Column) -> DataFrame:
    """(topic, day, n): rows per topic and the day they were first seen."""
    days = _first_seen_within(good, start, end).groupBy("topic", F.col("first_run_date").alias("day"))
    return days.agg(F.sum("n").alias("n")).filter("n > 0") if _counted(good) else days.agg(F.count("*").alias("n"))


def daily_sentiment(
    good: DataFrame, sentiment: DataFrame, start: date | str | Column, end: date | str | Column
) -> DataFrame:
    """(topic, day, model, n, avg, positive, neutral, negative) by the day first seen. A story
    filed under two topics counts in both."""
    rows = _first_seen_within(good, start, end).select("headline_id", "topic", "first_run_date")
    scored = rows.join(sentiment.select("headline_id", "model", "label", "score"), "headline_id")
    return scored.groupBy("topic", F.col("first_run_date").alias("day"), "model").agg(
        F.count("*").alias("n"),
        F.avg("score").alias("avg"),
        *[F.count_if(F.col("label") == name).alias(name) for name in LABELS],
    )


def span_counts(good: DataFrame) -> DataFrame:
    """(topic, first_run_date, last_run_date, n): the small table that sizes, totals and activity are
    made of. Reports that ask for several of them read the headlines for it once, as Spark reuses
    the shuffle of equal plans. A table that is one already, such as `history.span_counts` keeps, is
    taken as it is, so every function here that counts rows by day or topic takes either."""
    if _counted(good):
        return good
    spans = [name for name in ("topic", "first_run_date", "last_run_date") if name in good.columns]
    return good.groupBy(*spans).agg(F.count("*").alias("n"))


def topic_totals(good: DataFrame) -> DataFrame:
    return span_counts(good).groupBy("topic").agg(F.sum("n").alias("n")).filter("n > 0")


def sentiment_counts(good: DataFrame, sentiment: DataFrame) -> DataFrame:
    """(model, n): good stories scored, per model."""
    return (
        sentiment.select("headline_id", "model")
        .join(good.select("headline_id"), "headline_id", "left_semi")
        .groupBy("model")
        .agg(F.count("*").alias("n"))
    )


def run_day_counts(good: DataFrame) -> DataFrame:
    """(day, n_first, n_last): rows first seen and last seen on each run date, in one pass."""
    none = F.lit(0).cast("long")
    marks = span_counts(good).select(
        F.inline(
            F.array(
                F.struct(F.col("first_run_date").alias("day"), F.col("n").alias("first"), none.alias("last")),
                F.struct(F.col("last_run_date").alias("day"), none.alias("first"), F.col("n").alias("last")),
            )
        )
    )
    return marks.groupBy("day").agg(
        F.sum("first").alias("n_first"), F.sum("last").alias("n_last")
    ).filter("n_first + n_last > 0")


def run_dates(good: DataFrame) -> DataFrame:
    """run_date: days on which some row was first or last seen, ascending."""
    return run_day_counts(good).select(F.col("day").alias("run_date")).orderBy("run_date")


def history_overview(good: DataFrame) -> DataFrame:
    """One row: headlines, first_run_date, last_run_date, run_days. Built on the per-day counts,
    so the table is read once."""
    return run_day_counts(good).agg(
        F.coalesce(F.sum("n_first"), F.lit(0)).alias("headlines"),
        F.min(F.when(F.col("n_first") > 0, F.col("day"))).alias("first_run_date"),
        F.max(F.when(F.col("n_last") > 0, F.col("day"))).alias("last_run_date"),
        F.count("*").alias("run_days"),
    )


def daily_activity(good: DataFrame, limit: int = STATUS_DAILY_RUNS) -> DataFrame:
    """(run_date, new_headlines, seen_again) for the latest `limit` run dates, ascending.

    Seen again on day d are the rows first seen before d and last seen on d or later, which is
    rows started before d minus rows ended before d. Two running sums over one row per run date
    replace a range join of days with the table; the single window task sees days only."""
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    started = F.coalesce(F.sum("n_first").over(before), F.lit(0))
    ended = F.coalesce(F.sum("n_last").over(before), F.lit(0))
    return (
        run_day_counts(good)
        .select(
            F.col("day").alias("run_date"),
            F.col("n_first").alias("new_headlines"),
            (started - ended).alias("seen_again"),
        )
        .orderBy(F.desc("run_date"))
        .limit(limit)
        .orderBy("run_date")
    )


def top_sources(good: DataFrame, limit: int = STATUS_TOP_SOURCES) -> DataFrame:
    """(source, n): publishers with the most distinct stories, ties by name. Distinct ids are
    counted in two steps, so a publisher with a third of all stories is spread over tasks."""
    return (
        good.groupBy(F.coalesce("source", F.lit(UNKNOWN_SOURCE)).alias("source"))
        .agg(F.count_distinct("headline_id").alias("n"))
        .orderBy(F.desc("n"), "source")
        .limit(limit)
    )
