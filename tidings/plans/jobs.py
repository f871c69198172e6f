"""Jobs: load, replay, backfill, compare. Each reads landed data and writes tables and reports.

The driver holds settings, run counters and lists of dates and months; rows stay on executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.config import BACKFILL_TAG, DEFAULT_MODELS, MAX_PER_TOPIC, TOPICS, TREND_DAYS, topic_list
from tidings.functions.quality import is_low_quality
from tidings.functions.times import edition_day, on_utc_day
from tidings.operators import activity, quality, scoring, sightings
from tidings.operators.dimensions import missing_dates
from tidings.operators.editions import edition
from tidings.plans import reports
from tidings.session import scratch
from tidings.sources import documents, feeds, history, raw

LANE = 500  # stories a scoring task gets


@dataclass(frozen=True)
class Paths:
    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def history(self) -> str:
        return f"{self.root}/history"

    def report(self, name: str) -> str:
        return f"{self.root}/reports/{name}"


def load_summary(stored: DataFrame, loaded: DataFrame) -> DataFrame:
    """One row: raw_records, inserted, seen_again, flagged for sightings with a partition `date`.

    Counts as if the partitions were loaded one by one: a new pair is inserted once and seen
    again in each later partition, a stored pair is seen again in every one."""
    key = sightings.KEY
    per_partition = loaded.groupBy(*key, "date").agg(
        F.count("*").alias("records"),
        F.count_if(is_low_quality(F.col("title"))).alias("flagged"),
    )
    per_key = per_partition.groupBy(*key).agg(
        F.sum("records").alias("records"), F.sum("flagged").alias("flagged"),
        F.count("*").alias("partitions"),
    )
    known = sightings.seen_again(stored, per_key).withColumn("known", F.lit(True))
    is_new = F.col("known").isNull()
    return per_key.join(known, key, "left").agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("raw_records"),
        F.count_if(is_new).alias("inserted"),
        F.coalesce(F.sum(F.col("partitions") - is_new.cast("int")), F.lit(0)).alias("seen_again"),
        F.coalesce(F.sum("flagged"), F.lit(0)).alias("flagged"),
    )


def write_reports(
    spark: SparkSession, paths: Paths, *, run: dict | None = None, topics=TOPICS,
    limit: int = MAX_PER_TOPIC, generated_at=None,
) -> None:
    """latest, trends and status documents from the stored history."""
    headlines = history.read_table(spark, paths.history, "headlines")
    sentiment = history.read_table(spark, paths.history, "sentiment")
    with scratch(spark) as store:
        # the ids of flagged stories are shared; the headlines are read by each report anew, since
        # each wants other columns and days
        flagged = store(history.flagged_titles(spark, paths.history))
        good = quality.good_headlines(headlines, flagged)
        # kept beside the history: what counts rows by day and topic does not read the headlines
        spans = store(history.span_counts(spark, paths.history))
        latest = activity.latest_run_date(spans.filter("n > 0")).first()["run_date"]
        # a stored edition has a known size, so the scores are looked up without moving them
        shown = store(edition(good, latest if latest is not None else F.lit(None).cast("date"), limit))
        documents.write_document(
            reports.latest_report(
                good, sentiment, run_date=latest, topics=topics, limit=limit,
                generated_at=generated_at, rows=shown,
            ),
            paths.report("latest"),
        )
        recent = good
        if latest is not None:
            # only the months of the window are listed and read
            recent = history.within(good, latest - timedelta(days=TREND_DAYS - 1), latest)
        documents.write_document(
            reports.trends_report(
                recent, sentiment, end_date=latest, topics=topics, generated_at=generated_at, spans=spans
            ),
            paths.report("trends"),
        )
        documents.write_document(
            reports.status_report(
                headlines, sentiment, run=run, topics=topics, limit=limit, flagged=flagged, run_date=latest, spans=spans,
                parquet_files=history.count_files(spark, paths.history), generated_at=generated_at,
            ),
            paths.report("status"),
        )


def load_records(
    spark: SparkSession, paths: Paths, records: DataFrame, scorers: dict[str, scoring.Scorer],
    *, now, run: dict, topics=TOPICS,
) -> dict:
    """Load raw records (with their partition `date`) on top of the history, score what is
    missing, write tables and reports. Returns `run` with the counts filled in; `unreadable_times`
    are the records whose `collected_at` is missing or no time, which load without it."""
    stored = history.load_history(spark, paths.history)
    run["history_before"] = stored["headlines"].count()
    with scratch(spark) as store:
        loaded = store(sightings.normalize(records))  # keys are worked out once, then counted and loaded
        counts = load_summary(stored["headlines"], loaded).first()
        run["unreadable_times"] = loaded.filter("collected_at IS NULL").count()
        history.upsert_months(spark, paths.history, sightings.rebuild(loaded))
    run.update(
        raw_records=counts["raw_records"], inserted=counts["inserted"],
        seen_again=counts["seen_again"],
        filtered_low_quality=run.get("filtered_low_quality", 0) + counts["flagged"],
    )
    run["scored"] = score_history(spark, paths, scorers, now)
    run["history_after"] = history.read_table(spark, paths.history, "headlines").count()
    write_reports(spark, paths, run=run, topics=topics, generated_at=now)
    return run


def score_history(
    spark: SparkSession, paths: Paths, scorers: dict[str, scoring.Scorer], now, only: DataFrame | None = None,
) -> dict[str, int]:
    """Score every good story a model has not scored, or those with an id in `only`, of which the
    months they lie in are read; returns new scores per model."""
    if only is None:
        tables, flagged = history.load_history(spark, paths.history), history.flagged_titles(spark, paths.history)
    else:
        tables, flagged = {name: history.stories(spark, paths.history, name, only) for name in history.TABLES}, None
    scored = {}
    with scratch(spark) as store:
        # the rules meet each title once, whatever the number of models
        good = store(quality.good_headlines(tables["headlines"], flagged).select("headline_id", "title"))
        for name, scorer in scorers.items():
            stories = store(scoring.pending(good, tables["sentiment"], name))
            lanes = -(-stories.count() // LANE)
            if not lanes:
                scored[name] = 0
                continue
            # few bytes but much work per row: Spark would merge small partitions, a stated number stays.
            # A model may be slow: its answers are stored once, then counted and appended
            rows = store(scoring.score_stories(stories.repartition(lanes), name, scorer, now))
            scored[name] = rows.count()
            history.append_sentiment(spark, paths.history, rows)
    return scored


def run_day(
    spark: SparkSession, paths: Paths, run_date: date, *, now,
    collected: DataFrame | None = None, models: Sequence[str] = DEFAULT_MODELS,
    registry: scoring.ScorerRegistry | None = None, topics=TOPICS, run: dict | None = None,
) -> dict:
    """One run date: land `collected` raw records, or replay what was landed, then load.

    The load always reads the landed files, so a later replay sees the same input."""
    scorers = (registry or scoring.default_registry()).choose(models)
    if str(run_date) > str(now)[:10]:
        raise ValueError(f"run date {run_date} is in the future")
    run = {
        "run_date": str(run_date), "mode": "replay" if collected is None else "fetch",
        "failed_topics": [], "filtered_low_quality": 0, "requests": 0, "backfill": None,
        **(run or {}),
    }
    if collected is not None:
        raw.write_partitions(spark, paths.raw, collected.withColumn("date", F.lit(str(run_date))))
    batch = raw.read_partition(spark, paths.raw, run_date)
    if collected is None and batch.isEmpty():
        raise FileNotFoundError(f"no raw partition for {run_date} under {paths.raw}")
    return load_records(spark, paths, batch, scorers, now=now, run=run, topics=topics)


def without_document(run_dates: DataFrame, documents_: DataFrame, topics=TOPICS) -> DataFrame:
    """(run_date, ord, topic): configured topics that have no landed document on a run date. A
    document without items counts as landed. `documents_` may be their items instead, of which such
    a document has a row as well."""
    named = [
        F.struct(F.lit(i).alias("ord"), F.lit(t.label).alias("topic"))
        for i, t in enumerate(topic_list(topics))
    ]
    feed = ["run_date", "topic"]
    return run_dates.select("run_date", F.inline(F.array(*named))).join(
        documents_.select(*feed), feed, "left_anti"
    )


def _low_quality(items: DataFrame) -> int:
    return items.filter(F.col("dropped") == "low_quality").count()


def run_feed_day(
    spark: SparkSession, paths: Paths, documents_: DataFrame, run_date: date, *, now,
    models: Sequence[str] = DEFAULT_MODELS, registry: scoring.ScorerRegistry | None = None,
    topics=TOPICS, order: list[str] = [], limit: int = MAX_PER_TOPIC,
) -> dict:
    """One run date from its landed feed documents: parse, land, load.

    A configured topic without a document has failed; when all have, nothing is landed or loaded.
    What the quality filter drops here is counted together with what the load flags."""
    (registry or scoring.default_registry()).choose(models)  # an unknown name fails first
    day = F.to_date(F.lit(str(run_date)))
    given = documents_.filter(F.col("run_date") == day)
    wanted = spark.range(1).select(day.alias("run_date"))
    with scratch(spark) as store:
        items = store(feeds.read_items(given, feeds.daily_window(), order))  # counted and landed
        failed = [r["topic"] for r in without_document(wanted, items, topics).orderBy("ord").collect()]
        if len(failed) == len(topic_list(topics)):
            raise RuntimeError(f"no topic has a feed document for {run_date}")
        return run_day(
            spark, paths, run_date, now=now, models=models, registry=registry, topics=topics,
            collected=feeds.feed_records(items, position=[*order, "position"], limit=limit),
            run={"failed_topics": failed, "filtered_low_quality": _low_quality(items)},
        )


def _backfill_items(documents_: DataFrame, missing: DataFrame, order: list[str]) -> DataFrame:
    """Classified items of the documents of the given run dates."""
    wanted = documents_.join(missing, "run_date", "left_semi")
    return feeds.read_items(
        wanted, lambda published: on_utc_day(published, edition_day(F.col("run_date"))), order
    )


def _backfilled(items: DataFrame, limit: int, order: list[str]) -> DataFrame:
    records = feeds.feed_records(
        items, position=[*order, "position"], limit=limit, extra={"collection": BACKFILL_TAG}
    )
    return records.withColumn("date", F.col("run_date"))


def backfill_records(
    documents_: DataFrame, landed: DataFrame, today, days: int, *,
    limit: int = MAX_PER_TOPIC, order: list[str] = [],
) -> tuple[DataFrame, DataFrame]:
    """(records, drop counts) for the run dates a backfill covers that have no partition yet.

    A document of run date R gives the items published on the UTC day before R. Records carry
    the backfill tag and their partition in `date`."""
    items = _backfill_items(documents_, missing_dates(landed, today, days), order)
    return _backfilled(items, limit, order), feeds.drop_counts(items)


def run_backfill(
    spark: SparkSession, paths: Paths, documents_: DataFrame, *, today: date, days: int, now,
    models: Sequence[str] = DEFAULT_MODELS, registry: scoring.ScorerRegistry | None = None,
    topics=TOPICS, order: list[str] = [], limit: int = MAX_PER_TOPIC,
) -> dict:
    """Land the missing run dates from feed documents, then load every landed partition.

    Dates with a partition are skipped; a date without items is not written and stays missing,
    so a later backfill tries it again. A configured topic without a document on a missing date
    is listed as failed, with the date."""
    scorers = (registry or scoring.default_registry()).choose(models)
    landed = raw.partition_dates(spark, paths.raw)
    # at most BACKFILL_MAX_DAYS dates reach the driver; the landed files are listed once
    span = missing_dates(landed.limit(0), today, days).join(
        landed.withColumn("known", F.lit(True)), "run_date", "left"
    ).orderBy("run_date").collect()
    covered = [str(r["run_date"]) for r in span]
    missing = [str(r["run_date"]) for r in span if not r["known"]]
    open_dates = spark.createDataFrame([(r["run_date"],) for r in span if not r["known"]], "run_date date")
    with scratch(spark) as store:
        items = store(_backfill_items(documents_, open_dates, order))  # counted and landed
        # at most one line per missing date and configured topic
        failed = [
            f"{r['topic']} ({r['run_date']})"
            for r in without_document(open_dates, items, topics).orderBy("run_date", "ord").collect()
        ]
        dropped = _low_quality(items)
        written = raw.write_partitions(spark, paths.raw, _backfilled(items, limit, order))
        per_day = written.groupBy("date").agg(F.sum("n").alias("n"))
        fetched = {r["date"]: r["n"] for r in per_day.collect()}
    run = {
        "run_date": covered[-1], "mode": "backfill", "failed_topics": failed,
        "filtered_low_quality": dropped, "requests": 0,
        "backfill": {
            "days": days, "first_run_date": covered[0], "last_run_date": covered[-1],
            "fetched": sorted(fetched),
            "skipped": [d for d in covered if d not in missing],
            "empty": sorted(d for d in missing if d not in fetched),
            "records": sum(fetched.values()),
        },
    }
    return load_records(spark, paths, raw.dated(raw.read_raw(spark, paths.raw)), scorers, now=now, run=run, topics=topics)


def compare(
    spark: SparkSession, paths: Paths, model_a: str = "vader", model_b: str = "finbert", *,
    topics=TOPICS, generated_at=None,
) -> DataFrame:
    """Agreement of two models over the stored history, written as a document and returned."""
    tables = history.load_history(spark, paths.history)
    good = quality.good_headlines(tables["headlines"])
    with scratch(spark) as store:
        pairs = store(reports.report_pairs(good, tables["sentiment"], model_a, model_b))
        report = reports.agreement_report(
            good, tables["sentiment"], model_a, model_b, topics=topics, generated_at=generated_at, pairs=pairs
        )
        documents.write_document(report, paths.report("agreement"))
        schema = report.schema
    return documents.read_document(spark, paths.report("agreement"), schema)

