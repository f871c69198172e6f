"""The four reports: latest edition, trends, agreement, status.

Each has a flat form (rows for tables and further queries) and a document form (one row with
nested columns). A document holds bounded lists only: an edition is `limit` rows per configured
topic, a series is one entry per topic and day, samples have their own limits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings import __version__
from tidings.config import (
    DISAGREEMENTS, LABELS, MAX_PER_TOPIC, SCHEDULE, SCORE_PAIRS, STATUS_DAILY_RUNS,
    STATUS_TOP_SOURCES, TOPICS, TREND_DAYS, UNKNOWN_SOURCE,
)
from tidings.functions.labels import primary_model
from tidings.functions.times import edition_label, to_iso, utc
from tidings.operators import activity, agreement, quality
from tidings.operators.dimensions import topic_calendar, topic_frame
from tidings.operators.editions import edition, edition_date, scores_by_story

ARTICLE = ["id", "title", "source", "link", "published", "sentiment", "scores"]
STATS = ["avg", "n", *LABELS]
_STATS_TYPE = "struct<avg:double,n:bigint,positive:bigint,neutral:bigint,negative:bigint>"


def _one_row(like: DataFrame, **columns: Column) -> DataFrame:
    return like.sparkSession.range(1).select(*[c.alias(n) for n, c in columns.items()])


def _stamp(generated_at) -> Column:
    now = F.date_trunc("second", F.current_timestamp()).cast("timestamp_ntz")
    return to_iso(now if generated_at is None else utc(generated_at))


def _ordered(place: list[str], fields: list[str]) -> Column:
    """Aggregate: array<struct<fields>> in `place` order. The fields may hold maps, which have no
    order, so only the place is compared."""
    rows = F.collect_list(F.struct(F.struct(*place).alias("_at"), F.struct(*fields).alias("_row")))
    in_order = F.array_sort(
        rows,
        lambda x, y: F.when(x["_at"] < y["_at"], -1).when(x["_at"] > y["_at"], 1).otherwise(0),
    )
    return F.transform(in_order, lambda r: r["_row"])


def _sorted_list(frame: DataFrame, place: list[str], fields: list[str]) -> Column:
    """A bounded frame as one ordered array, as a scalar subquery."""
    return frame.agg(_ordered(place, fields).alias("rows")).scalar()


def _name_list(frame: DataFrame, column: str) -> Column:
    return frame.agg(F.array_sort(F.collect_set(column)).alias("names")).scalar()


# latest


def edition_articles(
    good: DataFrame, sentiment: DataFrame, run_date=None, limit: int = MAX_PER_TOPIC,
    rows: DataFrame | None = None,
) -> DataFrame:
    """(topic, place, id, title, source, link, published, sentiment, scores): the edition with
    every model's score; `sentiment` is the preferred model's one, null without any. `rows`
    takes a stored result of `edition`."""
    rows = edition(good, run_date, limit) if rows is None else rows
    scores = F.coalesce("scores", F.from_json(F.lit("{}"), "map<string,struct<label:string,score:double>>"))
    best = primary_model(F.map_keys("scores"))
    return (
        rows.join(scores_by_story(sentiment, rows), "headline_id", "left")
        .withColumn("scores", scores)
        .withColumn("model", best)
        .withColumn("chosen", F.try_element_at("scores", F.col("model")))
        .select(
            "topic", "place", F.col("headline_id").alias("id"), "title",
            F.coalesce("source", F.lit(UNKNOWN_SOURCE)).alias("source"),
            F.coalesce("link", F.lit("")).alias("link"),
            to_iso(F.col("published_at")).alias("published"),
            F.when(
                F.col("model").isNotNull(),
                F.struct("model", F.col("chosen.label").alias("label"), F.col("chosen.score").alias("score")),
            ).alias("sentiment"),
            "scores",
        )
    )


def latest_report(
    good: DataFrame, sentiment: DataFrame, *, run_date=None, topics=TOPICS,
    limit: int = MAX_PER_TOPIC, generated_at=None, rows: DataFrame | None = None,
) -> DataFrame:
    """One row: the edition per configured topic, empty topics kept."""
    articles = edition_articles(good, sentiment, run_date, limit, rows)
    dimension = topic_frame(good.sparkSession, topics)
    by_topic = (
        articles.join(dimension.select("topic"), "topic", "left_semi")
        .groupBy("topic")
        .agg(_ordered(["place"], ARTICLE).alias("articles"))
    )
    blocks = dimension.join(by_topic, "topic", "left").select(
        "ord", F.col("topic").alias("label"), "query",
        F.coalesce("articles", F.array().cast(by_topic.schema["articles"].dataType)).alias("articles"),
    )
    models = _name_list(articles.select(F.explode(F.map_keys("scores")).alias("model")), "model")
    head = _one_row(
        good,
        generated_at=_stamp(generated_at),
        _day=edition_date(good, run_date),
        models=models,
        topics=_sorted_list(blocks, ["ord"], ["label", "query", "articles"]),
    )
    return head.select(
        "generated_at",
        F.col("_day").cast("string").alias("run_date"),
        edition_label(F.col("_day")).alias("date_label"),
        "models",
        primary_model(F.col("models")).alias("primary_model"),
        "topics",
    )


def edition_of_topic(latest: DataFrame, label: str) -> DataFrame:
    """The block of one topic with the edition's own fields; the label's case does not matter."""
    return latest.select(
        "generated_at", "run_date", "date_label", "primary_model", F.inline("topics")
    ).filter(F.lower("label") == label.lower())


# trends


def trend_series(
    good: DataFrame, sentiment: DataFrame, *, end_date=None, days: int = TREND_DAYS, topics=TOPICS,
    spans: DataFrame | None = None,
) -> DataFrame:
    """(ord, topic, day, count, sentiment): a row for every configured topic and day; sentiment
    is map<model, struct<avg, n, positive, neutral, negative>>, empty on a day without scores.
    `spans` takes the counts kept with the history."""
    end = edition_date(good, end_date)
    start = F.date_sub(end, days - 1)
    counts = activity.daily_counts(good if spans is None else spans, start, end).withColumnRenamed("n", "count")
    stats = activity.daily_sentiment(good, sentiment, start, end).withColumn("avg", F.round("avg", 4))
    entries = F.array_sort(F.collect_list(F.struct("model", F.struct(*STATS).alias("stats"))))
    per_day = stats.groupBy("topic", "day").agg(F.map_from_entries(entries).alias("sentiment"))
    empty = F.from_json(F.lit("{}"), f"map<string,{_STATS_TYPE}>")
    return (
        topic_calendar(good.sparkSession, topics, end, days)
        .join(counts, ["topic", "day"], "left")
        .join(per_day, ["topic", "day"], "left")
        .select(
            "ord", "topic", "day",
            F.coalesce("count", F.lit(0)).alias("count"),
            F.coalesce(F.col("sentiment").cast(f"map<string,{_STATS_TYPE}>"), empty).alias("sentiment"),
        )
    )


def trend_rows(series: DataFrame) -> DataFrame:
    """(topic, day, count, model, avg, n, positive, neutral, negative): the series with a row per
    model, and one row with nulls for a day nobody scored."""
    return series.select("ord", "topic", "day", "count", F.explode_outer("sentiment").alias("model", "s")).select(
        "ord", "topic", "day", "count", "model", *[F.col(f"s.{name}").alias(name) for name in STATS]
    )


def trends_report(
    good: DataFrame, sentiment: DataFrame, *, end_date=None, days: int = TREND_DAYS,
    topics=TOPICS, generated_at=None, spans: DataFrame | None = None,
) -> DataFrame:
    """One row: per topic a dense daily series with count and per-model numbers."""
    series = trend_series(good, sentiment, end_date=end_date, days=days, topics=topics, spans=spans)
    found = series.withColumn("date", F.col("day").cast("string")).groupBy("topic").agg(
        _ordered(["day"], ["date", "count", "sentiment"]).alias("series")
    )
    # without any edition there is no calendar, and the topics stay with empty series
    blocks = topic_frame(good.sparkSession, topics).join(found, "topic", "left").select(
        "ord", F.col("topic").alias("label"),
        F.coalesce("series", F.array().cast(found.schema["series"].dataType)).alias("series"),
    )
    end = edition_date(good, end_date)
    models = _name_list(trend_rows(series), "model")
    head = _one_row(
        good, generated_at=_stamp(generated_at), _end=end, models=models,
        topics=_sorted_list(blocks, ["ord"], ["label", "series"]),
    )
    return head.select(
        "generated_at",
        F.date_sub("_end", days - 1).cast("string").alias("start_date"),
        F.col("_end").cast("string").alias("end_date"),
        F.lit(days).alias("days"),
        "models",
        primary_model(F.col("models")).alias("primary_model"),
        "topics",
    )


# agreement


def agreement_numbers(stories: DataFrame) -> DataFrame:
    """One row: n, percent_agreement, cohens_kappa, score_correlation; each story counts once."""
    numbers = agreement.label_agreement(agreement.label_cells(stories))
    return numbers.select("*", agreement.score_correlation(stories).scalar().alias("score_correlation"))


def report_pairs(good: DataFrame, sentiment: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """`paired_scores` without the texts, which no number of the report needs."""
    return agreement.paired_scores(good, sentiment, model_a, model_b).drop("title", "source", "link")


def agreement_report(
    good: DataFrame, sentiment: DataFrame, model_a: str = "vader", model_b: str = "finbert", *,
    topics=TOPICS, generated_at=None, max_score_pairs: int = SCORE_PAIRS,
    max_disagreements: int = DISAGREEMENTS, pairs: DataFrame | None = None,
) -> DataFrame:
    """One row: agreement of two models over the whole history. `pairs` takes a stored result of
    `report_pairs`; the parts below read it several times."""
    paired = report_pairs(good, sentiment, model_a, model_b) if pairs is None else pairs
    stories = agreement.one_row_per_story(paired, topics)
    cells = agreement.label_cells(stories)

    matrix = agreement.confusion_matrix(cells)
    rows = matrix.groupBy("row").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("col", "n"))), lambda c: c["n"]).alias("cells")
    )
    counts = agreement.label_distribution(cells, model_a, model_b)
    per_model = counts.groupBy("model").agg(
        F.map_from_entries(
            F.transform(
                F.array_sort(F.collect_list(F.struct("place", "label", "n"))),
                lambda c: F.struct(c["label"], c["n"]),
            )
        ).alias("labels")
    )
    # texts are looked up for the listed stories only
    texts = good.select("headline_id", "topic", "title", "source", "link")
    listed = agreement.disagreements(stories, max_disagreements)
    differing = listed.join(texts, ["headline_id", "topic"]).select(
        (-F.unix_date("last_run_date")).alias("age"),
        (-F.abs(F.col("score_b") - F.col("score_a"))).alias("closeness"),
        F.col("headline_id").alias("id"), "topic", "title",
        F.coalesce("source", F.lit(UNKNOWN_SOURCE)).alias("source"),
        F.coalesce("link", F.lit("")).alias("link"),
        F.col("last_run_date").cast("string").alias("run_date"),
        F.struct(F.col("label_a").alias("label"), F.col("score_a").alias("score")).alias("a"),
        F.struct(F.col("label_b").alias("label"), F.col("score_b").alias("score")).alias("b"),
        "gap",
    )
    head = _one_row(
        good,
        generated_at=_stamp(generated_at),
        _numbers=agreement_numbers(stories).select(
            F.struct("n", "percent_agreement", "cohens_kappa", "score_correlation")
        ).scalar(),
        _matrix=_sorted_list(rows, ["row"], ["cells"]),
        _labels=per_model.agg(F.map_from_entries(F.collect_list(F.struct("model", "labels")))).scalar(),
        by_topic=_sorted_list(
            agreement.agreement_by_topic(paired, topics), ["place", "topic"],
            ["topic", "n", "percent_agreement", "cohens_kappa"],
        ),
        score_pairs=_sorted_list(
            agreement.score_pairs(stories, max_score_pairs), ["headline_id"], ["a", "b", "same"]
        ),
        disagreements=_sorted_list(
            differing, ["age", "closeness", "id"],
            ["id", "topic", "title", "source", "link", "run_date", "a", "b", "gap"],
        ),
    )
    any_pair = F.col("_numbers.n") > 0
    return head.select(
        "generated_at",
        F.array(F.lit(model_a), F.lit(model_b)).alias("models"),
        F.array(*[F.lit(name) for name in LABELS]).alias("labels"),
        F.col("_numbers.n").alias("n"),
        F.col("_numbers.percent_agreement").alias("percent_agreement"),
        F.col("_numbers.cohens_kappa").alias("cohens_kappa"),
        F.when(any_pair, F.col("_numbers.score_correlation")).alias("score_correlation"),
        F.when(
            any_pair,
            F.struct(
                F.lit(model_a).alias("rows"), F.lit(model_b).alias("columns"),
                F.transform("_matrix", lambda r: r["cells"]).alias("matrix"),
            ),
        ).alias("confusion_matrix"),
        F.when(any_pair, F.col("_labels")).alias("label_distribution"),
        "by_topic", "score_pairs", "disagreements",
    )


# status


def topic_sizes(
    good: DataFrame, run_date=None, topics=TOPICS, limit: int = MAX_PER_TOPIC, spans: DataFrame | None = None,
) -> DataFrame:
    """(ord, topic, query, edition, total) for every configured topic, zero when missing."""
    shown = edition(good, run_date, limit).groupBy("topic").agg(F.count("*").alias("edition"))
    totals = activity.topic_totals(good if spans is None else spans).withColumnRenamed("n", "total")
    return (
        topic_frame(good.sparkSession, topics)
        .join(shown, "topic", "left")
        .join(totals, "topic", "left")
        .select(
            "ord", "topic", "query",
            F.coalesce("edition", F.lit(0)).alias("edition"),
            F.coalesce("total", F.lit(0)).alias("total"),
        )
    )


def history_numbers(headlines: DataFrame, flagged: DataFrame | None = None, spans: DataFrame | None = None) -> DataFrame:
    """One row: headlines, excluded_low_quality, first_run_date, last_run_date, run_days."""
    stored = headlines.agg(F.count("*").alias("n"))  # answered from file footers
    return activity.history_overview(quality.good_headlines(headlines, flagged) if spans is None else spans).select(
        "headlines", (stored.scalar() - F.col("headlines")).alias("excluded_low_quality"),
        "first_run_date", "last_run_date", "run_days",
    )


def _text(value) -> Column:
    return F.lit(None).cast("string") if value is None else F.lit(str(value))


def _texts(values) -> Column:
    return F.array(*[F.lit(str(v)) for v in values]).cast("array<string>")


def run_block(run: dict | None) -> Column:
    """Run counters as a struct, missing ones with their defaults; null without a run."""
    kind = (
        "struct<run_date:string,mode:string,raw_records:bigint,inserted:bigint,seen_again:bigint,"
        "scored:map<string,bigint>,failed_topics:array<string>,filtered_low_quality:bigint,"
        "requests:bigint,backfill:struct<days:bigint,first_run_date:string,last_run_date:string,"
        "fetched:array<string>,skipped:array<string>,empty:array<string>,records:bigint>>"
    )
    if run is None:
        return F.lit(None).cast(kind)

    def number(block, name, default=None) -> Column:
        return F.lit(block.get(name, default)).cast("bigint").alias(name)

    scored = run.get("scored") or {}
    pairs = reduce(lambda out, kv: [*out, F.lit(kv[0]), F.lit(kv[1]).cast("bigint")], scored.items(), [])
    fill = run.get("backfill")
    backfill = F.lit(None) if fill is None else F.struct(
        number(fill, "days"),
        _text(fill.get("first_run_date")).alias("first_run_date"),
        _text(fill.get("last_run_date")).alias("last_run_date"),
        *[_texts(fill.get(name, [])).alias(name) for name in ("fetched", "skipped", "empty")],
        number(fill, "records"),
    )
    return F.struct(
        _text(run.get("run_date")).alias("run_date"), _text(run.get("mode")).alias("mode"),
        number(run, "raw_records"), number(run, "inserted"), number(run, "seen_again"),
        F.create_map(*pairs).cast("map<string,bigint>").alias("scored"),
        _texts(run.get("failed_topics", [])).alias("failed_topics"),
        number(run, "filtered_low_quality", 0), number(run, "requests", 0),
        backfill.alias("backfill"),
    ).cast(kind)


def status_report(
    headlines: DataFrame, sentiment: DataFrame, *, run: dict | None = None, topics=TOPICS,
    limit: int = MAX_PER_TOPIC, trend_days: int = TREND_DAYS, parquet_files: int = 0,
    generated_at=None, flagged: DataFrame | None = None, run_date=None, spans: DataFrame | None = None,
) -> DataFrame:
    """One row: the run, the size of the history, and counts per topic, run date and source.
    `run_date` is the date of the latest edition where it is known; a value prunes the scan.
    `spans` takes the counts kept with the history (`history.span_counts`), which then give the
    overview, the totals and the activity without reading the headlines."""
    kept = quality.good_headlines(headlines, flagged)
    scored = activity.sentiment_counts(kept, sentiment)
    head = _one_row(
        headlines,
        generated_at=_stamp(generated_at),
        _h=history_numbers(headlines, flagged, spans).select(F.struct("*")).scalar(),
        _scored=_sorted_list(scored, ["model"], ["model", "n"]),
        topics=_sorted_list(
            topic_sizes(kept, run_date, topics, limit, spans).withColumnRenamed("topic", "label"),
            ["ord"], ["label", "query", "edition", "total"],
        ),
        daily=_sorted_list(
            activity.daily_activity(kept if spans is None else spans, STATUS_DAILY_RUNS).withColumn("run_date", F.col("run_date").cast("string")),
            ["run_date"], ["run_date", "new_headlines", "seen_again"],
        ),
        sources=_sorted_list(
            activity.top_sources(kept, STATUS_TOP_SOURCES).withColumn("fewer", -F.col("n")),
            ["fewer", "source"], ["source", "n"],
        ),
    )
    names = F.transform("_scored", lambda s: s["model"])
    return head.select(
        "generated_at",
        F.lit(__version__).alias("version"),
        F.lit(SCHEDULE).alias("schedule"),
        run_block(run).alias("run"),
        F.struct(
            F.col("_h.headlines").alias("headlines"),
            F.col("_h.excluded_low_quality").alias("excluded_low_quality"),
            F.map_from_entries("_scored").alias("sentiment"),
            F.col("_h.first_run_date").cast("string").alias("first_run_date"),
            F.col("_h.last_run_date").cast("string").alias("last_run_date"),
            F.col("_h.run_days").alias("run_days"),
            F.lit(parquet_files).alias("parquet_files"),
        ).alias("history"),
        F.struct(primary_model(names).alias("primary"), names.alias("available")).alias("models"),
        "topics", "daily", "sources",
        F.struct(F.lit(limit).alias("max_per_topic"), F.lit(trend_days).alias("trend_days")).alias("config"),
    )
