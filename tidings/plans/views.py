"""Numbers derived from the reports: moods, label mixes, windows, shares.

Inputs are the bounded frames of `plans.reports` (edition articles, trend rows, label cells), so
these steps are small whatever the size of the history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.config import LABELS, TOPICS
from tidings.functions.labels import heat_bin, primary_model, score_sign
from tidings.operators.dimensions import topic_frame

INGEST_MIN_DAYS, INGEST_MAX_DAYS = 14, 30
TAIL_DAYS = 14


def article_scores(articles: DataFrame) -> DataFrame:
    """(topic, place, id, model, label, score): one row per article and model that scored it."""
    return articles.select("topic", "place", "id", F.explode("scores").alias("model", "s")).select(
        "topic", "place", "id", "model", F.col("s.label").alias("label"), F.col("s.score").alias("score")
    )


def edition_primary(articles: DataFrame) -> Column:
    """The edition's preferred model as a scalar subquery."""
    models = articles.select(F.explode(F.map_keys("scores")).alias("model"))
    return models.agg(primary_model(F.collect_set("model"))).scalar()


def topic_mood(articles: DataFrame) -> DataFrame:
    """(topic, model, avg, n, of, fallback): mean score by the edition's preferred model, or by
    the first other model that scored any article of the topic. Topics nobody scored are absent."""
    primary = edition_primary(articles)
    sizes = articles.groupBy("topic").agg(F.count("*").alias("of"))
    stats = (
        article_scores(articles)
        .groupBy("topic", "model")
        .agg(F.avg("score").alias("avg"), F.count("*").alias("n"))
        .withColumn("fallback", F.col("model") != primary)
    )
    best = F.min_by(F.struct("model", "avg", "n", "fallback"), F.struct("fallback", "model"))
    return (
        stats.groupBy("topic").agg(best.alias("m")).join(sizes, "topic")
        .select(
            "topic", F.col("m.model").alias("model"), F.col("m.avg").alias("avg"),
            F.col("m.n").alias("n"), "of", F.col("m.fallback").alias("fallback"),
        )
    )


def mood_extremes(moods: DataFrame, topics=TOPICS) -> DataFrame:
    """One row with the most positive and the most negative topic of the preferred model; no row
    for fewer than two topics or equal averages. On a tie the earlier topic leads and the later
    one trails."""
    rank = moods.join(topic_frame(moods.sparkSession, topics).select("topic", "ord"), "topic")
    own = rank.filter(~F.col("fallback"))
    pick = F.struct("topic", "avg")
    return (
        own.agg(
            F.count("*").alias("topics"),
            F.max_by(pick, F.struct("avg", -F.col("ord"))).alias("high"),
            F.min_by(pick, F.struct("avg", -F.col("ord"))).alias("low"),
        )
        .filter((F.col("topics") > 1) & (F.col("high.avg") != F.col("low.avg")))
        .select(
            F.col("high.topic").alias("most_positive"), F.col("high.avg").alias("high_avg"),
            F.col("low.topic").alias("most_negative"), F.col("low.avg").alias("low_avg"),
        )
    )


def label_mix(articles: DataFrame) -> DataFrame:
    """(topic, model, positive, neutral, negative, n) over known labels."""
    known = article_scores(articles).filter(F.col("label").isin(*LABELS))
    return known.groupBy("topic", "model").agg(
        *[F.count_if(F.col("label") == name).alias(name) for name in LABELS], F.count("*").alias("n")
    )


def edition_disagreement(articles: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """(topic, n, differ, ids): articles both models scored and those they label differently, in
    edition order."""
    a, b = (F.try_element_at("scores", F.lit(m))["label"] for m in (model_a, model_b))
    both = articles.select("topic", "place", "id", a.alias("a"), b.alias("b"))
    differs = F.col("a") != F.col("b")
    ids = F.array_sort(F.collect_list(F.when(differs, F.struct("place", "id"))))
    return both.groupBy("topic").agg(
        F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("n"),
        F.count_if(differs).alias("differ"),
        F.transform(ids, lambda r: r["id"]).alias("ids"),
    )


def trend_tail(rows: DataFrame, days: int = TAIL_DAYS) -> DataFrame:
    """Trend rows of the last `days` days of the series."""
    last = rows.agg(F.max("day")).scalar()
    return rows.filter(F.col("day") > F.date_sub(last, days))


def window_view(rows: DataFrame, model: str, days: int) -> DataFrame:
    """(topic, total, scored, active_days, average) over the last `days` days for one model. The
    average weighs each day by its scored headlines; days without scores are gaps."""
    recent = _model_days(trend_tail(rows, days), model)
    return recent.groupBy("topic").agg(
        F.sum("count").alias("total"),
        F.sum("n").alias("scored"),
        F.count_if(F.col("count") > 0).alias("active_days"),
        F.try_divide(F.sum(F.col("avg") * F.col("n")), F.sum("n")).alias("average"),
    )


def _model_days(rows: DataFrame, model: str) -> DataFrame:
    """(topic, day, count, n, avg): one row per topic and day, the model's numbers or a gap."""
    own = F.col("model") == model
    return rows.groupBy("topic", "day").agg(
        F.max("count").alias("count"),
        F.coalesce(F.max(F.when(own, F.col("n"))), F.lit(0)).alias("n"),
        F.max(F.when(own, F.col("avg"))).alias("avg"),
    )


def window_days(rows: DataFrame, model: str, days: int) -> DataFrame:
    """One row: total, scored, headline_days, scored_days over all topics of the window."""
    recent = _model_days(trend_tail(rows, days), model)
    per_day = recent.groupBy("day").agg(F.sum("count").alias("count"), F.sum("n").alias("n"))
    return per_day.agg(
        F.sum("count").alias("total"),
        F.sum("n").alias("scored"),
        F.count_if(F.col("count") > 0).alias("headline_days"),
        F.count_if(F.col("n") > 0).alias("scored_days"),
    )


def last_scored(rows: DataFrame) -> DataFrame:
    """(topic, model, day, avg, n): the latest day with a score."""
    return (
        rows.filter(F.col("avg").isNotNull())
        .groupBy("topic", "model")
        .agg(F.max_by(F.struct("day", "avg", "n"), "day").alias("s"))
        .select("topic", "model", "s.*")
    )


def score_bins(rows: DataFrame) -> DataFrame:
    """(topic, day, model, avg, bin): heat step of every daily average, null on a gap."""
    return rows.select("topic", "day", "model", "avg", heat_bin(F.col("avg")).alias("bin"))


def scored_runs(rows: DataFrame) -> DataFrame:
    """(topic, model, first_day, last_day, days): runs of consecutive scored days."""
    within = Window.partitionBy("topic", "model").orderBy("day")
    scored = rows.filter(F.col("avg").isNotNull()).select("topic", "model", "day")
    island = F.date_sub(F.col("day"), F.row_number().over(within))
    return (
        scored.withColumn("island", island)
        .groupBy("topic", "model", "island")
        .agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("days"))
        .drop("island")
    )


def confusion_shares(matrix: DataFrame) -> DataFrame:
    """(label_a, label_b, n, row_total, col_total, row_share, largest_mismatch): the matrix with
    totals and row percentages; the first largest cell off the diagonal is marked. A matrix has
    labels x labels rows."""
    everything = Window.partitionBy(F.lit(0))
    row_total = F.sum("n").over(Window.partitionBy("row"))
    off = F.when((F.col("row") != F.col("col")) & (F.col("n") > 0), F.struct(-F.col("n"), "row", "col"))
    return (
        matrix.withColumn("row_total", row_total)
        .withColumn("col_total", F.sum("n").over(Window.partitionBy("col")))
        .withColumn("_off", off)
        .withColumn("_worst", F.min("_off").over(everything))
        .select(
            "label_a", "label_b", "n", "row_total", "col_total",
            (F.try_divide(F.col("n"), F.col("row_total")) * 100).alias("row_share"),
            F.coalesce(F.col("_off") == F.col("_worst"), F.lit(False)).alias("largest_mismatch"),
        )
    )


def label_gap(distribution: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """(label, share_a, share_b, gap, widest): how often each model uses each label, in percent,
    and the first label with the widest gap."""
    share = F.coalesce(
        F.try_divide(F.col("n"), F.sum("n").over(Window.partitionBy("model"))) * 100, F.lit(0.0)
    )
    sides = (
        distribution.withColumn("share", share)
        .groupBy("place", "label")
        .agg(
            F.max(F.when(F.col("model") == model_a, F.col("share"))).alias("share_a"),
            F.max(F.when(F.col("model") == model_b, F.col("share"))).alias("share_b"),
        )
        .withColumn("gap", F.abs(F.col("share_a") - F.col("share_b")))
    )
    # shares equal on paper can differ in the last bits
    widest = F.max_by("place", F.struct(F.round("gap", 9), -F.col("place"))).over(Window.partitionBy(F.lit(0)))
    return sides.withColumn("widest", F.col("place") == widest).select(
        "label", "share_a", "share_b", "gap", "widest"
    )


def score_quadrants(pairs: DataFrame) -> DataFrame:
    """(sign_a, sign_b, n): pairs by the signs of their scores, all nine cells."""
    signs = F.array(F.lit(1), F.lit(0), F.lit(-1))
    grid = (
        pairs.sparkSession.range(1)
        .select(F.explode(signs).alias("sign_a"))
        .select("sign_a", F.explode(signs).alias("sign_b"))
    )
    counts = pairs.groupBy(
        score_sign(F.col("score_a")).alias("sign_a"), score_sign(F.col("score_b")).alias("sign_b")
    ).agg(F.count("*").alias("n"))
    return grid.join(counts, ["sign_a", "sign_b"], "left").select(
        "sign_a", "sign_b", F.coalesce("n", F.lit(0)).alias("n")
    )


def ingest_calendar(daily: DataFrame) -> DataFrame:
    """(day, run, fresh, seen, total, before_history): a dense calendar of 14 to 30 days that
    ends on the latest run date, from the daily activity rows."""
    ends = daily.agg(F.min("run_date").alias("first"), F.max("run_date").alias("last"))
    span = F.least(
        F.lit(INGEST_MAX_DAYS),
        F.greatest(F.lit(INGEST_MIN_DAYS), F.date_diff(F.col("last"), F.col("first")) + 1),
    )
    days = ends.filter(F.col("last").isNotNull()).select(
        "first", F.explode(F.sequence(F.date_sub(F.col("last"), span - 1), "last")).alias("day")
    )
    return days.join(daily, days["day"] == daily["run_date"], "left").select(
        "day",
        F.col("run_date").isNotNull().alias("run"),
        F.coalesce("new_headlines", F.lit(0)).alias("fresh"),
        F.coalesce("seen_again", F.lit(0)).alias("seen"),
        (F.coalesce("new_headlines", F.lit(0)) + F.coalesce("seen_again", F.lit(0))).alias("total"),
        (F.col("day") < F.col("first")).alias("before_history"),
    )


def share_of_max(counts: DataFrame, value: str = "n") -> DataFrame:
    """`counts` with `share`: percent of the largest value, 0 when that is 0. The maximum is an
    aggregate of its own, so rows stay where they are."""
    top = counts.agg(F.max(value)).scalar()
    return counts.withColumn("share", F.coalesce(F.try_divide(F.col(value), top) * 100, F.lit(0.0)))


