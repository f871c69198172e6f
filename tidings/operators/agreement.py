"""How far two raters agree: pairs, cells, percent agreement, kappa, correlation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.config import DISAGREEMENTS, LABELS, SCORE_PAIRS, TOPICS, topic_list
from tidings.operators.dimensions import topic_frame

STORY_COLUMNS = ["topic", "title", "source", "link", "last_run_date"]


def paired_scores(good: DataFrame, sentiment: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """One row per good headline and topic that both models scored.

    Each side reads only its model's scores, and all three inputs meet on headline_id. A story has
    one score per model, which the append guards."""

    def of(model: str, side: str) -> DataFrame:
        return sentiment.filter(F.col("model") == model).select(
            "headline_id", F.col("label").alias(f"label_{side}"), F.col("score").alias(f"score_{side}")
        )

    both = of(model_a, "a").join(of(model_b, "b"), "headline_id")
    return good.select("headline_id", *STORY_COLUMNS).join(both, "headline_id")


def one_row_per_story(rows: DataFrame, topics=TOPICS) -> DataFrame:
    """Each story under its first topic in configured order; other topics follow by name."""
    ranked = rows.join(topic_frame(rows.sparkSession, topics).select("topic", "ord"), "topic", "left")
    rank = F.struct(F.coalesce("ord", F.lit(len(topic_list(topics)))), F.col("topic"))
    kept = [name for name in rows.columns if name != "headline_id"]
    return (
        ranked.groupBy("headline_id")
        .agg(F.min_by(F.struct(*kept), rank).alias("row"))
        .select("headline_id", *[F.col(f"row.{name}").alias(name) for name in kept])
    )


def label_cells(pairs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by.., label_a, label_b, n): the counts every label metric is made of."""
    return pairs.groupBy(*by, "label_a", "label_b").agg(F.count("*").alias("n"))


def _exact(count: Column) -> Column:
    """Counts multiply without overflow and compare without rounding as decimals."""
    return count.cast("decimal(19,0)")


def label_agreement(cells: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by.., n, percent_agreement, cohens_kappa) from label cells.

    kappa = (p_o - p_e) / (1 - p_e), and 1 when both raters give one and the same label to
    everything. Works on at most labels x labels rows per group."""
    marginals = cells.select(
        *by,
        F.inline(
            F.array(
                F.struct(
                    F.col("label_a").alias("label"), F.col("n").alias("n_a"),
                    F.lit(0).cast("long").alias("n_b"),
                    F.when(F.col("label_a") == F.col("label_b"), F.col("n"))
                    .otherwise(F.lit(0)).alias("hits"),
                ),
                F.struct(
                    F.col("label_b").alias("label"), F.lit(0).cast("long").alias("n_a"),
                    F.col("n").alias("n_b"), F.lit(0).cast("long").alias("hits"),
                ),
            )
        ),
    )
    per_label = marginals.groupBy(*by, "label").agg(
        F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"), F.sum("hits").alias("hits")
    )
    totals = per_label.groupBy(*by).agg(
        F.coalesce(F.sum("n_a"), F.lit(0)).alias("n"),
        F.sum("hits").alias("hits"),
        F.sum(_exact(F.col("n_a")) * _exact(F.col("n_b"))).alias("chance_hits"),
    )
    squared = _exact(F.col("n")) * _exact(F.col("n"))
    observed = F.try_divide(F.col("hits").cast("double"), F.col("n"))
    expected = F.col("chance_hits").cast("double") / squared.cast("double")
    kappa = F.when(F.col("n") == 0, None).when(F.col("chance_hits") == squared, 1.0).otherwise(
        F.try_divide(observed - expected, 1 - expected)
    )
    return totals.select(
        *by,
        "n",
        F.round(observed * 100, 2).alias("percent_agreement"),
        F.round(kappa, 4).alias("cohens_kappa"),
    )


def confusion_matrix(cells: DataFrame, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """(row, col, label_a, label_b, n) for every pair of labels in order, zeros filled. A cell
    with a label outside the list is an error."""
    names = F.array(*[F.lit(name) for name in labels])
    stray = ~(F.col("label_a").isin(*labels) & F.col("label_b").isin(*labels))
    checked = cells.withColumn(
        "n",
        F.when(
            stray,
            F.raise_error(F.concat_ws(" ", F.lit("unknown label in"), "label_a", "label_b")),
        ).otherwise(F.col("n")),
    )
    grid = (
        cells.sparkSession.range(1)
        .select(F.posexplode(names).alias("row", "label_a"))
        .select("row", "label_a", F.posexplode(names).alias("col", "label_b"))
    )
    # a full join keeps stray cells in the plan, so their error is raised
    return (
        grid.join(checked, ["label_a", "label_b"], "full_outer")
        .select("row", "col", "label_a", "label_b", F.coalesce("n", F.lit(0)).alias("n"))
    )


def score_correlation(pairs: DataFrame) -> DataFrame:
    """One row: Pearson correlation of the scores to four digits, null for fewer than two pairs
    or a constant series."""
    spread = F.stddev_pop("score_a") * F.stddev_pop("score_b")
    return pairs.agg(
        F.round(F.try_divide(F.covar_pop("score_a", "score_b"), spread), 4).alias(
            "score_correlation"
        )
    )


def agreement_by_topic(paired: DataFrame, topics=TOPICS) -> DataFrame:
    """(place, topic, n, percent_agreement, cohens_kappa): configured topics in order, then the
    others by name. A story counts under each of its topics."""
    numbers = label_agreement(label_cells(paired, ("topic",)), ("topic",))
    dimension = topic_frame(paired.sparkSession, topics).select("topic", "ord")
    return numbers.join(dimension, "topic", "full_outer").select(
        F.coalesce("ord", F.lit(len(topic_list(topics)))).alias("place"),
        "topic",
        F.coalesce("n", F.lit(0)).alias("n"),
        "percent_agreement",
        "cohens_kappa",
    )


def label_distribution(cells: DataFrame, model_a: str, model_b: str, labels=LABELS) -> DataFrame:
    """(model, label, n) for both models and every label, zeros filled."""
    models = F.array(F.lit(model_a), F.lit(model_b))
    names = F.array(*[F.lit(name) for name in labels])
    grid = (
        cells.sparkSession.range(1)
        .select(F.explode(models).alias("model"))
        .select("model", F.posexplode(names).alias("place", "label"))
    )
    counts = (
        cells.select(
            F.inline(
                F.array(
                    F.struct(F.lit(model_a).alias("model"), F.col("label_a").alias("label"), "n"),
                    F.struct(F.lit(model_b).alias("model"), F.col("label_b").alias("label"), "n"),
                )
            )
        )
        .groupBy("model", "label")
        .agg(F.sum("n").alias("n"))
    )
    return grid.join(counts, ["model", "label"], "left").select(
        "model", "place", "label", F.coalesce("n", F.lit(0)).alias("n")
    )


def score_pairs(stories: DataFrame, limit: int = SCORE_PAIRS) -> DataFrame:
    """(headline_id, a, b, same): the first pairs by story id. The id is a hash, so this is an
    unbiased sample and the same one every time."""
    return (
        stories.select(
            "headline_id", F.col("score_a").alias("a"), F.col("score_b").alias("b"),
            (F.col("label_a") == F.col("label_b")).alias("same"),
        )
        .orderBy("headline_id")
        .limit(limit)
    )


def disagreements(stories: DataFrame, limit: int = DISAGREEMENTS) -> DataFrame:
    """Stories with different labels: latest run date first, then the largest gap, then id."""
    gap = F.col("score_b") - F.col("score_a")
    return (
        stories.filter(F.col("label_a") != F.col("label_b"))
        .withColumn("gap", gap)
        .orderBy(F.desc("last_run_date"), F.desc(F.abs("gap")), "headline_id")
        .limit(limit)
        .withColumn("gap", F.round("gap", 4))
    )
