"""Sentiment labels, scores and model choice."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidings.config import LABELS, MODEL_PREFERENCE, NEGATIVE_CUT, POSITIVE_CUT
from tidings.functions.binding import let

# Absolute scores where the heat steps 1, 2 and 3 begin.
HEAT_STEPS = (0.05, 0.2, 0.4)


def label_from_score(score: Column) -> Column:
    """Label of a score from -1 to +1. The cut points belong to the outer labels; a missing
    score has no label."""
    return (
        F.when(score.isNull() | F.isnan(score), F.lit(None).cast("string"))
        .when(score >= POSITIVE_CUT, F.lit("positive"))
        .when(score <= NEGATIVE_CUT, F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )


def label_from_probs(classes: Column) -> Column:
    """struct<label, score> from array<struct<label, score>> of class probabilities.

    The label is the most likely class, the earlier one on a tie; the score is
    P(positive) - P(negative) to four digits. An unknown winner is an error."""
    ranked = F.transform(
        classes,
        lambda c, i: F.struct(
            c["score"].alias("score"), (-i).alias("place"), F.lower(c["label"]).alias("label")
        ),
    )
    winner = F.array_max(ranked)["label"]

    def checked(name: Column) -> Column:
        message = F.concat(F.lit("unexpected class label: "), F.coalesce(name, F.lit("none")))
        return F.when(name.isin(*LABELS), name).otherwise(F.raise_error(message).cast("string"))

    def probability(name: str) -> Column:
        scores = F.transform(
            F.filter(classes, lambda c: F.lower(c["label"]) == name), lambda c: c["score"]
        )
        return F.coalesce(F.try_element_at(scores, F.lit(-1)), F.lit(0.0))

    score = F.round(probability("positive") - probability("negative"), 4)
    return F.when(
        classes.isNotNull(), F.struct(let(winner, checked).alias("label"), score.alias("score"))
    )


def primary_model(available: Column, preference: tuple[str, ...] = MODEL_PREFERENCE) -> Column:
    """The first preferred model among array<string>, else the smallest name, else null."""
    preferred = [F.when(F.array_contains(available, name), F.lit(name)) for name in preference]
    return F.coalesce(*preferred, F.array_min(available))


def model_rank(model: Column, preference: tuple[str, ...] = MODEL_PREFERENCE) -> Column:
    """Sort key of a model: preferred models in order, then the others by name."""
    place = F.lit(len(preference))
    for index, name in reversed(list(enumerate(preference))):
        place = F.when(model == name, F.lit(index)).otherwise(place)
    return F.struct(place.alias("place"), model.alias("name"))


def heat_bin(score: Column) -> Column:
    """Signed heat step from -3 to +3, 0 inside the neutral band, null without a score."""
    size = F.abs(score)
    step = F.lit(0)
    for index, edge in enumerate(HEAT_STEPS, start=1):
        step = F.when(size >= edge, F.lit(index)).otherwise(step)
    return F.when(score < 0, -step).when(score >= 0, step)


def score_sign(score: Column) -> Column:
    """-1, 0 or +1."""
    return F.signum(score).cast("int")
