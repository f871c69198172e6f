"""Sentiment scoring: what is still to score, the scorers, and the append."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.functions.binding import let
from tidings.functions.labels import label_from_probs, label_from_score
from tidings.functions.times import utc
from tidings.schemas import SCORE, SENTIMENT

# Own word list of the baseline scorer: finance and plain news words with a weight.
LEXICON: dict[str, float] = {
    "beat": 1.5, "beats": 1.5, "boom": 2.0, "boost": 1.5, "cheer": 2.0, "climb": 1.5,
    "climbs": 1.5, "excellent": 2.5, "gain": 1.5, "gains": 1.5, "good": 1.5, "great": 2.0,
    "growth": 1.5, "jump": 1.5, "jumps": 1.5, "optimism": 2.0, "profit": 1.5, "profits": 1.5,
    "rallies": 2.0, "rally": 2.0, "rebound": 1.5, "rebounds": 1.5, "record": 1.0, "rise": 1.0,
    "rises": 1.0, "soar": 2.0, "soars": 2.0, "strong": 1.5, "surge": 2.0, "surges": 2.0,
    "upbeat": 1.5, "upgrade": 1.5, "win": 1.5, "wins": 1.5,
    "bankruptcy": -3.0, "crash": -3.0, "crisis": -2.5, "cut": -1.0, "cuts": -1.0,
    "decline": -1.5, "declines": -1.5, "drop": -1.5, "drops": -1.5, "fall": -1.0,
    "falls": -1.0, "fear": -2.0, "fears": -2.0, "fraud": -3.0, "lawsuit": -2.0, "layoffs": -2.0,
    "loss": -1.5, "losses": -1.5, "miss": -1.5, "misses": -1.5, "plunge": -2.5,
    "plunges": -2.5, "recession": -2.5, "slide": -1.5, "slides": -1.5, "slump": -2.0,
    "terrible": -2.5, "warn": -1.5, "warning": -1.5, "warns": -1.5, "weak": -1.5,
    "pathetic": -2.5, "stupid": -2.5, "worthless": -2.5,
}
# Published normalization of the lexicon method: s / sqrt(s * s + 15).
ALPHA = 15.0


def pending(good: DataFrame, sentiment: DataFrame, model: str) -> DataFrame:
    """(headline_id, title) of the good stories a model has not scored; one title per story."""
    done = sentiment.filter(F.col("model") == model).select("headline_id")
    return (
        good.select("headline_id", "title")
        .join(done, "headline_id", "left_anti")
        .groupBy("headline_id")
        .agg(F.min("title").alias("title"))
    )


def lexicon_score(text: Column, lexicon: Mapping[str, float] = LEXICON) -> Column:
    """struct<label, score> of a text: word weights summed, then squeezed into (-1, 1).

    The list is settings and goes into the plan as one hashed set per distinct weight, so a
    text is scored where it is read, without a join."""
    groups: dict[float, list[str]] = {}
    for word, weight in lexicon.items():
        groups.setdefault(float(weight), []).append(word)

    def weight_of(word: Column) -> Column:
        found = F.lit(0.0)
        for weight, members in sorted(groups.items()):
            found = F.when(word.isin(*members), F.lit(weight)).otherwise(found)
        return found

    def result(compound: Column) -> Column:
        return F.struct(label_from_score(compound).alias("label"), compound.alias("score"))

    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z]+"), F.lit(0))
    total = F.aggregate(words, F.lit(0.0), lambda sum_, word: sum_ + weight_of(word))
    return let(
        let(total, lambda t: F.round(t / F.sqrt(t * t + ALPHA), 4)), result
    )


# A scorer takes a text column and returns struct<label, score>.
Scorer = Callable[[Column], Column]


def once_per_process(load: Callable) -> Callable:
    """The result of `load`, kept by the Python process for all tasks it runs with this scorer.

    The holder is found by name, since functions reach a task as copies with globals of their own."""
    key = f"model_{uuid.uuid4().hex}"

    def get():
        held = sys.modules.setdefault("_scorer_models", types.ModuleType("_scorer_models"))
        if not hasattr(held, key):
            setattr(held, key, load())
        return getattr(held, key)

    return get


def batch_scorer(load: Callable[[], Callable[[Sequence[str]], Sequence[tuple[str, float]]]]) -> Scorer:
    """Scorer around an outside model that maps texts to (label, score) pairs.

    `load` runs once per Python process, on the first batch. Texts arrive in Arrow batches; their
    size is set with spark.sql.execution.arrow.maxRecordsPerBatch."""

    model = once_per_process(load)

    @F.pandas_udf(SCORE)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            if len(texts) == 0:
                yield pd.DataFrame({"label": [], "score": []})
                continue
            results = list(model()(texts.fillna("").tolist()))
            yield pd.DataFrame(
                {"label": [r[0] for r in results], "score": [float(r[1]) for r in results]}
            )

    return score


CLASSES = "array<struct<label:string,score:double>>"


def probability_scorer(
    load: Callable[[], Callable[[Sequence[str]], Sequence]], batch_size: int = 16
) -> Scorer:
    """Scorer around a classifier that maps texts to class probabilities: a list of
    {label, score} per text, or a single one. The model sees `batch_size` texts at a time; the
    choice of the label stays in Spark."""

    model = once_per_process(load)

    @F.pandas_udf(CLASSES)
    def classes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            values = texts.fillna("").tolist()
            for start in range(0, len(values), batch_size):
                for result in model()(values[start : start + batch_size]):
                    listed = [result] if isinstance(result, dict) else result
                    out.append(
                        [{"label": r["label"], "score": float(r["score"])} for r in listed]
                    )
            yield pd.Series(out, dtype="object")

    return lambda text: label_from_probs(classes(text))


class ScorerRegistry:
    """Scorers by name. An unknown name fails before any work starts."""

    def __init__(self, **scorers: Scorer):
        self._scorers = {name.lower(): scorer for name, scorer in scorers.items()}

    def register(self, name: str, scorer: Scorer) -> None:
        self._scorers[name.strip().lower()] = scorer

    def choose(self, names: Sequence[str]) -> dict[str, Scorer]:
        chosen = {}
        for name in (n.strip().lower() for n in names):
            if name not in self._scorers:
                known = ", ".join(sorted(self._scorers))
                raise ValueError(f"unknown model {name!r}; choose from {known}")
            chosen[name] = self._scorers[name]
        return chosen


def compound_scorer(load: Callable[[], Callable[[Sequence[str]], Sequence[float]]]) -> Scorer:
    """Scorer around an outside model that maps texts to one number from -1 to +1; the label is
    cut in Spark."""

    model = once_per_process(load)

    @F.pandas_udf("double")
    def compound(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model()(texts.fillna("").tolist()) if len(texts) else [], dtype="float64")

    def score(text: Column) -> Column:
        value = compound(text)
        return F.struct(label_from_score(value).alias("label"), F.round(value, 4).alias("score"))

    return score


def default_registry() -> ScorerRegistry:
    """The built-in scorer. Outside models are registered by who has them, with one of the adapters."""
    return ScorerRegistry(lexicon=lexicon_score)


def score_stories(stories: DataFrame, model: str, scorer: Scorer, scored_at) -> DataFrame:
    """Sentiment rows for (headline_id, title)."""
    return stories.select(
        "headline_id", F.lit(model).alias("model"), scorer(F.col("title")).alias("_s")
    ).select(
        "headline_id", "model", F.col("_s.label").alias("label"), F.col("_s.score").alias("score"),
        (scored_at if isinstance(scored_at, Column) else utc(scored_at)).alias("scored_at"),
    )


def score_pending(
    good: DataFrame, sentiment: DataFrame, scorers: Mapping[str, Scorer], scored_at
) -> DataFrame:
    """New sentiment rows: every good story each model has not scored yet."""
    parts = [
        score_stories(pending(good, sentiment, name), name, scorer, scored_at)
        for name, scorer in scorers.items()
    ]
    if not parts:
        return sentiment.limit(0)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def append_scores(sentiment: DataFrame, scored: DataFrame) -> DataFrame:
    """The sentiment table with new rows. A second score of a story by one model is an error,
    raised when the result is computed. Only keys of the new rows are looked up; stored rows pass
    through."""
    names = SENTIMENT.fieldNames()
    key = ["headline_id", "model"]
    known = (
        sentiment.select(*key)
        .join(scored.select(*key), key, "left_semi")
        .groupBy(*key)
        .agg(F.count("*").alias("_stored"))
    )
    message = F.concat_ws(" ", F.lit("story scored twice:"), *key)
    checked = (
        scored.groupBy(*key)
        .agg(F.count("*").alias("_new"), F.min(F.struct("label", "score", "scored_at")).alias("_s"))
        .join(known, key, "left")
        .select(
            *key,
            F.when(
                (F.col("_new") > 1) | F.col("_stored").isNotNull(), F.raise_error(message)
            ).otherwise(F.col("_s.label")).alias("label"),
            F.col("_s.score").alias("score"),
            F.col("_s.scored_at").alias("scored_at"),
        )
    )
    return sentiment.select(*names).unionByName(checked)
