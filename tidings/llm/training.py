"""Bounded samples of labelled rows, from which the small models of this package are fitted."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import remainder

BINS = 1 << 20


def shares(labelled: DataFrame, label: str, per_class: int) -> tuple[dict, dict]:
    """(rows of each class, share to keep) so that about `per_class` rows of each are kept."""
    counts = {r[label]: r["n"] for r in labelled.groupBy(label).agg(F.count("*").alias("n")).collect()}
    return counts, {k: min(1.0, per_class / n) for k, n in counts.items()}


def sample(labelled: DataFrame, label: str, keep: dict, seed: int = 7) -> DataFrame:
    """The rows whose id hashes below their class's share: no shuffle, the same rows every time."""
    wanted = F.lit(0.0)
    for value, share in keep.items():
        wanted = F.when(F.col(label) == value, share).otherwise(wanted)
    return labelled.filter(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(BINS)) < wanted * BINS)


def joined_sample(documents: DataFrame, labels: DataFrame, label: str, held_out: int, modulo: int, per_class: int) -> tuple[DataFrame, dict]:
    """(doc_id, text, label) of a sample of the labelled rows outside the held-out part, and the
    number of labelled rows of each class. Rows with a null label are not used; labels that
    disagree about an id count as the smaller one. The sampled ids are at most twice `per_class`
    for each of the two classes, so they are broadcast and the texts stay where they are."""
    clean = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (remainder("doc_id", modulo) != held_out))
        .groupBy("doc_id").agg(F.min(label).cast("int").alias("_label"))
    )
    counts, keep = shares(clean, "_label", per_class)
    ids = sample(clean, "_label", keep).limit(4 * per_class)
    return documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id").withColumnRenamed("_label", "label"), counts


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 150, l2: float = 1e-4) -> np.ndarray:
    """Weights (with the bias last) of one logistic regression for each column of `y` (0 or 1), by
    accelerated gradient steps."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    weight = (weight / weight.sum()).astype(x.dtype)[:, None]
    rate = 4.0 / max(float((weight[:, 0] * (x * x).sum(1)).sum()), 1e-9)
    w = np.zeros((x.shape[1], y.shape[1]), x.dtype)
    before = w
    for step in range(steps):
        ahead = w + (w - before) * (step / (step + 3))
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        before, w = w, ahead - rate * (x.T @ ((p - y) * weight) + l2 * ahead)
    return w


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
