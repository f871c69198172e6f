"""Quality of texts by attention-based multiple-instance learning.

A text is a bag of passages. Each passage is described by its characters, hashed pairs of
characters and repetition, and encoded by a learned layer. Gated attention (a tanh and a sigmoid
branch) gives every passage a weight, learned from labels of whole texts only; the weighted sum of
the encodings is scored.

Fitted on all passages of a sample of at most about `PER_CLASS` texts of each label; where these
have more than about `PASSAGES` passages, fewer texts are drawn, by the hash of their ids and so
whatever their length. Scoring uses every passage as well, a block at a time with running sums. Defined results: a null or empty text is one empty passage; without labels the score is 0.5;
with one label only it is that label's; repeated rows give the same result; other columns are kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import remainder
from tidings.llm.training import BINS, joined_sample, sigmoid

PER_CLASS = 1500
PASSAGES = 200_000  # of all sampled texts, about 800 bytes each on the driver
PASSAGE = 600  # code points
PAIRS = 256
SINGLES = 136
EXTRA = 6
WIDTH = SINGLES + PAIRS + EXTRA
HIDDEN, GATE = 32, 16
EPOCHS, BATCH, RATE = 14, 64, 0.004
BLOCK = 2048  # passages encoded at a time
CUT = 0.7


def passages(text: str | None) -> list[str]:
    """Pieces of `PASSAGE` code points, a short rest joined to the last."""
    text = text or ""
    n = max(1, (len(text) + PASSAGE // 2) // PASSAGE)
    return [text[i * PASSAGE : (i + 1) * PASSAGE if i < n - 1 else None] for i in range(n)]


def describe(parts: list[str]) -> np.ndarray:
    """A row of features for every passage."""
    out = np.zeros((len(parts), WIDTH), np.float32)
    lengths = np.array([len(p) for p in parts])
    points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(parts)), lengths)
    single = np.where(points < 128, points, 128 + (points >> 7) % 8).astype(np.int64)
    counts = np.bincount(owner * SINGLES + single, minlength=len(parts) * SINGLES).reshape(-1, SINGLES)
    # the kind of two neighbours, not the letters: lower, upper, digit and space as one sign each
    kind = KIND[single]
    pair = (kind[:-1] * 16 + kind[1:])[owner[:-1] == owner[1:]] if len(points) > 1 else np.zeros(0, np.int64)
    pairs = np.bincount(owner[:-1][owner[:-1] == owner[1:]] * PAIRS + pair, minlength=len(parts) * PAIRS).reshape(-1, PAIRS)
    size = np.maximum(lengths, 1)[:, None]
    out[:, :SINGLES] = np.sqrt(counts / size)
    out[:, SINGLES : SINGLES + PAIRS] = np.sqrt(pairs / size)
    for i, part in enumerate(parts):
        words = part.split()
        lines = [x for x in part.split("\n") if x]
        n = max(1, len(words))
        out[i, -EXTRA:] = (
            len(set(words)) / n, len(set(zip(words, words[1:]))) / n, min(2.0, len(part) / n / 10),
            len(set(lines)) / max(1, len(lines)), min(1.0, len(part) / PASSAGE), min(1.0, len(words) / 50),
        )
    return out


def _kinds() -> np.ndarray:
    """16 kinds of characters: five for letters, digits and space, eleven for the rest."""
    kinds = np.array([5 + c % 11 for c in range(SINGLES)])
    for c in range(SINGLES):
        sign = chr(c) if c < 128 else "é"
        kinds[c] = 0 if sign.islower() else 1 if sign.isupper() else 2 if sign.isdigit() else 3 if sign == " " else 4 if sign == "\n" else kinds[c]
    return kinds.astype(np.int64)


KIND = _kinds()


class Model:
    def __init__(self, seed: int = 3):
        draw = np.random.default_rng(seed)
        normal = lambda *shape: (draw.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {
            "w1": normal(WIDTH, HIDDEN), "b1": np.zeros(HIDDEN, np.float32), "v": normal(HIDDEN, GATE), "u": normal(HIDDEN, GATE),
            "a": normal(GATE), "c": normal(HIDDEN), "b": np.zeros(1, np.float32),
        }
        self.constant: float | None = None

    def encode(self, x):
        p = self.p
        z = np.tanh(x @ p["w1"] + p["b1"])
        t, s = np.tanh(z @ p["v"]), sigmoid(z @ p["u"])
        return z, t, s, (t * s) @ p["a"]

    def fit(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """Passages `x` of bags that begin at `starts`; Adam over batches of bags."""
        ends = np.append(starts[1:], len(x))
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        draw, step = np.random.default_rng(5), 0
        weight = weight / weight.mean()
        for epoch in range(EPOCHS):
            order = draw.permutation(len(starts))
            for at in range(0, len(order), BATCH):
                bags = order[at : at + BATCH]
                rows = np.concatenate([np.arange(starts[b], ends[b]) for b in bags])
                size = ends[bags] - starts[bags]
                step += 1
                for k, g in self._gradient(x[rows].astype(np.float32), size, y[bags], weight[bags]).items():
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    rate = RATE * (1 - epoch / EPOCHS)
                    self.p[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def _gradient(self, x, size, y, weight):
        p = self.p
        first = np.append(0, np.cumsum(size)[:-1])
        bag = np.repeat(np.arange(len(size)), size)
        z, t, s, e = self.encode(x)
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        alpha = e / np.add.reduceat(e, first)[bag]
        whole = np.add.reduceat(alpha[:, None] * z, first, axis=0)
        d = (sigmoid(whole @ p["c"] + p["b"]) - y) * weight / len(size)
        d_whole = d[:, None] * p["c"]
        d_alpha = (z * d_whole[bag]).sum(1)
        d_e = alpha * (d_alpha - np.add.reduceat(alpha * d_alpha, first)[bag])
        d_gate = d_e[:, None] * p["a"]
        d_v, d_u = d_gate * s * (1 - t * t), d_gate * t * s * (1 - s)
        d_z = (alpha[:, None] * d_whole[bag] + d_v @ p["v"].T + d_u @ p["u"].T) * (1 - z * z)
        grads = {
            "w1": x.T @ d_z + 1e-4 * p["w1"], "b1": d_z.sum(0), "v": z.T @ d_v, "u": z.T @ d_u, "a": (t * s).T @ d_e,
            "c": whole.T @ d + 1e-4 * p["c"], "b": np.array([d.sum()]),
        }
        return {k: g.astype(np.float32) for k, g in grads.items()}

    def score(self, text: str | None) -> float:
        """Of a whole text; attention over blocks of passages with a running maximum."""
        if self.constant is not None:
            return self.constant
        parts, top, total, whole = passages(text), -np.inf, 0.0, np.zeros(HIDDEN)
        for at in range(0, len(parts), BLOCK):
            z, _, _, e = self.encode(describe(parts[at : at + BLOCK]))
            peak = max(top, float(e.max()))
            share = np.exp(e - peak)
            keep = np.exp(top - peak)
            total, whole, top = total * keep + float(share.sum()), whole * keep + share @ z, peak
        return float(sigmoid(float(whole / total @ self.p["c"] + self.p["b"][0])))


def fewer(rows: DataFrame, limit: int = PASSAGES) -> DataFrame:
    """The sampled texts, or a share of them by the hash of the id where all have more than `limit`
    passages. Both classes keep the same share."""
    n = F.greatest(F.lit(1), F.floor((F.coalesce(F.length("text"), F.lit(0)) + PASSAGE // 2) / PASSAGE))
    total = rows.agg(F.sum(n)).first()[0] or 0
    return rows if total <= limit else rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(BINS)) < limit / total * BINS)


def fit(documents: DataFrame, labels: DataFrame, held: int = 2, modulo: int = 4, per_class: int = PER_CLASS, limit: int = PASSAGES) -> Model:
    rows, counts = joined_sample(documents, labels, "quality", held, modulo, per_class)
    model = Model()
    if len(counts) < 2:
        model.constant = float(next(iter(counts), 0.5))
        return model

    def bags(batches):
        names, out, size = ["doc_id", "label", "x"], [], 0
        for batch in batches:
            for doc_id, label, text in zip(batch["doc_id"], batch["label"], batch["text"]):
                parts = passages(text)
                x = np.vstack([describe(parts[at : at + BLOCK]).astype(np.float16) for at in range(0, len(parts), BLOCK)])
                out.append((doc_id, label, x.tobytes()))
                size += len(x)
                if size >= BLOCK:
                    yield pd.DataFrame(out, columns=names)
                    out, size = [], 0
        yield pd.DataFrame(out, columns=names)

    rows = fewer(rows, limit)
    got = rows.mapInPandas(bags, "doc_id long, label int, x binary").limit(4 * per_class).collect()
    got = sorted((r["doc_id"], r["label"], bytes(r["x"])) for r in got)
    if len({g[1] for g in got}) < 2:
        model.constant = float(got[0][1]) if got else 0.5
        return model
    each = [np.frombuffer(g[2], np.float16).reshape(-1, WIDTH) for g in got]
    y = np.array([float(g[1] > 0) for g in got], np.float32)
    sampled = {1.0: (y == 1).sum(), 0.0: (y == 0).sum()}
    real = {1.0: sum(n for k, n in counts.items() if k > 0), 0.0: sum(n for k, n in counts.items() if k <= 0)}
    weight = np.array([real[v] / sampled[v] for v in y], np.float32)
    model.fit(np.vstack(each), np.cumsum([0] + [len(e) for e in each])[:-1], y, weight)
    return model


def score(documents: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """The documents with the probability of label 1."""
    @F.pandas_udf("double")
    def judge(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return documents.withColumn(column, judge("text"))


def classify(documents: DataFrame, labels: DataFrame, held: int = 2, modulo: int = 4) -> DataFrame:
    """The documents with held_out, score and predicted."""
    scored = score(documents, fit(documents, labels, held, modulo))
    return scored.withColumns({
        "held_out": remainder("doc_id", modulo) == held, "predicted": F.when(F.col("score") >= CUT, 1).otherwise(0),
    })
