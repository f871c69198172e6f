"""Language identification with error-correcting output codes.

Every language gets a codeword of plus and minus ones; for each bit a binary classifier over
hashed 1- to 3-grams of characters predicts it. Decoding sums, for each codeword, the logistic
loss of its bits against the margins, weighted by how well each bit did on the part of the sample
kept aside; the nearest codeword wins and a small lead is flagged as ambiguous.

Fitted on a sample of at most about `PER_LANGUAGE` rows of each language; whole texts are used
everywhere. Defined results: `und` with score 0 for a null text, a text without letters, or when
there is nothing to learn from; with one language it is always that one; ties go to the language
that sorts first; repeated rows give the same result; other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import remainder
from tidings.llm.training import logistic, sample, shares

PER_LANGUAGE = 400
BUCKET_BITS = 11
BUCKETS = 1 << BUCKET_BITS
PIECE = 1 << 20  # code points hashed at a time
EXHAUSTIVE = 5  # up to so many languages every useful bit is used
LEAD = 0.2
RESULT = "lang_pred string, score double, ambiguous boolean"


def profile(text: str) -> np.ndarray:
    """Square roots of the shares of the hashed n-grams of the whole text."""
    counts = np.zeros(BUCKETS)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    shift = np.uint32(32 - BUCKET_BITS)
    for at in range(0, len(points), PIECE):
        a = points[at : at + PIECE + 2]  # n-grams that start in this piece
        n = min(PIECE, len(points) - at)
        one = a * np.uint32(2654435761)
        counts += np.bincount(one[:n] >> shift, minlength=BUCKETS)
        two = (one[:-1] ^ (a[1:] * np.uint32(40503))) * np.uint32(2246822519)
        counts += np.bincount(two[:n] >> shift, minlength=BUCKETS)
        three = ((two[:-1] >> np.uint32(3)) ^ (a[2:] * np.uint32(97787))) * np.uint32(3266489917)
        counts += np.bincount(three[:n] >> shift, minlength=BUCKETS)
    return np.sqrt(counts / max(counts.sum(), 1)).astype(np.float32)


def codewords(k: int, seed: int = 11) -> np.ndarray:
    """k codewords of -1 and 1 (k x bits): all divisions of few languages in two, else random
    bits, of which the set with the largest smallest distance is kept."""
    if k <= EXHAUSTIVE:
        bits = [[1 if (b >> i) & 1 else -1 for i in range(k)] for b in range(1, 1 << (k - 1))]
        return np.array(bits).T.reshape(k, -1)
    draw = np.random.default_rng(seed)
    length = max(15, int(np.ceil(10 * np.log2(k))))
    best, far = None, -1
    for _ in range(200):
        code = draw.choice([-1, 1], (k, length))
        code = code[:, abs(code.sum(0)) < k]
        distance = (code.shape[1] - code @ code.T) / 2 + np.eye(k) * 1e9
        if distance.min() > far:
            best, far = code, distance.min()
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    trust: np.ndarray  # of each bit

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the nearest codeword, its score and the lead over the next) of profiles."""
        margins = x @ self.weights[:-1] + self.weights[-1]
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None])
        near = np.exp(-(loss * self.trust).sum(2) + 1e-12)
        near /= near.sum(1, keepdims=True)
        order = np.sort(near, axis=1)
        return near.argmax(1), np.stack([order[:, -1], order[:, -1] - order[:, -2]], 1)


def fit(documents: DataFrame, train: Column, per_language: int = PER_LANGUAGE) -> Model | None:
    """A model from the rows where `train` holds and text and lang are known."""
    known = documents.filter(train & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    counts, keep = shares(known.select("lang"), "lang", per_language)
    languages = sorted(counts)
    if not languages:
        return None
    code = codewords(len(languages))
    if len(languages) == 1:
        return Model(languages, code, np.zeros((BUCKETS + 1, 0), np.float32), np.ones(0))

    def profiles(batches):
        for batch in batches:
            yield pd.DataFrame({"lang": batch["lang"], "x": [profile(t).tobytes() for t in batch["text"]]})

    rows = sample(known, "lang", keep).mapInPandas(profiles, "lang string, x binary").limit(2 * per_language * len(languages)).collect()
    rows = sorted((r["lang"], bytes(r["x"])) for r in rows)
    x = np.stack([np.frombuffer(r[1], np.float32) for r in rows])
    place = np.array([languages.index(r[0]) for r in rows])
    y = (code[place] > 0).astype(np.float32)
    aside = np.arange(len(x)) % 5 == 0
    weight = 1.0 / np.bincount(place)[place]
    weights = logistic(x[~aside], y[~aside], weight[~aside])
    right = ((x[aside] @ weights[:-1] + weights[-1] > 0) == (y[aside] > 0.5)).mean(0)
    trust = np.log((right + 0.05) / (1.05 - right)).clip(0.05)
    return Model(languages, code, weights, trust / trust.mean())


def predict(documents: DataFrame, model: Model | None) -> DataFrame:
    """The documents with lang_pred, score and ambiguous."""

    @F.pandas_udf(RESULT)
    def judge(texts: pd.Series) -> pd.DataFrame:
        out = [("und", 0.0, True)] * len(texts)
        known = [i for i, t in enumerate(texts) if model is not None and t is not None and any(map(str.isalpha, t))]
        if known and len(model.languages) == 1:
            for i in known:
                out[i] = (model.languages[0], 1.0, False)
        elif known:
            for at in range(0, len(known), 256):
                part = known[at : at + 256]
                best, sure = model.decode(np.stack([profile(texts.iloc[i]) for i in part]))
                for i, b, (score, lead) in zip(part, best, sure):
                    out[i] = (model.languages[b], float(score), bool(lead < LEAD))
        return pd.DataFrame(out, columns=["lang_pred", "score", "ambiguous"])

    judged = documents.withColumn("_judged", judge("text"))
    return judged.withColumns({n: F.col("_judged")[n] for n in ("lang_pred", "score", "ambiguous")}).drop("_judged")


def identify(documents: DataFrame, modulo: int = 4, held: int = 2) -> DataFrame:
    """The documents with held_out, lang_pred, score and ambiguous; what is held out by the hash
    of its id is never learned from."""
    out = remainder("doc_id", modulo) == held
    model = fit(documents, ~out)
    return predict(documents, model).withColumn("held_out", out)
