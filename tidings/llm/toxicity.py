"""Toxic spans by a linear-chain conditional random field.

The labels are about whole texts, so token labels come first: words that occur in far more toxic
than clean sampled texts (log-odds of document counts) are the evidence, and strong ones mark a
token of a toxic text as toxic; all tokens of clean texts are clean. A two-state chain over the
tokens is trained on them with features for the strength of the token's evidence and that of its
neighbours.

Scoring runs forward-backward over the whole text. Tokens without evidence at or beside them share
one potential, so a run of k of them is the k-th power of one 2 x 2 matrix. The marginals of a
text are gathered into its score by a logistic layer, and tokens with a marginal of `SPAN` or more
are the offending offsets (code points, end exclusive, neighbours joined).

Fitted on at most about `PER_CLASS` texts of each label, stored once, with all their words of evidence and
all their segments around tokens with evidence; a step takes them a block at a time. Defined results: a null or empty text has
no tokens; without labels or evidence every score is the share of toxic labels (0 without any);
labels that disagree count as clean; repeated rows give the same result; other columns are kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import remainder, stored
from tidings.llm.training import joined_sample, logistic, sigmoid

PER_CLASS = 2000
TOKEN = re.compile(r"[^\W\d_]+")
LEAST = 4  # toxic texts a word must occur in
WEAK, STRONG = 1.0, 2.0  # log-odds
SEGMENT = 32
BLOCK = 8192  # segments in one step of the gradient
SPAN = 0.5
CUT = 0.5
# features of a token: its level (0 none, 1 weak .. LEVELS-1), a strong left or right neighbour
LEVELS = 5
STEPS, RATE = 80, 0.1
RESULT = "score double, spans array<struct<start:int,stop:int,marginal:double>>"


def level(odds: float) -> int:
    return 0 if odds < WEAK else 1 + min(LEVELS - 2, int((odds - WEAK) / (STRONG - WEAK)))


def evidence(sample: DataFrame, n_toxic: int, n_clean: int) -> dict[str, int]:
    """Levels of the words that speak for toxicity. Counts are made by Spark over the sample."""
    distinct = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]+"), F.lit(0)))
    toxic = F.count_if(F.col("label") > 0)
    counts = sample.select("label", F.explode(distinct).alias("word")).groupBy("word").agg(
        toxic.alias("a"), F.count_if(F.col("label") <= 0).alias("b"))
    odds = F.log((F.col("a") + 0.5) / (n_toxic - F.col("a") + 0.5)) - F.log((F.col("b") + 0.5) / (n_clean - F.col("b") + 0.5))
    # a word must be surprising as well, or long tails of rare words would come in by chance
    expected = (F.col("a") + F.col("b")) * (n_toxic / (n_toxic + n_clean))
    sure = (F.col("a") - expected) / F.sqrt(expected * (n_clean / (n_toxic + n_clean)) + 0.5)
    rows = (
        counts.withColumns({"odds": odds, "sure": sure}).filter((F.col("a") >= LEAST) & (F.col("odds") >= WEAK) & (F.col("sure") >= 4))
        .select("word", "odds").collect()
    )
    return {r["word"]: level(r["odds"]) for r in rows}


def levels_of(text: str | None, lexicon: dict[str, int]) -> list[tuple[int, int]]:
    """(place, level) of the tokens with evidence, and the number of tokens as the last place."""
    words = TOKEN.findall((text or "").lower())
    return [(i, lexicon[w]) for i, w in enumerate(words) if w in lexicon] + [(len(words), 0)]


def features(levels: np.ndarray) -> np.ndarray:
    """One-hot level and strong neighbours, for arrays of levels along the last axis."""
    strong = (levels >= 2).astype(np.float64)
    left = np.zeros_like(strong)
    right = np.zeros_like(strong)
    left[..., 1:], right[..., :-1] = strong[..., :-1], strong[..., 1:]
    return np.concatenate([np.eye(LEVELS)[levels], left[..., None], right[..., None]], axis=-1)


@dataclass
class Chain:
    """States 0 clean, 1 toxic: emission score of state 1 is features @ emit; trans[from, to]."""

    emit: np.ndarray = field(default_factory=lambda: np.zeros(LEVELS + 2))
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def fit(self, levels: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> None:
        """Likelihood ascent (Adam) over equally long segments; all segments step together."""
        n = len(labels)
        m = [np.zeros(LEVELS + 2), np.zeros((2, 2))]
        v = [np.zeros(LEVELS + 2), np.zeros((2, 2))]
        weight = weight / weight.sum()
        for step in range(1, STEPS + 1):
            g_emit, g_trans = -1e-4 * self.emit, -1e-4 * self.trans
            for at in range(0, n, BLOCK):
                part = slice(at, at + BLOCK)
                emit, trans = self._gradient(levels[part], labels[part], weight[part])
                g_emit, g_trans = g_emit + emit, g_trans + trans
            for i, (value, g) in enumerate(((self.emit, g_emit), (self.trans, g_trans))):
                m[i] += 0.1 * (g - m[i])
                v[i] += 0.01 * (g * g - v[i])
                value += RATE * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-9)

    def _gradient(self, levels: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the weighted log-likelihood of a block of segments."""
        f = features(levels)
        n, length = labels.shape
        score = np.stack([np.zeros((n, length)), f @ self.emit], -1)
        alpha, beta = np.empty_like(score), np.zeros_like(score)
        alpha[:, 0] = score[:, 0]
        for t in range(1, length):
            alpha[:, t] = np.logaddexp(alpha[:, t - 1, :1] + self.trans[0], alpha[:, t - 1, 1:] + self.trans[1]) + score[:, t]
        for t in range(length - 2, -1, -1):
            after = beta[:, t + 1] + score[:, t + 1]
            beta[:, t] = np.logaddexp(after[:, :1] + self.trans[:, 0], after[:, 1:] + self.trans[:, 1])
        total = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])[:, None]
        toxic = np.exp(alpha[..., 1] + beta[..., 1] - total)
        g_emit = ((labels - toxic)[..., None] * f * weight[:, None, None]).sum((0, 1))
        g_trans = np.zeros((2, 2))
        for a in (0, 1):
            for b in (0, 1):
                pair = np.exp(alpha[:, :-1, a] + self.trans[a, b] + score[:, 1:, b] + beta[:, 1:, b] - total)
                seen = (labels[:, :-1] == a) & (labels[:, 1:] == b)
                g_trans[a, b] = ((seen - pair) * weight[:, None]).sum()
        return g_emit, g_trans

    def __post_init__(self):
        self._power: dict = {}

    def run(self, k: int, plain: np.ndarray) -> np.ndarray:
        """The k-th power of the matrix of a plain token, scaled by its largest entry."""
        if k not in self._power:
            if len(self._power) > 50_000:
                self._power.clear()
            out, base, left = np.eye(2), plain, k
            while left:
                if left & 1:
                    out = out @ base
                    out = out / out.max()
                base = base @ base
                base = base / base.max()
                left >>= 1
            self._power[k] = out
        return self._power[k]

    def marginals(self, found: list[tuple[int, int]]) -> list[tuple[int, float]]:
        """(place, probability of the toxic state) of the tokens with evidence and the tokens
        beside them, by forward-backward over all tokens. `found` ends with the token count."""
        n, levels = found[-1][0], dict(found[:-1])
        places = sorted({q for p in levels for q in (p - 1, p, p + 1) if 0 <= q < n})
        if not places:
            return []
        strong = lambda p: levels.get(p, 0) >= 2
        step = np.exp(self.trans)
        plain = step * np.exp([0.0, self.emit[0]])
        emits = [np.exp([0.0, self.emit[levels.get(p, 0)] + strong(p - 1) * self.emit[-2] + strong(p + 1) * self.emit[-1]]) for p in places]
        # the first token has no transition into it
        start = np.array([1.0, 1.0]) if places[0] == 0 else np.exp([0.0, self.emit[0]]) @ self.run(places[0] - 1, plain)
        forward = []
        for i, p in enumerate(places):
            if i:
                start = forward[-1] @ self.run(p - places[i - 1] - 1, plain) @ step
            elif p:
                start = start @ step
            forward.append(start * emits[i] / (start * emits[i]).sum())
        back = self.run(n - 1 - places[-1], plain) @ np.ones(2)
        out = []
        for i in range(len(places) - 1, -1, -1):
            both = forward[i] * back
            out.append((places[i], float(both[1] / both.sum())))
            if i:
                back = self.run(places[i] - places[i - 1] - 1, plain) @ (step @ (emits[i] * back))
                back = back / back.sum()
        return out[::-1]


@dataclass
class Model:
    lexicon: dict[str, int]
    chain: Chain
    layer: np.ndarray | None  # of gathered(), bias last
    prior: float

    def judge(self, text: str | None) -> tuple[float, list[dict]]:
        found = levels_of(text, self.lexicon)
        marginals = self.chain.marginals(found)
        score = self.prior if self.layer is None else float(sigmoid(gathered(marginals) @ self.layer[:-1, 0] + self.layer[-1, 0]))
        hot = {p: m for p, m in marginals if m >= SPAN}
        spans: list[dict] = []
        if hot:
            last = -2
            for i, token in enumerate(_places(text)):
                if i in hot:
                    if i == last + 1:
                        spans[-1]["stop"] = token[1]
                        spans[-1]["marginal"] = max(spans[-1]["marginal"], hot[i])
                    else:
                        spans.append({"start": token[0], "stop": token[1], "marginal": hot[i]})
                    last = i
        return score, spans


def _places(text: str):
    """(start, stop) of the tokens. Lower case may be longer than the text (one letter becomes
    two); then the text is lowered letter by letter and places are mapped back."""
    low = text.lower()
    if len(low) == len(text):
        return [m.span() for m in TOKEN.finditer(low)]
    origin = [i for i, c in enumerate(text) for _ in c.lower()]
    origin = origin[: len(low)] + [len(text)] * (len(low) - len(origin) + 1)
    return [(origin[m.start()], origin[m.end() - 1] + 1) for m in TOKEN.finditer(low)]


def gathered(marginals: list[tuple[int, float]]) -> np.ndarray:
    """What a text's marginals say together: the largest, their sum, and its logarithm."""
    values = [m for _, m in marginals]
    return np.array([max(values, default=0.0), min(sum(values), 20.0) / 5, np.log1p(sum(values))])


def segments_of(places: list[tuple[int, int]]) -> list[np.ndarray]:
    """Levels of the stretches of `SEGMENT` tokens that cover all tokens with evidence; one without
    evidence for a text that has none. `places` ends with the token count."""
    out, seen = [], -1
    for i, (p, _) in enumerate(places[:-1] or [(places[-1][0] // 2, 0)]):
        if p <= seen:
            continue
        begin = max(0, p - 5)
        line = np.zeros(SEGMENT, np.int8)
        for q, level_ in places[max(0, i - 5) : min(len(places) - 1, i + SEGMENT)]:
            if begin <= q < begin + SEGMENT:
                line[q - begin] = level_
        out.append(line)
        seen = begin + SEGMENT
    return out


def fit(documents: DataFrame, labels: DataFrame, held: int = 0, modulo: int = 5, per_class: int = PER_CLASS) -> Model:
    rows, counts = joined_sample(documents, labels, "toxic", held, modulo, per_class)
    n_toxic = sum(n for k, n in counts.items() if k > 0)
    n_clean = sum(n for k, n in counts.items() if k <= 0)
    prior = n_toxic / max(1, n_toxic + n_clean)
    model = Model({}, Chain(), None, prior)
    if not n_toxic or not n_clean:
        return model
    rows = stored(rows, "toxic-sample")  # read for counts, words and segments
    # what was really sampled: shares are kept by hash, so it can be more than `per_class`
    sampled = rows.agg(F.count_if(F.col("label") > 0).alias("toxic"), F.count_if(F.col("label") <= 0).alias("clean")).first()
    if not sampled["toxic"] or not sampled["clean"]:
        return model
    model.lexicon = evidence(rows, sampled["toxic"], sampled["clean"])
    if not model.lexicon:
        return model
    lexicon = model.lexicon

    def found(batches):
        for batch in batches:
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "label": batch["label"],
                "found": [np.array(levels_of(t, lexicon), np.int32).tobytes() for t in batch["text"]],
            })

    got = rows.mapInPandas(found, "doc_id long, label int, found binary").limit(4 * per_class).collect()
    got = sorted((r["doc_id"], r["label"], bytes(r["found"])) for r in got)
    bags = [(int(label > 0), [tuple(map(int, x)) for x in np.frombuffer(data, np.int32).reshape(-1, 2)]) for _, label, data in got]
    share = {1: n_toxic / max(1, sum(b[0] for b in bags)), 0: n_clean / max(1, sum(1 - b[0] for b in bags))}
    segments, tags, weight = [], [], []
    for label, places in bags:
        for line in segments_of(places):
            segments.append(line)
            tags.append((line >= 2) & (label == 1))
            weight.append(share[label])
    if segments:
        model.chain.fit(np.array(segments), np.array(tags), np.array(weight))
        x = np.array([gathered(model.chain.marginals(places)) for _, places in bags])
        y = np.array([[float(label)] for label, _ in bags])
        model.layer = logistic(x, y, np.array([share[label] for label, _ in bags]), steps=600, l2=1e-5)
    return model


def score(documents: DataFrame, model: Model) -> DataFrame:
    """The documents with score and spans."""
    @F.pandas_udf(RESULT)
    def judge(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.judge(t) for t in texts], columns=["score", "spans"])

    judged = documents.withColumn("_judged", judge("text"))
    return judged.withColumns({n: F.col("_judged")[n] for n in ("score", "spans")}).drop("_judged")


def classify(documents: DataFrame, labels: DataFrame, held: int = 0, modulo: int = 5) -> DataFrame:
    """The documents with held_out, score, spans and predicted."""
    scored = score(documents, fit(documents, labels, held, modulo))
    return scored.withColumns({
        "held_out": remainder("doc_id", modulo) == held, "predicted": F.when(F.col("score") >= CUT, 1).otherwise(0),
    })
