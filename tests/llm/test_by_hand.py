"""Operators without SQL against plain calculations: the pipeline, lattices, codewords, attention, cutoffs."""

import collections
import itertools
import math
import os
import sys

import numpy as np
import pytest

from tests.llm.test_llm import brute_hits, docs
from tidings.llm import jaccard, language, pieces, pii, quality_model, quality_rules, secrets, toxicity

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


# --- pipeline

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, note string"


def prose(draw, n):
    """Words in short sentences, no two texts alike."""
    return " ".join(f"{'The' if i % 9 == 0 else ''} w{draw.integers(0, 10**6):x}{'.' if i % 9 == 8 else ''}".strip() for i in range(n))


def corpus():
    """(rows, labels, benchmark): clean and bad texts, copies, benchmark passages, secrets, odd rows."""
    draw = np.random.default_rng(6)
    texts = [prose(draw, int(draw.integers(60, 160))) for _ in range(110)]
    bad = ["BUY *** NOW!! $$$ " * int(draw.integers(20, 60)) + f"{i}" for i in range(60)]
    items = [(1, prose(draw, 24)), (2, prose(draw, 11)), (3, None), (4, "zq only")]
    for i in range(12):  # near copies and exact ones, some ahead of what they were made of
        words = texts[i].split(" ")
        words[20] = f"n{i}"
        texts.append(" ".join(words))
    own = [prose(draw, 90) for _ in range(5)]
    texts += texts[30:36] + [own[0] + " " + items[0][1], items[1][1].upper() + " " + own[1], "zq, only " + own[2]]
    texts += [own[3] + " token=abcdef12 end", "AKIA" + "B7" * 8 + " " + own[4]]
    rows = [(i, t, "en", "s", len(t), "kept") for i, t in enumerate(texts + bad)]
    rows += [(900, None, None, None, None, None), (901, None, "en", "s", 0, "x"), (902, "", "en", "s", 0, "x")]
    labels = [(i, int(i < len(texts)), 0) for i in range(len(texts) + len(bad))]
    return rows, labels, items


def test_pipeline_against_a_plain_run(spark, tmp_path):
    import corpus_pipeline

    rows, labels, items = corpus()
    for name, data, schema in (("documents", rows, DOCUMENTS), ("labels", labels, "doc_id long, quality int, toxic int"),
                               ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    scored = quality_model.classify(frame, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    good = {r["doc_id"]: r["text"] for r in scored.filter("score >= 0.7").collect()}
    assert {i for i, label, _ in labels if label} <= good.keys() and not {i for i, label, _ in labels if not label} & good.keys()

    def shingles(text):
        w = [x for x in "".join(c.lower() if c < "\x80" else c for c in text or "").split()]
        return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()

    sets, label = {i: shingles(t) for i, t in good.items()}, {i: i for i in good}
    for _ in range(3):
        for a, b in itertools.combinations(sorted(good), 2):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                label[a] = label[b] = min(label[a], label[b])
    kept = {i: t for i, t in good.items() if label[i] == i and not brute_hits(t, items)[1]}
    assert len(good) - len(kept) >= 18 + 3  # copies and benchmark passages were there to go
    masked = {i: (t or "").replace("token=abcdef12", secrets.MASK).replace("AKIA" + "B7" * 8, secrets.MASK) for i, t in kept.items()}
    assert sum(secrets.MASK in t for t in masked.values()) == 2

    vocabulary = pieces.load()
    found = collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        assert r["restored"]
        found[r["doc_id"]].append(pieces.decode(r["ids"], vocabulary))
    assert {i: set(texts) for i, texts in found.items()} == {i: {t} for i, t in masked.items()}


def test_stages_keep_the_columns_of_their_input(spark):
    import corpus_pipeline

    rows, labels, items = corpus()
    frame = spark.createDataFrame(rows[:40], DOCUMENTS)
    assert jaccard.one_of_each(frame).columns == frame.columns
    assert secrets.redact(frame).columns == frame.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "SentencePiece encoding and decoding"]


def test_empty_tables_give_no_rows(spark):
    none, labels = docs(spark, ["x"]).limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    made = [quality_rules.verdicts(none, labels), pieces.encode(none), secrets.scan(none), quality_model.classify(none, labels),
            toxicity.classify(none, labels), jaccard.link(none), pii.digest(none)]
    assert [frame.count() for frame in made] == [0] * len(made)


def test_repeated_rows_are_judged_alike(spark):
    text = "mail me@host.example, token=abcdef1 " + "one two three four five six " * 12
    frame = docs(spark, [text]).unionByName(docs(spark, [text]))
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    for made in (quality_rules.verdicts(frame, labels), secrets.scan(frame).select("doc_id", "secrets"), quality_model.classify(frame, labels),
                 toxicity.classify(frame, labels), pii.digest(frame), language.identify(frame), pieces.encode(frame).filter("rank = 1")):
        assert made.count() == 2 and made.distinct().count() == 1


# --- lattices

def segmentations(text, table):
    """Every way to put `text` together from `table`, with its weight."""
    if not text:
        return {(): 1.0}
    out = {}
    for end in range(1, len(text) + 1):
        if text[:end] in table:
            i, weight = table[text[:end]]
            for rest, w in segmentations(text[end:], table).items():
                out[(i, *rest)] = math.exp(weight) * w
    return out


@pytest.mark.parametrize("word", ["thehe", "aaaa", "onion"])
def test_segmentations_by_enumeration(word):
    vocabulary = pieces.load()
    ways = segmentations(pieces.MARK + word, vocabulary.pieces)  # encoding puts a blank before a text
    total = sum(ways.values())
    lattices = pieces.Lattices(vocabulary)
    assert len(ways) > 4
    # more wanted than there are: every one, each once, with its probability, and surely included
    for row in pieces.sample([word] * 20, np.arange(20), lattices, len(ways) + 3):
        assert {tuple(r[0].tolist()): math.exp(r[1]) for r in row} == {ids: pytest.approx(w / total, rel=1e-6) for ids, w in ways.items()}
        assert len(row) == len(ways) and {r[3] for r in row} == {0.0}
        assert [r[2] for r in row] == sorted((r[2] for r in row), reverse=True)
    # the first and the second come as often as sampling without replacement says
    n = 6000
    first, second = collections.Counter(), collections.Counter()
    for row in pieces.sample([word] * n, np.arange(n), lattices, 2):
        first[tuple(row[0][0].tolist())] += 1
        second[tuple(row[1][0].tolist())] += 1
    for ids, w in ways.items():
        p = w / total
        q = sum((v / total) * p / (1 - v / total) for other, v in ways.items() if other != ids)
        for got, share in ((first[ids], p), (second[ids], q)):
            assert abs(got - n * share) <= 5 * math.sqrt(n * share * (1 - share)) + 3


# --- codewords

def test_decoding_by_hand():
    code = language.codewords(4)
    assert code.shape == (4, 7) and min((a != b).sum() for a, b in itertools.combinations(code, 2)) == 4
    draw = np.random.default_rng(1)
    model = language.Model(list("abcd"), code, np.vstack([np.eye(7), np.zeros(7)]), draw.uniform(0.5, 2, 7))
    margins = np.vstack([draw.standard_normal((30, 7)), 3 * code, np.where(np.arange(7) == 2, -3, 3) * code])
    best, sure = model.decode(margins)
    for x, b, (score, lead) in zip(margins, best, sure):
        near = [math.exp(-sum(t * math.log1p(math.exp(-m * c)) for m, c, t in zip(x, word, model.trust))) for word in code]
        share = sorted((v / sum(near) for v in near), reverse=True)
        assert b == near.index(max(near)) and score == pytest.approx(share[0]) and lead == pytest.approx(share[0] - share[1])
    assert best[-4:].tolist() == best[-8:-4].tolist() == [0, 1, 2, 3]  # one wrong bit is corrected
    best, sure = model.decode(np.zeros((1, 7)))  # a tie of all: the first language, flagged by a lead of nothing
    assert best[0] == 0 and sure[0, 0] == pytest.approx(0.25) and sure[0, 1] == pytest.approx(0)


# --- attention

def test_attention_by_hand(monkeypatch):
    model = quality_model.Model()
    text = "".join(f"Line {i} says {'BUY $$$ ' * (i % 7)}\n" for i in range(400))
    rows = quality_model.describe(quality_model.passages(text))
    assert len(rows) > 5
    encoded, energy = [], []
    for x in rows.astype(float):
        z = [math.tanh(v) for v in x @ model.p["w1"] + model.p["b1"]]
        gates = [math.tanh(a) / (1 + math.exp(-b)) for a, b in zip(z @ model.p["v"], z @ model.p["u"])]
        encoded.append(z)
        energy.append(sum(g * a for g, a in zip(gates, model.p["a"])))
    share = [math.exp(e) / sum(map(math.exp, energy)) for e in energy]
    bag = [sum(s * z[j] for s, z in zip(share, encoded)) for j in range(len(encoded[0]))]
    want = 1 / (1 + math.exp(-sum(v * c for v, c in zip(bag, model.p["c"])) - model.p["b"][0]))
    assert model.score(text) == pytest.approx(want, abs=1e-5)
    monkeypatch.setattr(quality_model, "BLOCK", 2)  # the running maximum over blocks
    assert model.score(text) == pytest.approx(want, abs=1e-5)


def test_gradient_by_differences():
    draw, model = np.random.default_rng(2), quality_model.Model()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, size = draw.uniform(0, 0.5, (7, model.p["w1"].shape[0])), np.array([3, 1, 3])
    y, weight = np.array([1.0, 0.0, 0.0]), np.array([1.0, 0.5, 1.5])

    def loss():
        first, total = np.append(0, np.cumsum(size)), 0.0
        z, _, _, e = model.encode(x)
        for i in range(3):
            part = slice(first[i], first[i + 1])
            a = np.exp(e[part]) / np.exp(e[part]).sum()
            p = 1 / (1 + np.exp(-(a @ z[part] @ model.p["c"] + model.p["b"][0])))
            total -= weight[i] * (y[i] * np.log(p) + (1 - y[i]) * np.log(1 - p)) / 3
        return total + 0.5e-4 * ((model.p["w1"] ** 2).sum() + (model.p["c"] ** 2).sum())

    grads = model._gradient(x, size, y, weight)
    for name, g in grads.items():
        for place in draw.choice(g.size, min(6, g.size), replace=False):
            flat, step = model.p[name].reshape(-1), 1e-5
            flat[place] += step
            up = loss()
            flat[place] -= 2 * step
            down = loss()
            flat[place] += step
            assert g.reshape(-1)[place] == pytest.approx((up - down) / (2 * step), rel=1e-3, abs=1e-6), name


# --- cutoffs

def test_cutoffs_are_certified_by_exact_bounds(spark):
    draw = np.random.default_rng(9)
    rows, labels = [], []
    for i in range(2300):
        good = i % 23 != 0
        signs = int(draw.integers(0, 3)) if good and i % 400 else int(draw.integers(8, 60))
        words = [f"{i % 50}a{j}" for j in range(60)]
        for at in range(signs):
            words[at] += "#"
        lang = "en" if i < 2200 else "fr"
        rows.append((i, " ".join(words), lang))
        labels.append((i, int(good), 0))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    measured = quality_rules.measures(frame)
    chosen = {(r["stratum"], r["rule"]): r["cutoff"] for r in quality_rules.cutoffs(measured, labelled).collect()}

    share, want = quality_rules.ALPHA / 4, {}
    signals = {"symbols": lambda t: t.count("#") / 60, "length": lambda t: len(t.replace(" ", "")) / 60,
               "dup_lines": lambda t: 0.0, "repeats": lambda t: 0.0}
    quality_of = {i: q for i, q, _ in labels}
    for lang in ("en", "fr"):
        for rule, signal in signals.items():
            best = None
            mine = [(signal(t), quality_of[i]) for i, t, at in rows if at == lang]
            n = sum(q for _, q in mine)
            for c in range(1, quality_rules.CELLS + 1):
                above = [q for v, q in mine if v > c * quality_rules.RULES[rule] + 1e-12]
                k, caught = sum(above), len(above) - sum(above)
                tail = sum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(share)
                                    + (n - j) * math.log(1 - share)) for j in range(k + 1))
                if tail <= quality_rules.DELTA / 4 / 2 and caught and (best is None or (caught, c) >= best):
                    best = (caught, c)
            if best:
                want[lang, rule] = best[1]
    assert chosen == want and ("en", "symbols") in want and not any(lang == "fr" for lang, _ in want)
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.verdicts(frame, labelled).collect()}
    limit = want["en", "symbols"] * quality_rules.RULES["symbols"]
    for i, text, lang in rows:
        if ("en", "length") not in want:
            assert kept[i] == (lang == "fr" or signals["symbols"](text) <= limit + 1e-12)


def test_small_strata_share_a_pool_that_rejects_their_bad_texts(spark):
    rows, labels = [], []

    def add(lang, many, signs, quality):
        for _ in range(many):
            i = len(rows)
            rows.append((i, " ".join(f"{i % 50}a{j}" + "#" * (j < signs) for j in range(60)), lang, "mine"))
            if quality is not None:
                labels.append((i, quality))

    for lang, many in (("en", 1200), ("fr", 560), ("de", 500), (None, 30)):
        add(lang, many, 1, 1)
        add(lang, 3, 40, 0)
    add("es", 4, 40, 0)
    first = len(rows)
    for lang in ("en", "fr", "de", None, "es", "pl"):
        add(lang, 1, 40, None)
        add(lang, 1, 0, None)
    schema = "doc_id long, text string, lang string, stratum string"
    frame, labelled = spark.createDataFrame(rows, schema), spark.createDataFrame(labels, "doc_id long, quality int")
    chosen = {(r["stratum"], r["rule"]) for r in quality_rules.cutoffs(quality_rules.measures(frame), labelled).collect()}
    # en alone, the pool has 1,090 good texts; nothing is known of pl
    assert {s for s, rule in chosen if rule == "symbols"} == {"en", "fr", "de", "", "es"}
    got = {r["doc_id"]: (r["kept"], r["stratum"]) for r in quality_rules.verdicts(frame, labelled).collect()}
    assert set(got.values()) <= {(True, "mine"), (False, "mine")}
    assert [got[i][0] for i in range(first, len(rows))] == [False, True] * 5 + [True, True]
    assert all(got[i][0] == bool(q) for i, q in labels)


def test_as_many_strata_stand_alone_as_can_certify_something(spark):
    draw = np.random.default_rng(4)
    share, risk = 0.005, 0.0125
    for _ in range(3):
        sizes = {f"l{i}": int(n) for i, n in enumerate(draw.integers(0, 2600, 12))}
        order = sorted(sizes, key=lambda s: (-sizes[s], s))
        many = max((m for m in range(1, 13) if 0.995 ** sizes[order[m - 1]] <= risk / (m + 1)), default=0)
        grouped, groups = quality_rules.grouping(spark.createDataFrame(list(sizes.items()), "stratum string, n long"), share, risk)
        assert groups == many + 1
        assert {r["stratum"] for r in grouped.collect() if r["group"] is not None} == set(order[:many])
