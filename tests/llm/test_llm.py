"""Small tests of the pipeline operators: brute force, exact round trips, awkward input."""

import hashlib
import itertools
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidings.llm import decontamination, jaccard, language, pieces, pii, quality_model, quality_rules, secrets, toxicity, warc

DOC = "doc_id long, text string, lang string, source string, n_chars long, score string, key string, rep string"


def docs(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", 0, "x", "y", "z") for i, t in enumerate(texts)], DOC)


AWKWARD = [None, "", " \n\t", "one", "one two three four five six seven eight nine ten", "É" * 300, "\U0001f600 word " * 30, "a\x00b", "▁ x ▁"]


def brute_hits(text, items, size=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c < "\x80" else c for c in t or ""))
    words, hit, found = cut(text), set(), set()
    for item, body in items:
        w = cut(body)
        for s in range(max(1, len(w) - size + 1)) if w else ():
            win = w[s : s + size]
            for i in range(len(words) - len(win) + 1):
                if words[i : i + len(win)] == win:
                    hit |= set(range(i, i + len(win)))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def test_decontamination_against_brute_force(spark):
    words = [f"w{i}" for i in range(40)]
    items = [(1, " ".join(words[:14])), (2, "only two"), (3, None), (4, "..."), (10, " ".join(words[5:20])), (11, "Single")]
    texts = AWKWARD + [" ".join(words[2:30]).upper(), "say ONLY two, single. only-two", " ".join(words[:9]), " ".join(words[:10])] * 2
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r for r in decontamination.contamination(docs(spark, texts), bench, block=5).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["items"]) == brute_hits(text, items), text
    kept = {r["doc_id"] for r in decontamination.decontaminate(docs(spark, texts), bench).collect()}
    assert kept == {i for i, t in enumerate(texts) if not brute_hits(t, items)[1]}
    assert decontamination.contamination(docs(spark, texts), bench.limit(0)).filter("contaminated").count() == 0
    assert decontamination.contamination(docs(spark, texts).limit(0), bench).count() == 0


def test_warc_round_trip(spark):
    long = "x" * 99 + "é"
    rows = [(3, "http://a.example/1", long), (1, "http://B.example:80/#f", long), (2, None, long), (4, "http://a.example/1", "short"),
            (5, "u", "short"), (6, "u\r\nv", None), (7, "http://a.example/1", "y" * 200 + "\r\n\r\n"), (None, "n", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit(1))
    got = sorted(map(tuple, warc.roundtrip(pages).collect()), key=str)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        again = html == long and i != 1
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 1 if again else None))
    assert got == sorted(want, key=str)
    assert warc.roundtrip(pages.limit(0)).count() == 0
    assert warc.url_key("https://u@Blog.Example.com:80/a?b#c") == "com,example,blog)/a?b"


def test_index_finds_every_capture_over_block_borders(spark, tmp_path):
    rows = [(f"k{i // 7:03d}", "response", str(i), "a", i, 1) for i in range(300)]
    captures = spark.createDataFrame(rows, "key string, record_type string, digest string, archive string, offset long, length long")
    index = warc.Index(warc.write_index(captures, str(tmp_path), block_lines=5))
    for key in {r[0] for r in rows}:
        assert {x[2] for x in index.find(key)} == {r[2] for r in rows if r[0] == key}
    assert list(index.find("k0005")) == [] and list(index.find("a")) == [] and list(index.find("z")) == []


def test_every_record_is_read_through_the_index(spark, monkeypatch):
    rows = [(i, f"http://a.example/{i % 9}", "short" if i % 4 == 0 else "x" * 150 if i % 4 == 1 else f"{i} " * 40) for i in range(60)]
    pages = spark.createDataFrame([*rows, rows[2], (None, "u", "p"), (None, "u", "q")], "page_id long, url string, html string")
    whole = warc.roundtrip(pages)
    assert whole.count() == 63 and whole.filter("payload_digest is null").count() == 0
    written = warc.write_index
    monkeypatch.setattr(warc, "write_index", lambda captures, folder: written(captures.filter("key not like '%/7 %'"), folder))
    left = {r["page_id"] for r in warc.roundtrip(pages).collect()}
    assert left == {i for i in range(60) if i % 9 != 7} | {None}


def brute_repeats(words):
    tri = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    return len({p for i, t in enumerate(tri) if tri.count(t) > 1 for p in range(i, i + 3)})


def test_quality_measures(spark):
    texts = AWKWARD + ["a b c a b c d", "x x x x x", "l\nl\n \nl | m", "a b c d e f " * 20]
    for r in quality_rules.measures(docs(spark, texts)).collect():
        text = r["text"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), brute_repeats(words))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want


def test_binomial_tail_and_verdicts(spark):
    cases = [(400, 3, 0.02), (50, 0, 0.01), (5, 5, 0.3), (100000, 450, 0.005)]
    frame = spark.createDataFrame(cases, "n long, k long, r double")
    for r in frame.collect():
        got = frame.filter((F.col("n") == r["n"])).select(quality_rules.tail(F.col("n"), F.col("k"), r["r"])).first()[0]
        log = lambda i: math.lgamma(r["n"] + 1) - math.lgamma(i + 1) - math.lgamma(r["n"] - i + 1) + i * math.log(r["r"]) + (r["n"] - i) * math.log(1 - r["r"])
        assert got == pytest.approx(sum(math.exp(log(i)) for i in range(r["k"] + 1)), rel=1e-6)
    labels = spark.createDataFrame([(0, None, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.verdicts(docs(spark, AWKWARD), labels).collect()}
    assert len(kept) == len(AWKWARD) and not any(kept.values())


def test_secret_spans(spark):
    texts = AWKWARD + ['token = "abcdef1"', "token:token:abcdefgh", "AKIA" + "A1" * 8, "AKIAAKIA1", "f00d" * 6, "éé PASSWD=x1y2z3", "q8Zr5Tn2Lw9Kd4Vb7Hs1", "token=abc token=abcdefg"]
    for r in secrets.scan(docs(spark, texts)).collect():
        text, want = r["text"] or "", []
        for kind, pattern, group, least in ((0, r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6), (1, "AKIA[A-Z0-9]+", 0, 20), (2, "[0-9a-f]+", 0, 24)):
            want += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
        assert [tuple(s) for s in r["secrets"] if s["kind"] < 3] == sorted(want), text
    spans = {r["doc_id"]: secrets.KINDS[r["secrets"][0]["kind"]] for r in secrets.scan(docs(spark, texts)).collect() if r["secrets"]}
    assert spans[len(AWKWARD) + 6] == "entropy"
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs(spark, texts)).collect()}
    assert clean[0] is None and clean[3] == "one" and clean[len(AWKWARD) + 5] == "éé [secret]"


def test_placeholders_excuse_their_piece_only(spark):
    key = "9fK2xQ7bT4mZ8pL1wR6vD3nJ"
    texts = [f"é sample-env/{key} x", f"example_id={key}", f"{key}-123456", f"a/{key}/dummy/{key[::-1]}", f"example{key}",
             "sample-key-here-for-123456-and-changeme", "550e8400-e29b-41d4-a716-446655440000", f"0{key}"]
    found = {r["doc_id"]: r for r in secrets.scan(docs(spark, texts)).collect()}
    assert [len(found[i]["secrets"]) for i in range(8)] == [1, 1, 1, 2, 0, 0, 0, 1]
    clean = [r["text"] for r in secrets.redact(docs(spark, texts)).orderBy("doc_id").collect()]
    assert not any(part in clean[i] for i in (0, 1, 2, 3, 7) for part in (key, key[::-1])) and "dummy" in clean[3] and clean[0].startswith("é sample")
    for i in (0, 1, 2, 3):
        assert all(k["stop"] <= len(texts[i]) for k in found[i]["secrets"])


def test_window_entropy_by_counting(spark):
    value = "aab0c1d2e3f4a5b6c7d8e9f0" + "a" * 25
    got = docs(spark, [value]).select(secrets.hot_windows(F.col("text"), F.lit(3.0)).alias("h")).first()["h"]
    bits = lambda w: -sum(w.count(c) / 20 * math.log2(w.count(c) / 20) for c in set(w))
    hot = [i for i in range(len(value) - 19) if bits(value[i : i + 20]) >= 3.0]
    assert (got["first"], got["last"]) == (hot[0], hot[-1])


def test_pii_against_regular_expressions():
    draw, anchors = np.random.default_rng(4), pii.automaton()
    signs = list("0123456789.-+ ()@ab:")
    for _ in range(3000):
        text = "".join(draw.choice(signs, draw.integers(0, 60)))
        want = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        want += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) < 256 for x in m[0].split("."))]
        want += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(d := re.sub("[ -]", "", m[0])) <= 19 and pii.luhn(d)]
        want += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
        assert [s for s in pii.find(text, anchors) if s[0] in pii.BASE] == want, text
    assert pii.find("IBAN: DE12345678 ftp://me:pw@host.example", anchors)[-1] == ("account", 6, 16)


def test_segmentations(spark):
    vocabulary = pieces.load()
    assert all(r["restored"] for r in pieces.encode(docs(spark, AWKWARD), vocabulary).collect())
    lattices = pieces.Lattices(vocabulary)
    alone = list(pieces.sample(["the hat"], np.array([5]), lattices, 3))[0]
    among = list(pieces.sample(["x", "the hat", None], np.array([1, 5, 2]), pieces.Lattices(vocabulary), 3))[1]
    assert [s[0].tolist() for s in alone] == [s[0].tolist() for s in among]
    found = list(pieces.sample(["thehe"] * 4000, np.arange(4000), lattices, 3))
    assert all(len({tuple(s[0]) for s in row}) == 3 for row in found)
    assert np.mean([sum(math.exp(p - q) for _, p, _, q in row) for row in found]) == pytest.approx(1, abs=0.02)
    assert list(pieces.sample([None], np.array([1]), lattices, 2))[0][0][3] == 0.0


def test_pieces_words_and_states():
    """Words are cut as the pattern says; words of one ending share its states."""
    word = re.compile(" *[^ \n▁]+| +|\n|▁")
    texts = ["a  b\n c ▁d▁▁ \n", "", "  ", "é漢 a", "\n", "▁", "x\t y", "a\ud800 b"]
    words, which, sizes = pieces.cut(texts)
    cut = [words[i].decode("utf-8", "surrogatepass") for i in which]
    wanted = [word.findall(" " + t) if t else [] for t in texts]
    assert cut == [w for text in wanted for w in text] and sizes.tolist() == [len(w) for w in wanted]
    lattices = pieces.Lattices(pieces.load())
    list(pieces.sample(["walking"], np.array([1]), lattices, 2))
    before = lattices.n
    list(pieces.sample(["talking", "king walking"], np.array([2, 3]), lattices, 2))
    assert lattices.n == before + 3  # " t", "t" and " king": "alking" and "king" are the ends of the first word


def test_pieces_contents():
    vocabulary = pieces.load()
    contents, ids = pieces.Contents(vocabulary), np.array([272, 4613, 0, 233, 191, 165], np.int32)
    assert contents.spell(ids) == b"".join(vocabulary.content[i] for i in ids)
    assert contents.spell(ids[:0]) == b""


def test_jaccard_components(spark):
    draw = np.random.default_rng(2)
    base = [f"v{i}" for i in draw.integers(0, 400, 90)]
    texts = AWKWARD + ["a b c", "A b\tc", "a b c d"]
    for i in range(40):
        words = list(base)
        for at in draw.integers(0, 90, i % 6):
            words[at] = f"n{i}"
        texts.append(" ".join(words))
    sets = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", jaccard.text_bytes(t))
        sets.append({tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set())
    label = list(range(len(texts)))
    for _ in texts:
        for a, b in itertools.combinations(range(len(texts)), 2):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                label[a] = label[b] = min(label[a], label[b])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link(docs(spark, texts)).collect()}
    assert got == {i: (len(sets[i]), label[i]) for i in range(len(texts))}
    assert jaccard.one_of_each(docs(spark, texts)).count() == len(set(label))


def test_pieces_beginnings_are_found():
    random = np.random.default_rng(5)
    for n in (0, 1, 3, 700):
        held = {int(h): (int(h) % 7 - 1, float(i)) for i, h in enumerate(random.integers(1, 1 << 64, n, np.uint64))}
        table = pieces.Beginnings(held)
        asked = np.concatenate([np.array([0], np.uint64), np.array(list(held), np.uint64), random.integers(0, 1 << 64, 3000, np.uint64)])
        hit, place = table.find(asked)
        assert hit.tolist() == [int(h) in held for h in asked]
        assert [(int(table.ids[p]), float(table.weights[p])) for p in place] == [held[int(h)] for h in asked[hit]]


def test_pieces_roots_of_words_of_any_bytes():
    vocabulary = pieces.load()
    words = ["the", " caf\u00e9", "\n", "\u4e2d\u6587", " \U0001f600x", "\ud800y", " the", "z"]
    units = [w.encode("utf-8", "surrogatepass") for w in words]
    together, roots = pieces.Lattices(vocabulary), []
    found = together.learn(units)
    assert found.tolist() == [together.roots[u] for u in units]
    for unit, root in zip(units, found):
        alone = pieces.Lattices(vocabulary)
        [own] = alone.learn([unit])
        assert abs(alone.after[own] - together.after[root]) < 1e-12


def test_jaccard_with_other_words_and_percent(spark):
    base = [f"w{i}" for i in range(120)]
    # shared of all: 4 words 117/127 and 117/139, 5 words 116/126 and 116/138
    frame = docs(spark, [" ".join(base), " ".join(base + [f"x{i}" for i in range(10)]), " ".join(base + [f"y{i}" for i in range(22)])])
    kept = lambda *a: {r["doc_id"] for r in jaccard.one_of_each(frame, *a).collect()}
    assert kept() == {0, 2} and kept(5, 80) == {0} and kept(5, 95) == {0, 1, 2}
    assert {r["n_shingles"] for r in jaccard.link(frame, 5, 80).collect()} == {116, 126, 138}


def test_jaccard_with_repeated_and_missing_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(120)) for x in "abc")
    rows = [(5, a), (5, b), (7, a + " end"), (8, b + " end"), (9, c), (9, c), (None, c + " end"), (None, "only here " * 9),
            (None, "only here " * 9), (3, ""), (3, ""), (None, None), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r["component_id"] for r in jaccard.link(frame).filter("doc_id in (7, 8)").collect()] == [5, 5]
    kept = sorted(((r["doc_id"], r["text"]) for r in jaccard.one_of_each(frame).collect()), key=str)
    assert kept == sorted([(5, a), (5, b), (9, c), (None, "only here " * 9), (3, ""), (None, None), (None, None)], key=str)


def test_chain_marginals_by_enumeration():
    chain = toxicity.Chain(np.array([-1.0, 0.3, 2.0, 1.0, 0.5, 0.4, -0.3]), np.array([[0.2, -1.0], [-0.5, 0.9]]))
    levels = [0, 0, 2, 0, 1, 0, 0, 3, 3, 0]
    f = toxicity.features(np.array(levels)) @ chain.emit
    weights = {}
    for path in itertools.product((0, 1), repeat=len(levels)):
        score = sum(f[i] * s for i, s in enumerate(path)) + sum(chain.trans[a, b] for a, b in zip(path, path[1:]))
        weights[path] = math.exp(score)
    total = sum(weights.values())
    found = [(i, x) for i, x in enumerate(levels) if x] + [(len(levels), 0)]
    for place, m in chain.marginals(found):
        assert m == pytest.approx(sum(w for p, w in weights.items() if p[place]) / total)


def test_quality_learns_from_every_passage(spark, monkeypatch):
    # one bad passage among 40 clean ones, at a place that 12 evenly spaced ones leave out
    good = ("the cat sat on a mat. it was well. " * 20)[: quality_model.PASSAGE]
    bad = ("BUY *** NOW!! $$$ " * 40)[: quality_model.PASSAGE]
    texts = [good * 40 if i % 2 else good * 5 + bad + good * 34 for i in range(160)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(160)], "doc_id long, quality int, toxic int")
    rows = quality_model.classify(docs(spark, texts), labels).filter("held_out").collect()
    assert all((r["score"] >= 0.5) == r["doc_id"] % 2 for r in rows)
    taken = []
    monkeypatch.setattr(quality_model.Model, "fit", lambda self, x, starts, y, w: taken.append((len(x), len(starts))))
    quality_model.fit(docs(spark, texts), labels)
    quality_model.fit(docs(spark, texts), labels, limit=2000)
    assert taken[0][0] == 40 * taken[0][1] and taken[1][0] == 40 * taken[1][1] and 20 <= taken[1][1] < taken[0][1]


def test_toxicity_fits_on_all_sampled_texts(spark, monkeypatch):
    # 300 long clean texts with more than 16,000 segments come before the toxic ones
    plain = "word " * 60
    texts = [("idiot " + plain) * 55] * 300 + ["idiot fool idiot fool " * 3] * 300
    labels = spark.createDataFrame([(i, 1, int(i >= 300)) for i in range(600)], "doc_id long, quality int, toxic int")
    taken, counts = [], []
    fit_, evidence_ = toxicity.Chain.fit, toxicity.evidence
    monkeypatch.setattr(toxicity.Chain, "fit", lambda self, x, y, w: (taken.append((len(x), y.any(1).sum())), fit_(self, x[-64:], y[-64:], w[-64:])))
    monkeypatch.setattr(toxicity, "evidence", lambda rows, a, b: (counts.append((a, b)), {"idiot": 2, "fool": 3})[1])
    toxicity.fit(docs(spark, texts), labels, per_class=1000)
    (n, toxic), (a, b) = taken[0], counts[0]
    assert n == 55 * b + a and toxic == a
    # shares are kept by hash: more of a class may be sampled than `per_class`
    short = docs(spark, ["fool" if i % 2 else "fine" for i in range(2000)])
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(2000)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(toxicity, "evidence", lambda rows, a, b: (counts.append((a, b, {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()})), evidence_(rows, a, b))[1])
    for per_class in (20, 50, 100):
        model = toxicity.fit(short, labels, per_class=per_class)
        a, b, real = counts[-1]
        assert (a, b) == (real[1], real[0]) and model.lexicon == {"fool": toxicity.LEVELS - 1}


def test_chain_fits_in_blocks(monkeypatch):
    draw = np.random.default_rng(8)
    levels = draw.integers(0, toxicity.LEVELS, (70, toxicity.SEGMENT)).astype(np.int8)
    whole, parts = toxicity.Chain(), toxicity.Chain()
    whole.fit(levels, levels >= 2, np.ones(70))
    monkeypatch.setattr(toxicity, "BLOCK", 16)
    parts.fit(levels, levels >= 2, np.ones(70))
    assert np.allclose(whole.emit, parts.emit, atol=1e-6) and np.allclose(whole.trans, parts.trans, atol=1e-6)


def test_models_on_little_or_odd_input(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    frame = docs(spark, AWKWARD)
    assert {r["score"] for r in quality_model.classify(frame, labels).collect()} == {0.5}
    assert {r["score"] for r in toxicity.classify(frame, labels).collect()} == {0.0}
    pred = {r["doc_id"]: r["lang_pred"] for r in language.identify(frame).collect()}
    assert pred[0] == pred[1] == pred[2] == "und" and pred[3] == "en"
    assert language.identify(frame.limit(0)).count() == 0


def test_classifiers_learn(spark):
    good, bad = "the cat sat on a mat. it was well. ", "BUY *** NOW!! $$$ "
    texts = [(good if i % 2 else bad) * (1 + i % 5) + ("idiot fool " if i % 3 == 0 else "") for i in range(240)]
    labels = spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(240)], "doc_id long, quality int, toxic int")
    rows = quality_model.classify(docs(spark, texts), labels).filter("held_out").collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in rows)
    rows = toxicity.classify(docs(spark, texts), labels).filter("held_out").collect()
    assert all(r["predicted"] == (r["doc_id"] % 3 == 0) for r in rows)
    assert all(r["text"][s["start"] : s["stop"]] in ("idiot fool", "idiot", "fool") for r in rows for s in r["spans"])
    mixed = docs(spark, ["der Hund und die Katze " * 3, "the dog and the cat " * 3] * 30).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "de").otherwise("en"))
    assert language.identify(mixed).filter("held_out and lang_pred <> lang").count() == 0


def test_signs_that_count_as_word_characters_are_no_letters(spark):
    texts = ["ein Haus und ein Hof " * 9, "a house and a yard " * 9] * 30
    rows = [(i, t, ["de", "en"][i % 2]) for i, t in enumerate(texts)] + [(100 + i, t, "en") for i, t in enumerate(["½ ²", "Ⅷ", "12 _", "", None])]
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [got[100 + i] for i in range(5)] == ["und"] * 5 and got[0] == "de" and got[1] == "en"


HARD = {"ruler": "example" + "-" * 100_000, "zeros": "0" * 5_000 + "1.1.1.1", "words": "price " * 20_000, "one": "a" * 100_000,
        "base64": "".join("aZ3+/9kQ"[i * 7919 % 8] for i in range(60_000)) + "dummy", "lines": "x\n" * 50_000}


def test_long_texts_without_structure_give_a_result(spark):
    found = {r["source"]: r["pii"] for r in pii.scan(docs(spark, list(HARD.values())).withColumn("source", F.get(F.array(*map(F.lit, HARD)), F.col("doc_id").cast("int")))).collect()}
    assert [(s["kind"], s["start"], s["stop"]) for s in found["zeros"] if s["kind"] == "ip"] == [("ip", 0, 5007)]
    masked = secrets.redact(docs(spark, list(HARD.values())).withColumn("secrets", F.lit("own"))).collect()
    assert {r["doc_id"]: r["text"] for r in masked}[0] == HARD["ruler"] and {r["secrets"] for r in masked} == {"own"}
    assert quality_rules.verdicts(docs(spark, list(HARD.values())), spark.createDataFrame([], "doc_id long, quality int")).count() == len(HARD)


def test_many_secrets_in_one_text(spark):
    text = " ".join(f"token=abc{i:05d}" for i in range(5000))
    row = secrets.redact(docs(spark, [text])).first()
    assert row["text"] == " ".join([secrets.MASK] * 5000)
    spans = secrets.scan(docs(spark, [text])).first()["secrets"]
    assert [(s["start"], s["stop"]) for s in spans] == [(15 * i, 15 * i + 14) for i in range(5000)]
