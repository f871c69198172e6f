"""Fill-in-middle: the cuts, the piece table and the way back."""

from __future__ import annotations

import hashlib
import random
import re

from tidings.llm import middle

TEXTS = [None, "", "a", "one two, three.\nfour", "é" * 50, "x<P>y", "<S", "<<M", "M>" * 9, "word " * 4000, "\U0001f600 a\x00b", "AbC1d\r\n  zZ", "KK[`{@"]


def plain(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or h[2] % 100 >= 90 or any(x in text for x in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_outputs_and_the_way_back(spark):
    rng = random.Random(4)
    rows = [(i, t) for i, t in enumerate(TEXTS * 4)] + [(None, "some words"), (-7, "ab cd"), (3, TEXTS[3]), (3, TEXTS[3])]
    rows += [(1000 + i, "".join(rng.choice("ab <S>PM.é") for _ in range(rng.randint(0, 40)))) for i in range(300)]
    docs = spark.createDataFrame([(*r, "f", 1) for r in rows], "doc_id long, text string, form string, n int")
    made = middle.restored_sha256(middle.transform(docs)).collect()
    assert len(made) == len(rows) and {r["form"] for r in made} == {"plain", "psm", "spm"}
    hashed = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    for r in made:
        want = plain(r["row"]["doc_id"], r["text"])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == want, r
        assert r["output_sha256"] == hashed(want[-1]) and r["restored_sha256"] == hashed(r["text"]) and r["row"]["form"] == "f"
    assert middle.transform(docs.limit(0)).count() == 0


def test_units_across_slices(monkeypatch):
    monkeypatch.setattr(middle, "SLICE", 5)
    for text in (t or "" for t in TEXTS):
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
        starts = [p for s in middle.unit_starts(text) for p in s.tolist()]
        assert len(starts) == len(units)
        for k in range(0, len(units) + 1, max(1, len(units) // 50)):
            assert middle.place_of(text, k) == len("".join(units[:k]))
        assert middle.plan(1, text)[2].sha256() == hashlib.sha256(plain(1, text)[-1].encode()).hexdigest()


def test_cutting_and_arranging():
    table = middle.PieceTable("abcdef").cut(2, 2, 5)
    assert [p[1:] for p in table.pieces] == [(0, 2), (2, 2), (2, 5), (5, 6)]
    turned = table.arranged([3, 4, 0, 1, 2], middle.MARKS)
    assert turned.text() == "f<P>abcde" and turned.arranged([2, 3, 4, 0]).cut(1, 4).text() == "abcdef"
    assert turned.buffers[0] is table.buffers[0]
