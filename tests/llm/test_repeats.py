"""Suffix arrays, and the removal of repeated bytes against a plain run over all strings."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tidings.llm import repeats
from tidings.llm.suffixes import permuted_lcp, suffix_array


def plain(rows):
    """(n_bytes, kept, spans) of each (id, text), by every string of 100 bytes."""
    bodies = {(i, t): (t or "").encode() for i, t in rows}
    first, out = {}, {}
    for (i, t), body in sorted(bodies.items(), key=lambda x: (x[0][0] is not None, x[0][0] or 0)):
        gone = bytearray(len(body))
        for at in range(len(body) - 99):
            if first.setdefault(body[at : at + 100], (i, t, at)) != (i, t, at):
                gone[at : at + 100] = b"\1" * 100
        spans, at = [], 0
        while at < len(body):
            stop = at
            while stop < len(body) and gone[stop] == gone[at]:
                stop += 1
            spans += [(at, stop)] if gone[at] else []
            at = stop
        out[i, t] = (len(body), bytes(b for b, g in zip(body, gone) if not g), spans)
    return out


def found(spark, rows, **how):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept string")
    return [((r["row"]["doc_id"], r["text"]), (len((r["text"] or "").encode()), bytes(r["kept"]), [tuple(s) for s in r["spans"]]))
            for r in repeats.repeats(docs, **how).collect()]


def texts(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passages = [prose(60) for _ in range(4)]
    line = "all rights are reserved by the people who wrote this line and who will not say where it ends"
    out = []
    for i in range(n):
        kind = i % 6
        body = prose(30) + " " + (rng.choice(passages) if kind < 4 else "") + " " + (line + rng.choice(["", " ", "!"])) * (kind == 5) + prose(20)
        if kind == 2:
            body = body[:150] + "X" + body[150:]
        out.append(body)
    return out


def test_suffix_arrays_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(400):
        data = bytes(rng.randrange(rng.choice([1, 2, 3, 250])) for _ in range(rng.randint(0, 60))) * rng.choice([1, 1, 3])
        text = np.frombuffer(data, np.uint8)
        array = suffix_array(text)
        assert array.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
        if len(data):
            shared = permuted_lcp(text, array, np.array([0]), 1000)
            for a, b in zip(array.tolist(), array.tolist()[1:]):
                same = 0
                while max(a, b) + same < len(data) and data[a + same] == data[b + same]:
                    same += 1
                assert shared[b] == same


def test_long_arrays_read_in_several_steps():
    rng = np.random.default_rng(3)
    data = np.concatenate([rng.integers(0, 4, 150_000), np.zeros(70_000), rng.integers(0, 200, 60_000)]).astype(np.uint8)
    data = np.concatenate([data, data[:90_000]])
    array = suffix_array(data)
    assert np.array_equal(np.sort(array), np.arange(len(data)))
    body = data.tobytes()
    at = rng.integers(0, len(data) - 1, 3_000)
    assert all(body[array[k] : array[k] + 100_000] <= body[array[k + 1] : array[k + 1] + 100_000] for k in at)


@pytest.mark.parametrize("gram", [32, 64, 88, 100])
def test_equal_windows_share_a_key_and_lie_apart(gram):
    rng = random.Random(gram)
    for _ in range(30):
        data = bytes(rng.choice(b"abcdefgh") for _ in range(rng.randint(100, 600)))
        data = rng.choice([data, data[:20] * 20, data[:1] * 300])
        start, width, key, _ = repeats.cut_segments(np.frombuffer(data, np.uint8), np.array([[0, len(data) - 99]]), gram)
        keyed = [(at, k) for a, w, k in zip(start.tolist(), width.tolist(), key.tolist()) for at in range(a, a + w)]
        assert [at for at, _ in keyed] == list(range(len(data) - 99))
        known = {}
        assert all(known.setdefault(data[at : at + 100], k) == k for at, k in keyed)
        for a, w in zip(start.tolist(), width.tolist()):
            assert len({data[at : at + 100] for at in range(a, a + w)}) == w


@pytest.mark.parametrize("how", [{}, {"crowd": 2, "chunk": 1500}, {"crowd": 1, "chunk": 300}])
def test_repeats_equal_a_plain_run(spark, how):
    bodies = texts(7, 60)
    rows = [*enumerate(bodies), (900, bodies[3]), (901, bodies[3] + bodies[8]), (-5, bodies[10]), (None, bodies[11]), (None, "short"),
            (902, None), (903, ""), (904, "-" * 2500), (905, "-" * 1000), (906, "the same words again " * 90), (1000, bodies[0][:99])]
    want = plain(rows)
    got = found(spark, [*rows, rows[3], rows[-3]], **how)  # two rows repeated
    assert len(got) == len(rows) + 2
    for key, value in got:
        assert value == want[key], key


def test_equal_ids_keep_one_copy(spark):
    body = texts(9, 1)[0]
    got = dict(found(spark, [(1, body), (1, body + "!")]))
    assert sorted(len(kept) for _, kept, _ in got.values())[0] < 99 and sum(spans != [] for _, _, spans in got.values()) == 1


def test_no_documents(spark):
    assert found(spark, []) == []


