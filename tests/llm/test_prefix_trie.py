"""Shared prefixes of conversations against a plain run over all prefixes."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tidings.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, code string, path string, first long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)


def plain(rows):
    tie = lambda r, t: hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).digest()
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0, tie(role, text)), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, said in own.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + said[h:])
    members = defaultdict(set)
    for c, said in built.items():
        for d in range(len(said) + 1):
            members[said[:d]].add(c)
    kids = defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    saved, leaves = defaultdict(int), defaultdict(int)
    for node, who in members.items():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(who) - 1) * n
            leaves[node[:d]] += kids[node] == 0
    return sorted((
        min(who), len(node), min(members[node[:-1]]) if node else -1, len(who), kids[node], leaves[node], saved[node],
        hashlib.sha256(",".join(str(c) for c in sorted(who) if len(built[c]) == len(node)).encode()).hexdigest())
        for node, who in members.items())


def conversations(seed, ids, kinds):
    rng = random.Random(seed)
    return [(c, rng.choice([t, t, None]), rng.choice(["user", None, "u"]), rng.choice(kinds))
            for c in ids for t in range(rng.randint(1, 6))]


@pytest.mark.parametrize("shard", [1, 3, 50_000])
def test_nodes_equal_a_plain_run(spark, shard):
    rows = conversations(5, [*range(45), -3, -21, 70, 5000, 9000], ["a b", "a b", None, "", "é\n\tc "])
    rows += [(61, 1, "user", "a b")] * 2 + [(None, 1, "user", "lost"), (62, 5, "x" * 3, "word " * 3000)]
    got = [tuple(-1 if v is None else v for v in r) for r in prefix_trie.nodes(frame(spark, rows), shard).collect()]
    assert sorted(got) == plain(rows)


def test_a_large_group_of_one_sequence(spark):
    rows = [(20 * c, t, "user", f"turn {t}") for c in range(9000) for t in range(2)]
    got = {r["depth"]: r for r in prefix_trie.nodes(frame(spark, rows)).collect()}
    ids = ",".join(str(20 * c) for c in range(9000))
    assert [got[d]["n_convs"] for d in (0, 1, 2)] == [9000] * 3 and got[0]["saved_tokens"] == 2 * 2 * 8999
    assert got[2]["ends_sha256"] == hashlib.sha256(ids.encode()).hexdigest()


def test_no_conversations(spark):
    assert prefix_trie.nodes(frame(spark, [(None, 1, "a", "b")])).collect() == []


def test_the_tree_is_balanced_and_whole():
    tree = prefix_trie.TernaryTree()
    for k in prefix_trie.median_order(1000):
        tree.insert([k], [1], k, 1, "e")
    depth = {tree.equal[0]: 1}
    for at in tree.walk()[1:]:
        for side in (tree.less[at], tree.more[at]):
            if side:
                depth[side] = depth[at] + 1
    assert len(tree.walk()) == 1001 and max(depth.values()) <= 10
