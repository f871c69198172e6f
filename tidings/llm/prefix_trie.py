"""Prefixes that conversations share, as ternary search trees over ranges of turn sequences.

A conversation is rebuilt from the first turns of its base (`rebuilt`) and becomes a sequence of
dictionary codes of its turns. Equal sequences are merged, then sequences are sorted and dealt by
range; each `SHARD` of them fills one tree, the median first, so that it is balanced. An iterative
traversal gathers members, leaves and savings of every prefix (node). Only prefixes of a shard's first and last
sequence can lie in other shards too; those boundary nodes are merged by key afterwards, and
what lies below them is added up along their paths.

A conversation is one row, so the turns of one conversation fit a task; conversations do not have to.
Member ids are hashed in blocks of `BLOCK` ids, in order, without holding all members of a node.

Defined results: rows without conv_id belong to no conversation and are left out; a null role or
text is empty; turns of one number are ordered by a hash of role and text; repeated rows are
repeated turns; without conversations there is no node; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm.common import remainder, stored, words

GROUP = 20  # conversations that share a base
HEADS = 4  # a conversation takes fewer turns than this from its base
BLOCK = 4096
SHARD = 50_000
NODE = (
    "key binary, parent binary, up array<binary>, depth long, first long, parent_first long, convs long, kids long, leaves long, "
    "saved long, words long, ends string, open boolean"
)
NOBODY = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, rn, code, words): each turn's number in its conversation, its code in a dictionary
    of all turns, and how many words it has."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn",
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.size(words(text, r"[\x20\x09-\x0D]+")).cast("long").alias("words"))
    numbered = said.withColumn("rn", F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")))
    codes = stored(said.select("digest").distinct().withColumn("code", F.monotonically_increasing_id()), "turn-codes")
    return numbered.join(codes, "digest").select("conv_id", "rn", "code", "words")


def rebuilt(numbered: DataFrame) -> DataFrame:
    """(conv_id, path): the first h turns of the base, then the own turns after the first h; `path`
    an array of (code, words)."""
    own = numbered.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("rn", "code", "words"))).alias("own"))
    heads = numbered.filter((F.col("conv_id") % GROUP == 0) & (F.col("rn") < HEADS)).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("rn", "code", "words"))).alias("heads"))
    h = remainder("conv_id", HEADS)
    joined = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP).withColumn("h", h).join(heads, "base", "left")
    taken = F.filter(F.coalesce("heads", F.array().cast("array<struct<rn:int,code:bigint,words:bigint>>")), lambda t: t["rn"] <= F.col("h"))
    path = F.concat(taken, F.filter("own", lambda t: t["rn"] > F.col("h")))
    return joined.select("conv_id", F.transform(path, lambda t: F.struct(t["code"].alias("code"), t["words"].alias("words"))).alias("path"))


class TernaryTree:
    """Nodes as parallel lists. `equal` leads to the tree of the next turn; node 0 is the root, the
    empty prefix, whose `equal` holds the first turns."""

    def __init__(self):
        self.code, self.less, self.equal, self.more = [None], [0], [0], [0]
        self.parent, self.depth, self.words = [-1], [0], [0]
        self.first, self.convs, self.ends = [None], [0], [None]

    def _new(self, code: int, words: int, parent: int) -> int:
        for column, value in ((self.code, code), (self.less, 0), (self.equal, 0), (self.more, 0), (self.parent, parent),
                              (self.depth, self.depth[parent] + 1), (self.words, words), (self.first, None), (self.convs, 0), (self.ends, None)):
            column.append(value)
        return len(self.code) - 1

    def _count(self, node: int, first: int, convs: int) -> None:
        self.convs[node] += convs
        self.first[node] = first if self.first[node] is None else min(self.first[node], first)

    def insert(self, codes: list[int], words: list[int], first: int, convs: int, ends: str) -> int:
        at = 0
        self._count(0, first, convs)
        for code, many in zip(codes, words):
            parent, links, owner = at, self.equal, at
            at = links[owner]
            while at and self.code[at] != code:
                links, owner = (self.less if code < self.code[at] else self.more), at
                at = links[owner]
            if not at:
                at = links[owner] = self._new(code, many, parent)
            self._count(at, first, convs)
        self.ends[at] = ends
        return at

    def walk(self) -> list[int]:
        """Every node after its parent."""
        out, todo = [], [0]
        while todo:
            at = todo.pop()
            out.append(at)
            todo += [x for x in (self.more[at], self.equal[at], self.less[at]) if x]
        return out


def median_order(n: int) -> Iterator[int]:
    todo = [(0, n)]
    while todo:
        low, high = todo.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            todo += [(middle + 1, high), (low, middle)]


def child_key(parent: bytes, code: int) -> bytes:
    return hashlib.blake2b(parent + code.to_bytes(8, "big", signed=True), digest_size=16).digest()


def shard_nodes(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of NODE for sorted, different sequences (codes, words, first, convs, ends)."""
    tree = TernaryTree()
    last = {k: tree.insert(*rows[k]) for k in median_order(len(rows))}
    n = len(tree.code)
    is_open = [False] * n
    for at in (last[0], last[len(rows) - 1]):
        while at >= 0 and not is_open[at]:
            is_open[at] = True
            at = tree.parent[at]
    order = tree.walk()
    key, up = [b""] * n, [None] * n
    up[0] = [b""]
    for at in order[1:]:
        key[at] = child_key(key[tree.parent[at]], tree.code[at])
        if is_open[at]:
            up[at] = [*up[tree.parent[at]], key[at]]
    kids, leaves, saved = [0] * n, [0] * n, [0] * n  # of open nodes: from closed ones below
    for at in reversed(order):
        if is_open[at]:
            continue
        leaves[at] += kids[at] == 0
        saved[at] += (tree.convs[at] - 1) * tree.words[at]
        above = tree.parent[at]
        kids[above] += 1
        leaves[above] += leaves[at]
        saved[above] += saved[at]
    parent = [None if p < 0 else key[p] for p in tree.parent]
    known = [None if p < 0 or is_open[p] else tree.first[p] for p in tree.parent]
    columns = [key, parent, up, tree.depth, tree.first, known, tree.convs, kids, leaves, saved, tree.words, tree.ends, is_open]
    types = [pa.binary(), pa.binary(), pa.list_(pa.binary()), *[pa.int64()] * 8, pa.string(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [f.split()[0] for f in NODE.split(", ")])


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Nodes of the trees of sorted rows (codes, words, first, convs, ids); rows of one sequence
    follow one another, their ids in order."""
    rows, digest = [], None

    def close() -> None:
        if digest is not None:
            rows[-1][4] = digest.hexdigest()

    for batch in batches:
        for codes, many, first, convs, ids in zip(*(batch[c].to_pylist() for c in ("codes", "words", "first", "convs", "ids"))):
            if rows and codes == rows[-1][0]:
                digest.update(f",{ids}".encode())
                rows[-1][2], rows[-1][3] = min(rows[-1][2], first), rows[-1][3] + convs
                continue
            close()
            if len(rows) == size:
                yield shard_nodes([tuple(r) for r in rows])
                rows = []
            rows.append([codes, many, first, convs, None])
            digest = hashlib.sha256(ids.encode())
    close()
    if rows:
        yield shard_nodes([tuple(r) for r in rows])


def trees(paths: DataFrame, shard: int = SHARD) -> DataFrame:
    """Rows of NODE from all shards, stored."""
    ids = F.sort_array(F.collect_list("conv_id"))
    blocks = stored(paths.groupBy("path", F.floor(F.col("conv_id") / BLOCK).alias("block")).agg(
        F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("convs"), F.array_join(ids, ",").alias("ids")), "paths")
    sorted_ = blocks.repartitionByRange("path").sortWithinPartitions("path", "block").select(
        F.transform("path", lambda t: t["code"]).alias("codes"), F.transform("path", lambda t: t["words"]).alias("words"), "first", "convs", "ids")
    return stored(sorted_.mapInArrow(partial(_shards, size=shard), NODE), "tree-nodes")


def merged(found: DataFrame) -> DataFrame:
    """The boundary nodes: each once, with what lies below it."""
    total = lambda c: F.sum(c).alias(c)
    once = found.filter("open").groupBy("key").agg(
        *[F.max(c).alias(c) for c in ("parent", "depth", "words", "ends")], F.min("first").alias("first"), F.max("up").alias("up"),
        *[total(c) for c in ("convs", "kids", "leaves", "saved")])
    once = stored(once, "boundary-nodes")
    more = once.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("open_kids"))
    full = once.join(more, "key", "left").withColumn("kids", F.col("kids") + F.coalesce("open_kids", F.lit(0)))
    own = full.select(
        F.explode("up").alias("key"), (F.col("leaves") + (F.col("kids") == 0).cast("long")).alias("leaves"),
        (F.col("saved") + (F.col("convs") - 1) * F.col("words")).alias("saved"))
    return stored(full.drop("leaves", "saved", "up", "open_kids", "words").join(own.groupBy("key").agg(total("leaves"), total("saved")), "key"), "merged-nodes")


def nodes(conversations: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per shared prefix: conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    paths = rebuilt(stored(turns(conversations), "turns"))
    found = trees(paths, shard)
    boundary = merged(found)
    columns = ["parent", "depth", "first", "convs", "kids", "leaves", "saved", "ends"]
    inside = found.filter("NOT open")
    known = inside.filter("parent_first IS NOT NULL").select(*columns, "parent_first")
    below = inside.filter("parent_first IS NULL").select(*columns).unionByName(boundary.select(*columns)).join(
        boundary.select(F.col("key").alias("parent"), F.col("first").alias("parent_first")), "parent", "left")
    return known.unionByName(below).select(
        F.col("first").alias("conv_id"), "depth", F.col("parent_first").alias("parent_conv_id"), F.col("convs").alias("n_convs"),
        F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NOBODY)).alias("ends_sha256"))
