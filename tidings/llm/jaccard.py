"""N-gram Jaccard join: links between documents whose sets of word shingles overlap enough, and
the components the links make.

Shingles are hashed, and the hash range is cut into groups. The counts of a set's shingles in 256
groups are its point. Two linked sets differ in few shingles, so for a number of groups above that
difference at least one group is the same in both (pigeonhole): documents meet where the content of
a group is equal. The number of groups depends on the size of the sets; sizes fall into bands and a
set takes part in its own band and the one below, which covers every pair that may link. Equal sets
are one node from the start.

Inside the places where nodes meet, pairs are tried in rounds: every node against the node it meets
most often, then against the other smallest nodes, then whatever still lies in different
components. For that, places with the same smallest node are taken together, as texts that share a
passage meet at many of them: a small tree of points (leaf pages with their upper corners, coarse and
fine coordinates) finds the pairs. Before sets are compared, the sum of the coordinate minima of two
points bounds their overlap. Pairs inside one component are never tried again, so large groups of near copies cost one
comparison a member and not one a pair; no link between different components is lost.

A plain tree of count points does not part large numbers of texts: random sets of one size lie as
close in most coordinates as near copies do. The groups' contents are therefore the first level and
the counts the second.

Defined results: null and empty texts have an empty set, link with nothing and are their own
component; a text of fewer words than a shingle is one shingle; documents without an id take part in
no component and get none; repeated rows give repeated rows. Rows of one id with different texts take
part with each text. `one_of_each` keeps one row of every group of near copies, rows without an id
among them; texts with an empty set stay, once for each id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidings.llm.common import stored

WORDS = 4
PERCENT = 85
POINT = 256  # coordinates
COARSE = 4  # of them in one coordinate of the first look
PAGE = 32  # points in a leaf
BLOCK = 4096  # nodes of one place in a task at once
SPREAD = 16  # tasks over which the rows of every place are dealt for a join
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BASE = np.uint64(0x5851F42D4C957F2D)  # odd


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# a random number for every byte value
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _word_hashes(data: bytes) -> np.ndarray:
    """Hashes of the words of lower-cased UTF-8 text: each word's bytes as a polynomial."""
    raw = np.frombuffer(data, np.uint8)
    inside = ~SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    first, last = edge[0::2], edge[1::2]
    if not len(first):
        return np.zeros(0, np.uint64)
    # place in the word, so that equal words have equal polynomials wherever they stand
    length = last - first
    bytes_ = raw[inside]
    begin = np.cumsum(length) - length
    place = np.arange(len(bytes_)) - np.repeat(begin, length)
    if length.max() >= len(POWER):
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(length.max()), BASE)]))
    else:
        power = POWER
    return mix(np.add.reduceat(BYTE[bytes_] * power[place], begin) ^ (length.astype(np.uint64) * BASE))


POWER = np.cumprod(np.concatenate([[np.uint64(1)], np.full(255, BASE)]))
ORDER = mix(np.arange(11, 11 + 64, dtype=np.uint64)) | np.uint64(1)


def shingles(data: bytes, words: int = WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    hashes = _word_hashes(data)
    n = len(hashes)
    if not n:
        return hashes
    size = min(words, n)
    total = np.zeros(n - size + 1, np.uint64)
    for i in range(size):
        total += hashes[i : n - size + 1 + i] * ORDER[i]
    return np.unique(mix(total + np.uint64(size)))


def text_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER)


def node(sh: np.ndarray) -> int:
    """One number for a set, the same for equal sets."""
    return int(mix(mix(sh).sum(keepdims=True) + np.uint64(len(sh)))[0].astype(np.int64))


class Bands:
    """Size bands and, for each, the number of groups that a pair of its sets needs."""

    def __init__(self, percent: int = PERCENT):
        self.percent, self.low = percent, [1]

    def start(self, band: int) -> int:
        while len(self.low) <= band:
            # the next band starts above the largest partner of this one's smallest set
            self.low.append(max(self.low[-1] + 1, -(-100 * self.low[-1] // self.percent)))
        return self.low[band]

    def of(self, n: int) -> int:
        band = 0
        while self.start(band + 1) <= n:
            band += 1
        return band

    def difference(self, band: int) -> int:
        """The most shingles in which a linked pair can differ, the smaller set in this band."""
        a, b = self.start(band + 1) - 1, self.start(band + 2) - 1
        b = min(b, 100 * a // self.percent)
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def groups(self, band: int) -> int:
        k = self.difference(band)
        return k + k // 7 + 8


def meetings(sh: np.ndarray, bands: Bands) -> np.ndarray:
    """Hashes of the places where a set can meet its partners."""
    out = []
    own = bands.of(len(sh))
    mixed = mix(sh ^ BASE)
    for band in {own, max(0, own - 1)}:
        groups = bands.groups(band)
        group = ((sh >> np.uint64(32)) * np.uint64(groups)) >> np.uint64(32)  # rises with the hash
        first = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1])
        content = np.add.reduceat(mixed, first)
        out.append(mix(content ^ mix(group[first] + np.uint64(band * 1_000_003 + 7))))
        if len(first) <= bands.difference(band):
            # so few groups are filled that two such sets may share empty ones only
            out.append(mix(np.array([band * 1_000_003 + 5], np.uint64)))
    return np.concatenate(out)


def groups_of(sh: np.ndarray) -> np.ndarray:
    """The group of every shingle among 65536, sorted: a point of that many coordinates, written as
    the list of its counts' places."""
    return (sh >> np.uint64(48)).astype(np.uint16)


def numbered(groups: np.ndarray) -> np.ndarray:
    """The groups with the how-manieth of its group each entry is: the sum of two points' minima is
    the number of entries they share."""
    return groups.astype(np.int64) << 32 | (np.arange(len(groups)) - np.searchsorted(groups, groups))


def point(groups: np.ndarray) -> np.ndarray:
    """The counts in `POINT` groups."""
    return np.bincount(groups >> 8, minlength=POINT).astype(np.int32)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def bounded(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether the coordinate minima of two points, as `numbered`, leave enough overlap to link."""
    return linked(a, b, percent)


class Tree:
    """Points in leaf pages, in order of size; a page knows its upper corner and smallest size."""

    def __init__(self, groups: list[np.ndarray]):
        self.full = [numbered(g) for g in groups]
        points = np.stack([point(g) for g in groups])
        self.size = points.sum(1)
        self.order = np.argsort(self.size, kind="stable")
        self.fine = points[self.order]
        self.size = self.size[self.order]
        self.coarse = self.fine.reshape(len(points), -1, COARSE).sum(2)
        self.first = np.arange(0, len(points), PAGE)
        self.corner = np.maximum.reduceat(self.coarse, self.first, axis=0)
        self.least = self.size[self.first]

    def near(self, groups: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
        """Places of the points whose coarse and fine bounds on the overlap with `groups` allow a
        link, and `groups` numbered, for the last bound."""
        query, full = point(groups), numbered(groups)
        coarse, n = query.reshape(-1, COARSE).sum(1), int(query.sum())
        most = np.minimum(self.corner, coarse).sum(1)
        pages = np.flatnonzero(100 * most >= percent * (n + self.least - most))
        if not len(pages):
            return pages, full
        at = (self.first[pages][:, None] + np.arange(PAGE)).ravel()
        at = at[at < len(self.order)]
        for points, q in ((self.coarse, coarse), (self.fine, query)):
            most = np.minimum(points[at], q).sum(1)
            at = at[100 * most >= percent * (n + self.size[at] - most)]
        return self.order[at], full


class Forest:
    """Which nodes the pairs of one group have joined so far."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def top(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)


# --- Spark ------------------------------------------------------------------------------------

def nodes(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, node, hash); node is null for an empty set, hash is that of the text."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("hash", pa.int64())])

    def rows(batches):
        for batch in batches:
            sizes, keys = [], []
            for text in batch.column(1):
                sh = shingles(text_bytes(text.as_py()), words)
                sizes.append(len(sh))
                keys.append(node(sh) if len(sh) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), batch.column(2)], schema=schema)

    read = documents.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text"))
    return read.mapInArrow(rows, "doc_id long, n_shingles long, node long, hash long")


def places(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(place, node, near): where the sets meet. Of the nodes of one batch that meet at a place only
    the smallest stands for it; the others say in `near` which one that is, so that a hot place
    gets one row from each batch."""
    schema = pa.schema([("place", pa.int64()), ("node", pa.int64()), ("near", pa.int64())])

    def pack(found, keys):
        place = np.concatenate(found)
        key = np.repeat(np.array(keys, np.int64), [len(f) for f in found])
        order = np.lexsort((key, place))
        place, key = place[order], key[order]
        again = np.concatenate([[False], place[1:] == place[:-1]])
        same = again & np.concatenate([[False], key[1:] == key[:-1]])
        head = np.maximum.accumulate(np.where(again, 0, np.arange(len(place))))
        keep = ~same
        near = pa.array(key[head][keep], mask=~again[keep])
        return pa.RecordBatch.from_arrays([pa.array(place[keep].astype(np.int64)), pa.array(key[keep]), near], schema=schema)

    def rows(batches):
        bands, found, keys, size = Bands(percent), [], [], 0
        for batch in batches:
            for text in batch.column(0):
                sh = shingles(text_bytes(text.as_py()), words)
                if not len(sh):
                    continue
                found.append(meetings(sh, bands))
                keys.append(node(sh))
                size += len(found[-1])
                if size > 1_000_000:
                    yield pack(found, keys)
                    found, keys, size = [], [], 0
        if found:
            yield pack(found, keys)

    return documents.select("text").mapInArrow(rows, "place long, node long, near long")


def met(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(place, node, near) for places where two nodes or more meet; `near` is the smallest of them
    (of those in the batch, for a node that another stood for)."""
    spread = F.when(F.col("near").isNotNull(), F.col("node")).otherwise(0)
    at = W.partitionBy("place", "spread")
    ranked = places(documents, words, percent).withColumn("spread", spread).withColumns({
        "least": F.min("node").over(at), "most": F.max("node").over(at),
    })
    return ranked.filter(F.col("near").isNotNull() | (F.col("least") < F.col("most"))).select(
        "place", "node", F.coalesce("near", "least").alias("near"))


def sets(documents: DataFrame, wanted: DataFrame, words: int = WORDS) -> DataFrame:
    """(node, set, point) of the wanted nodes, each from the text of id and hash `rep`."""
    schema = pa.schema([("node", pa.int64()), ("set", pa.binary()), ("point", pa.binary())])

    def rows(batches):
        for batch in batches:
            read = [(n, shingles(text_bytes(t.as_py()), words)) for n, t in zip(batch.column(0).to_pylist(), batch.column(1))]
            # the node of what was read counts
            read = [(n, s) for n, s in read if len(s) and node(s) == n]
            out = [s for _, s in read]
            yield pa.RecordBatch.from_arrays([
                pa.array([n for n, _ in read], pa.int64()), pa.array([s.tobytes() for s in out], pa.binary()),
                pa.array([groups_of(s).tobytes() for s in out], pa.binary()),
            ], schema=schema)

    # repeated ids may carry other texts
    same = F.col("doc_id").eqNullSafe(F.col("rep.doc_id")) & (F.col("hash") == F.col("rep.hash"))
    texts = documents.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("hash")).join(wanted, same)
    read = texts.select("node", "text").mapInArrow(rows, "node long, set binary, point binary")
    return read.dropDuplicates(["node"])


def verify(pairs: DataFrame, content: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The (a, b) of `pairs` that link: points first, then sets."""
    @F.pandas_udf("boolean")
    def may(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([bounded(numbered(np.frombuffer(x, np.uint16)), numbered(np.frombuffer(y, np.uint16)), percent) for x, y in zip(a, b)], dtype=bool)

    @F.pandas_udf("boolean")
    def do(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(a, b)], dtype=bool)

    def with_both(frame, column):
        left = content.select(F.col("node").alias("a"), F.col(column).alias("x"))
        right = content.select(F.col("node").alias("b"), F.col(column).alias("y"))
        return frame.join(left, "a").join(right, "b")

    close = stored(with_both(pairs, "point").filter(may("x", "y")).select("a", "b"), "close")
    return stored(with_both(close, "set").filter(do("x", "y")).select("a", "b"), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each component, for the nodes that have links. Large-star
    and small-star steps; every step is written, none depends on an executor."""
    def stars(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))) if large else edges.select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = both.join(least, "a")
        if large:
            return joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()

    def mark(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = stored(links.filter("a <> b").select("a", "b").distinct(), "edges")
    seen = None
    while True:
        edges = stored(stars(stars(edges, True), False), "edges")
        now = mark(edges)
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
        seen = now


def near_pairs(mixed: DataFrame, content: DataFrame, forest: bool, percent: int = PERCENT) -> DataFrame:
    """(place, a, b): pairs of nodes of one place that have different labels and may link by their
    points. `mixed` has place, node, label and n, the nodes of the place.

    A place with more than `BLOCK` nodes is cut into blocks, and every two blocks are one group, so
    a task holds two blocks at most; only pairs that pass the bound leave it. With `forest` a group
    gives only pairs that join what its earlier pairs have not joined: nearly all of them link, so
    this settles large families; only where one fails can something have been held back that links,
    and a pass over such places without it finds that."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = mixed.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).select(
        "place", "node", "label", "block", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    dealt = own.join(content.select("node", "point"), "node").select(
        "place", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "label", "point")
    schema = pa.schema([("place", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])

    def batch_of(found):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], schema=schema)

    def compare(place, i, j, rows):
        """Pairs of one group; `rows` are (block, node, label, point)."""
        if i == j:
            left = right = rows
        else:
            left, right = [r for r in rows if r[0] == i], [r for r in rows if r[0] == j]
        if not left or not right:
            return
        tree, joined = Tree([np.frombuffer(r[3], np.uint16) for r in right]), Forest()
        nodes_, labels_ = np.array([r[1] for r in right]), np.array([r[2] for r in right])
        for _, node_, label, where in left:
            at, full = tree.near(np.frombuffer(where, np.uint16), percent)
            at = at[(labels_[at] != label) & ((nodes_[at] > node_) if i == j else True)]
            for at_, b, other in zip(at.tolist(), nodes_[at].tolist(), labels_[at].tolist()):
                if forest and joined.top(label) == joined.top(other):
                    continue
                if bounded(tree.full[at_], full, percent):
                    joined.join(label, other)
                    yield place, min(node_, b), max(node_, b)

    def rows(batches):
        key, held, out = None, [], []
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
            for place, i, j, *row in zip(*columns):
                if (place, i, j) != key:
                    if len(held) > 1:
                        out.extend(compare(*key, held))
                    key, held = (place, i, j), []
                    if len(out) > 20_000:
                        yield batch_of(out)
                        out = []
                held.append(row)
        if len(held) > 1:
            out.extend(compare(*key, held))
        if out:
            yield batch_of(out)

    grouped = dealt.repartition("place", "i", "j").sortWithinPartitions("place", "i", "j")
    return grouped.mapInArrow(rows, "place long, a long, b long")


def at_hubs(rows: DataFrame, few: DataFrame, key: str) -> DataFrame:
    """`rows` (with a node) joined with `few`, one row a key. A key's rows are dealt over `SPREAD`
    tasks by node, to which its row of `few` is copied."""
    dealt = rows.withColumn("part", F.pmod("node", F.lit(SPREAD)))
    return dealt.join(few.withColumn("part", F.expr(f"explode(sequence(0L, {SPREAD - 1}L))")), [key, "part"]).drop("part")


def mixed_places(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(place, node, label, n): the places where different components meet, those with the same
    smallest node as one, which is then their name. At a place of two nodes that pair is the one
    with the smallest node, which has been tried."""
    tagged = members.join(labels, "node", "left").select("place", "node", F.coalesce("label", "node").alias("label"))
    met_ = tagged.groupBy("place").agg(
        F.min("label").alias("least"), F.max("label").alias("most"), F.min("node").alias("hub"), F.count("*").alias("n"))
    hubs = met_.filter("least <> most AND n > 2").select("place", "hub")
    joined = stored(at_hubs(tagged, hubs, "place").select(F.col("hub").alias("place"), "node", "label").distinct(), "hubs")
    return at_hubs(joined, joined.groupBy("place").agg(F.count("*").alias("n")), "place")


def _labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components."""
    a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    joined = pairs.join(a, "a", "left").join(b, "b", "left")
    return joined.filter(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b")


def labelled(documents: DataFrame, words: int = WORDS, percent: int = PERCENT, unnamed: bool = False) -> DataFrame:
    """A row per document with doc_id, n_shingles, hash and the component's label (null for an empty
    set), its smallest id `least` and its first (unnamed, doc_id, hash). Texts that only documents
    without an id have link if `unnamed`."""
    rows = stored(nodes(documents, words), "nodes")
    meeting = stored(met(documents, words, percent), "meeting")
    # an id comes before none
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "hash")
    reps = rows.filter("node is not null").groupBy("node").agg(F.min(place).alias("rep"))
    reps = reps if unnamed else reps.filter("NOT rep.unnamed")
    wanted = meeting.select("node").union(meeting.select("near")).distinct()
    content = stored(sets(documents, reps.join(wanted, "node", "left_semi"), words), "sets")
    shared = meeting.filter("node <> near").groupBy("node", "near").agg(F.count("*").alias("n"))
    shared = stored(shared.select(F.col("node").alias("b"), F.col("near").alias("a"), "n"), "shared")
    # the node met most often first
    best = shared.groupBy("b").agg(F.max_by("a", F.struct("n", "a")).alias("a"))
    links = verify(best.select("a", "b"), content, percent)
    labels = components(links)
    more = verify(_labelled(shared.select("a", "b"), labels), content, percent)
    links = links.unionByName(more)
    labels = components(links)
    # what meets at one place and still lies in different components
    members = meeting.select("place", "node").union(meeting.select("place", F.col("near"))).distinct()
    rest = stored(mixed_places(members, labels), "mixed")
    tried = stored(near_pairs(rest, content, True, percent), "tried")
    found = verify(tried.select("a", "b").distinct(), content, percent)
    failed = stored(tried.join(found, ["a", "b"], "left_anti").select("place").distinct(), "failed")
    links = links.unionByName(found)
    labels = components(links)
    again = rest.drop("label").join(failed, "place", "left_semi").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    links = links.unionByName(verify(near_pairs(again, content, False, percent).select("a", "b").distinct(), content, percent))
    labels = components(links)
    named = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = named.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"), F.min(place).alias("first"))
    # rows without a label match nothing and are dealt by their id; one with a label's value is told by `label`
    keyed = named.withColumn("key", F.coalesce("label", F.xxhash64("doc_id", "hash")))
    return keyed.join(smallest.withColumnRenamed("label", "key"), "key", "left").drop("key")


def link(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id): component_id is the smallest id that links reach."""
    return labelled(documents, words, percent).select(
        "doc_id", "n_shingles", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.when(F.col("doc_id").isNotNull(), F.col("least"))).alias("component_id"))


def one_of_each(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of every component, that of the smallest id, and one of repeated rows."""
    rows = labelled(documents, words, percent, unnamed=True)
    here = rows.select(
        F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"),
        F.when(F.col("label").isNull(), True).otherwise(
            F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.hash") == F.col("hash"))).alias("_first"),
        F.col("label").isNull().alias("_empty"),
    )
    marks = here.groupBy("_id", "_hash").agg(F.bool_and("_first").alias("_first"), F.bool_and("_empty").alias("_empty"), F.count("*").alias("_n"))
    # nothing says that empty texts without an id are the same document
    repeated = (F.col("_n") > 1) & ~(F.col("_empty") & F.col("_id").isNull())
    marks = stored(marks.filter(~F.col("_first") | repeated).select("_id", "_hash", "_first"), "marks")
    # the input's columns inside one, where their names meet none of these
    whole = documents.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64("row.text") == F.col("_hash"))
    if marks.filter("_first").isEmpty():
        return whole.join(marks, same, "left_anti").select("row.*")
    joined = whole.join(marks, same, "left")
    at = W.partitionBy("_id", "_hash").orderBy(F.xxhash64("row"))
    one = joined.filter("_first").withColumn("_row", F.row_number().over(at)).filter("_row = 1")
    return joined.filter("_first is null").select("row.*").unionByName(one.select("row.*"))
