"""Removal of byte strings that occur earlier, by suffix arrays over shards.

A string of `LENGTH` bytes goes where it also starts earlier: in a text of smaller id, or earlier in
the same one. Whatever equals it must meet it in one shard, so every such string (a window) is
keyed by content: the smallest hash among its pieces of `GRAM` bytes. Neighbouring windows that
share the piece form a segment.

1. `segments`: keys and segments of all texts, in chunks. Of equal segments in a chunk the first
   goes on, the others are removed there and then.
2. A key that only one segment of all chunks has is of no interest. Per chunk one segment of a key
   is counted, so a key that a third of all texts have sends one row per chunk.
3. Of equal segments the first one, the owner, fetches its bytes; windows of the copies are removed.
4. `verdicts`: the owners' bytes, grouped by key into shards, are sorted by induced sorting; permuted common
   prefixes of `LENGTH` or more join equal windows, and of these the earliest stays.
5. A key with more than `CROWD` different owners (a common line in ever different surroundings)
   would crowd one shard; it is cut anew with longer pieces, at last of `LENGTH` bytes, where
   all segments of a key are equal.
6. The removed windows of a text are merged and cut out of its bytes.

Texts are ordered by id, then a hash of the text; a null id comes first. A row repeated with one id
and text is the same document: each gets the same result. A null or short text keeps all bytes.
Very long texts are cut into chunks that overlap by `LENGTH` - 1. Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.llm.common import stored
from tidings.llm.suffixes import permuted_lcp, suffix_array

LENGTH = 100
GRAM = 32
LONGER = (64, 88, LENGTH)
CROWD = 1000  # owners of a key that share a shard
CHUNK = 4 << 20  # bytes keyed together, and bytes of a shard
BLOCK = 1 << 16
BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xBF58476D1CE4E5B9)
BYTES = np.random.default_rng(100).integers(0, 1 << 64, 256, dtype=np.uint64)
TIE = 40  # `at` holds the tie-breaking hash above so many bits of the place
NO_ID = -(1 << 63)

SEGMENT = "key long, salt int, seal long, id long, at long, width int, gone boolean, sure boolean"
PIECE = "key long, seal long, id long, at long, width int, body binary"
CUT = "id long, at long, width int"


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of each `gram` bytes, put together from pieces whose lengths are powers of two."""
    total = len(data) - gram + 1
    power, width, made, have = BASE, 1, None, 0
    level = BYTES[data]
    while True:
        if gram & width:
            made = level[:total] if made is None else made * np.uint64(power) + level[have : have + total]
            have += width
        if width * 2 > gram:
            return made
        level = level[:-width] * np.uint64(power) + level[width:]
        power, width = power * power % (1 << 64), width * 2


def mixed(hashes: np.ndarray) -> np.ndarray:
    out = (hashes ^ (hashes >> np.uint64(29))) * MIX
    return out ^ (out >> np.uint64(32))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (width - have)], values[width - have :])


def cut_segments(data: np.ndarray, valid: np.ndarray, gram: int) -> tuple[np.ndarray, ...]:
    """(start, windows, key, hash of the bytes) of the segments of `data`: runs of windows that share the
    first of their smallest pieces, so equal windows never lie in one segment. `valid`: bounds
    (first, end) of stretches of window starts, rising and apart."""
    keys, grams = np.zeros(len(data), np.uint64), np.zeros(len(data), np.uint64)
    edge = np.zeros(len(data) + 1, bool)  # a segment may begin or a stretch end here
    for at in range(0, max(len(data) - LENGTH + 1, 0), BLOCK):
        raw = gram_hashes(data[at : at + BLOCK + LENGTH - 1], gram)
        rank = mixed(raw)
        least = sliding_min(rank, LENGTH - gram + 1)
        keys[at : at + len(least)] = least
        edge[at + 1 : at + 1 + len(least)] = least == rank[: len(least)]
        grams[at : at + len(raw)] = raw
    edge[1:-1] |= keys[1:] != keys[:-1]
    edge[valid] = True
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, valid[:, 0], 1)
    np.subtract.at(inside, valid[:, 1], 1)
    inside = np.cumsum(inside).astype(bool)
    edges = np.flatnonzero(edge)
    start, end = edges[:-1], edges[1:]
    start, end = start[inside[start]], end[inside[start]]
    width = end - start
    seal = mixed(width.astype(np.uint64))
    last = start + width + LENGTH - 1 - gram
    for step in range(0, 2 * LENGTH - gram, gram):
        seal = mixed(seal * np.uint64(BASE) + grams[np.minimum(start + step, last)])
    return start, width, keys[start].view(np.int64), seal.view(np.int64)


def _columns(schema: str, *arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a) for a in arrays], [f.split()[0] for f in schema.split(", ")])


def _chunk_segments(pieces: list[tuple[int, int, bytes]]) -> pa.RecordBatch | None:
    """Rows of SEGMENT for pieces (id, at, bytes) of texts."""
    pieces = [p for i, p in enumerate(sorted(pieces)) if len(p[2]) >= LENGTH]
    pieces = [p for before, p in zip([None, *pieces], pieces) if before is None or before[:2] != p[:2]]  # repeated rows
    if not pieces:
        return None
    ends = np.cumsum([len(p[2]) for p in pieces])
    begins = ends - [len(p[2]) for p in pieces]
    data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    start, width, key, seal = cut_segments(data, np.stack([begins, ends - LENGTH + 1], 1), GRAM)
    ids, at = np.array([p[0] for p in pieces]), np.array([p[1] for p in pieces])
    order = np.lexsort((seal, key))
    start, width, key, seal = (x[order] for x in (start, width, key, seal))
    new_key = np.append(True, key[1:] != key[:-1])
    gone = ~(new_key | np.append(True, seal[1:] != seal[:-1]))
    many = np.add.reduceat((~gone).astype(int), np.flatnonzero(new_key))
    sure = np.repeat(many > 1, np.diff(np.append(np.flatnonzero(new_key), len(key))))
    salt = np.where(new_key, 0, 1 + (seal & 1023)).astype(np.int32)
    left, width_left = np.sort(start[gone]), width[gone][np.argsort(start[gone])]
    new = np.flatnonzero(np.append(True, left[1:] != left[:-1] + width_left[:-1])[: len(left)])  # runs of removed segments
    width_left = np.add.reduceat(width_left, new) if len(new) else width_left
    stay, more, none = ~gone, len(new), np.zeros(len(new), np.int64)
    start = np.concatenate([start[stay], left[new]])
    piece = np.searchsorted(begins, start, side="right") - 1
    return _columns(
        SEGMENT, np.append(key[stay], none), np.append(salt[stay], none.astype(np.int32)), np.append(seal[stay], none), ids[piece],
        at[piece] + start - begins[piece], np.append(width[stay], width_left).astype(np.int32),
        np.arange(len(start)) >= len(start) - more, np.append(sure[stay], none > 0))


def _segments(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    pieces, size = [], 0
    for batch in batches:
        for id_, tie, text in zip(batch["id"].to_pylist(), batch["tie"].to_pylist(), batch["text"].cast(pa.binary())):
            body = text.as_py() or b""
            for at in range(0, max(len(body) - LENGTH + 1, 0), chunk):
                piece = body[at : at + chunk + LENGTH - 1]
                pieces.append((id_, (tie << TIE) + at, piece))
                size += len(piece)
                if size >= chunk:
                    yield from filter(None, [_chunk_segments(pieces)])
                    pieces, size = [], 0
    yield from filter(None, [_chunk_segments(pieces)])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text as compressed bytes, with their number before."""
    for batch in batches:
        texts = [t.as_py() for t in batch["text"].cast(pa.binary())]
        packed = [None if t is None else pa.compress(t, codec="zstd", asbytes=True) for t in texts]
        rest = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [*[batch[c] for c in rest], pa.array([None if t is None else len(t) for t in texts], pa.int64()), pa.array(packed, pa.binary())],
            [*rest, "size", "body"])


def _unpacked(batch: pa.RecordBatch, row: int) -> bytes | None:
    size = batch["size"][row].as_py()
    return None if size is None else pa.decompress(batch["body"][row].as_py(), size, codec="zstd", asbytes=True)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of PIECE: the bytes of the segments wanted of each text."""
    before = None
    for batch in batches:
        for row in range(batch.num_rows):
            whose = (batch["id"][row], batch["tie"][row])
            if whose == before:
                continue  # a repeated row
            before = whose
            body, wanted = _unpacked(batch, row) or b"", batch["wanted"][row].values
            at = wanted.field("at").to_numpy()
            width = wanted.field("width").to_numpy()
            start = at & ((1 << TIE) - 1)
            cut = [body[a : a + w + LENGTH - 1] for a, w in zip(start.tolist(), width.tolist())]
            yield _columns(
                f"{PIECE}, crowd", wanted.field("key"), wanted.field("seal"), pa.repeat(batch["id"][row], len(at)), at, width,
                pa.array(cut, pa.binary()), wanted.field("crowd"))


def _recut(batches: Iterator[pa.RecordBatch], gram: int) -> Iterator[pa.RecordBatch]:
    """Segments cut anew by longer pieces."""
    for batch in batches:
        bodies = [b.as_py() for b in batch["body"]]
        if not bodies:
            continue
        ends = np.cumsum([len(b) for b in bodies])
        begins = ends - [len(b) for b in bodies]
        whole = b"".join(bodies)
        start, width, key, seal = cut_segments(np.frombuffer(whole, np.uint8), np.stack([begins, ends - LENGTH + 1], 1), gram)
        of = np.searchsorted(begins, start, side="right") - 1
        cut = [whole[a : a + w + LENGTH - 1] for a, w in zip(start.tolist(), width.tolist())]
        yield _columns(PIECE, key, seal, batch["id"].to_numpy()[of], batch["at"].to_numpy()[of] + start - begins[of], width.astype(np.int32), pa.array(cut, pa.binary()))


def later_windows(bodies: list[bytes], ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(segment, offset, windows): runs of windows that start earlier in another place of these
    segments, by the suffix array of all of them."""
    sizes = np.array([len(b) for b in bodies])
    begins = np.cumsum(sizes + 1) - sizes - 1
    text = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8)
    array = suffix_array(text)
    common = permuted_lcp(text, array, begins, 4 * LENGTH)
    segment = np.repeat(np.arange(len(sizes)), sizes + 1)[array]
    offset = array - begins[segment]
    whole = offset <= sizes[segment] - LENGTH  # starts of windows
    kind = np.cumsum(common[array] < LENGTH)[whole]
    by_place = np.lexsort((at, ids))
    rank = np.empty(len(sizes), np.int64)
    rank[by_place] = np.arange(len(sizes))
    place = rank[segment[whole]] * (2 * LENGTH) + offset[whole]
    first = np.flatnonzero(np.append(True, kind[1:] != kind[:-1]))
    least = np.minimum.reduceat(place, first)
    later = np.sort(place[place != np.repeat(least, np.diff(np.append(first, len(place))))])
    segment, offset = by_place[later // (2 * LENGTH)], later % (2 * LENGTH)
    fresh = np.flatnonzero(np.append(True, (segment[1:] != segment[:-1]) | (offset[1:] != offset[:-1] + 1))[: len(segment)])
    return segment[fresh], offset[fresh], np.diff(np.append(fresh, len(segment)))


def _verdicts(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """Rows of CUT for segments sorted by key and seal, a shard at a time."""
    def shard(rows):
        ids, at = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
        segment, offset, width = later_windows([r[4] for r in rows], ids, at)
        return _columns(CUT, ids[segment], at[segment] + offset, width.astype(np.int32))

    rows, size = [], 0
    for batch in batches:
        for row in zip(*(batch[c].to_pylist() for c in ("key", "seal", "id", "at", "body"))):
            if rows and row[:2] == rows[-1][:2]:
                continue  # fetched from a repeated row
            if size >= chunk and row[0] != rows[-1][0]:
                yield shard(rows)
                rows, size = [], 0
            rows.append(row)
            size += len(row[4])
    if rows:
        yield shard(rows)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, kept, spans = [], [], []
        for row in range(batch.num_rows):
            body = _unpacked(batch, row)
            cuts = batch["cuts"][row].as_py() or []
            runs: list[list[int]] = []
            for start, stop in sorted(((c["at"] & ((1 << TIE) - 1)), (c["at"] & ((1 << TIE) - 1)) + c["width"] + LENGTH - 1) for c in cuts):
                if runs and start <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], stop)
                else:
                    runs.append([start, stop])
            texts.append(body)
            bounds = [0, *[x for run in runs for x in run], len(body or b"")]
            kept.append(b"".join((body or b"")[a:b] for a, b in zip(bounds[::2], bounds[1::2])))
            spans.append([{"start": a, "stop": b} for a, b in runs])
        yield pa.RecordBatch.from_arrays(
            [batch["row"], pa.array(texts, pa.binary()).cast(pa.string()), pa.array(kept, pa.binary()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))],
            ["row", "text", "kept", "spans"])


def _owners(segments: DataFrame) -> DataFrame:
    """`segments` of which the first of a key and seal is the `owner`, stored. Rows at the same
    place as the owner, from repeated documents, are left out."""
    alike = Window.partitionBy("key", "seal", "aside").orderBy("id", "at")
    ranked = segments.withColumn("owner", ~F.col("gone") & (F.row_number().over(alike) == 1)).withColumns(
        {"first_id": F.first("id").over(alike), "first_at": F.first("at").over(alike)})
    copy = "gone OR owner OR id <> first_id OR at <> first_at"
    return stored(ranked.filter(copy).drop("gone", "aside", "first_id", "first_at"), "repeats")


def _parted(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first of each key and seal, and the windows of the others. A crowd's pieces can be one and
    the same, so the first is found with partial results, and the join is one of plain tables."""
    pieces = stored(pieces, "pieces")
    first = F.min(F.struct("id", "at", "width", "body")).alias("first")
    firsts = stored(pieces.groupBy("key", "seal").agg(first).select("key", "seal", "first.*"), "firsts")
    where = firsts.select("key", "seal", F.col("id").alias("first_id"), F.col("at").alias("first_at"))
    copies = pieces.drop("body").join(where, ["key", "seal"]).filter("id <> first_id OR at <> first_at")
    return firsts, copies.select("id", "at", "width")


def _crowds(owners: DataFrame) -> DataFrame:
    """Owners of keys with several, with `crowd`, their number. The numbers are stored: a join of two
    plain shuffles is split where a key is crowded."""
    crowds = owners.groupBy("key").agg(F.count(F.lit(1)).alias("crowd")).filter("crowd > 1")
    return owners.join(stored(crowds, "crowds"), "key")


def _settled(pieces: DataFrame, crowded: bool, grams: tuple[int, ...], crowd: int, chunk: int) -> list[DataFrame]:
    """Frames of CUT for `pieces`, the owners of keys with several. If some are `crowded`, those are
    cut anew with the first of `grams`."""
    calm = pieces.filter(F.col("crowd") <= crowd) if crowded else pieces
    shards = calm.drop("crowd").repartition("key").sortWithinPartitions("key", "seal")
    cuts = [shards.mapInArrow(partial(_verdicts, chunk=chunk), CUT)]
    if not crowded:
        return cuts
    anew = pieces.filter(F.col("crowd") > crowd).mapInArrow(partial(_recut, gram=grams[0]), PIECE)
    firsts, copies = _parted(anew)
    owners = _crowds(firsts)
    still = len(grams) > 1 and not owners.filter(F.col("crowd") > crowd).isEmpty()
    return [*cuts, copies, *_settled(owners, still, grams[1:], crowd, chunk)]


def repeats(documents: DataFrame, crowd: int = CROWD, chunk: int = CHUNK) -> DataFrame:
    """`row` (the columns of `documents` but text), `text`, `kept` (the bytes left) and `spans`
    (start, stop: the runs of bytes removed). `doc_id` is an integer."""
    bits = 62 - TIE
    tie = F.shiftright(F.xxhash64(F.coalesce("text", F.lit(""))), 64 - bits).bitwiseAND(F.lit((1 << bits) - 1))
    docs = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), tie.alias("tie"),
        F.struct(*[c for c in documents.columns if c != "text"]).alias("row"), F.col("text"))
    names = ["id", "tie", "row"]
    packed = docs.mapInArrow(_pack, T.StructType([*[docs.schema[c] for c in names], *T.StructType.fromDDL("size long, body binary")]))

    found = docs.select("id", "tie", "text").mapInArrow(partial(_segments, chunk=chunk), SEGMENT)
    aside = F.when(F.col("gone"), 1 + F.pmod("at", F.lit(4093))).otherwise(0)  # spreads what has no key
    several = F.count(F.lit(1)).over(Window.partitionBy("key", "salt", "aside")) > 1
    met = found.withColumn("aside", aside).withColumn("several", several).filter("gone OR sure OR (salt = 0 AND several)")
    settled = _owners(met.drop("salt", "sure", "several"))

    owners = stored(_crowds(settled.filter("owner").drop("owner")), "owners")
    wanted = owners.groupBy("id", F.shiftright("at", TIE).alias("tie")).agg(
        F.collect_list(F.struct("key", "seal", "at", "width", "crowd")).alias("wanted"))
    pieces = packed.drop("row").join(wanted, ["id", "tie"]).mapInArrow(_fetch, f"{PIECE}, crowd long")
    crowded = not owners.filter(F.col("crowd") > crowd).isEmpty()
    cuts = _settled(stored(pieces, "pieces") if crowded else pieces, crowded, LONGER, crowd, chunk)

    all_cuts = settled.filter("NOT owner").select("id", "at", "width")
    for more in cuts:
        all_cuts = all_cuts.unionByName(more)
    by_text = all_cuts.groupBy("id", F.shiftright("at", TIE).alias("tie")).agg(F.collect_list(F.struct("at", "width")).alias("cuts"))
    out = T.StructType([docs.schema["row"], *T.StructType.fromDDL("text string, kept binary, spans array<struct<start:long,stop:long>>")])
    return packed.join(by_text, ["id", "tie"], "left").select("row", "size", "body", "cuts").mapInArrow(_apply, out)
