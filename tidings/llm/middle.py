"""Fill-in-middle by a piece table.

A document becomes descriptors (buffer, start, stop) over its text, which is never changed, and a buffer of
sentinels. `cut` splits a descriptor, `arranged` puts descriptors in another order; neither copies
text. Output and hashes are read off the descriptors. Restoring makes a table over an output, cuts it
at the sentinels and applies the inverse order.

Units are runs of the letters A-Z, a-z, or single other characters. The cuts and the form follow from
a hash of the id, so a rerun gives the same output.

Defined results: a null text is empty; an empty text, and one that contains a sentinel, stays plain;
a null id hashes like an empty one; repeated rows give the same result; other columns are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100
# forms: sentinels and parts in the order of the output
ORDERS = {"psm": ("P", "prefix", "S", "suffix", "M", "middle"), "spm": ("S", "suffix", "P", "prefix", "M", "middle")}
SLICE = 1 << 20  # characters looked at together


class Piece(NamedTuple):
    source: int  # place of the buffer
    start: int
    stop: int


class PieceTable:
    """Descriptors over buffers: the text at 0, the sentinels at 1."""

    def __init__(self, text: str, pieces: list[Piece] | None = None):
        self.buffers = (text, SENTINELS)
        self.pieces = [Piece(0, 0, len(text))] if pieces is None else pieces

    def cut(self, *places: int) -> PieceTable:
        """With descriptors split so that one begins at each of the rising `places` of the content."""
        out, at, todo = [], 0, list(places)
        for piece in self.pieces:
            while todo and todo[0] <= at + piece.stop - piece.start:
                middle = piece.start + todo.pop(0) - at
                out.append(piece._replace(stop=middle))
                at += middle - piece.start
                piece = piece._replace(start=middle)
            out.append(piece)
            at += piece.stop - piece.start
        return PieceTable(self.buffers[0], out)

    def arranged(self, order: list[int], new: tuple[Piece, ...] = ()) -> PieceTable:
        """The descriptors, followed by those of `new`, in `order`."""
        pool = [*self.pieces, *new]
        return PieceTable(self.buffers[0], [pool[i] for i in order])

    def chunks(self) -> Iterator[str]:
        for source, start, stop in self.pieces:
            for at in range(start, stop, SLICE):
                yield self.buffers[source][at : min(at + SLICE, stop)]

    def text(self) -> str:
        return "".join(self.chunks())

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for chunk in self.chunks():
            digest.update(chunk.encode())
        return digest.hexdigest()


# columns of a transformed document
MADE = ["n", "form", "prefix_chars", "middle_chars", "output", "output_sha256"]
# descriptors 0 to 2 of a cut text are prefix, middle and suffix, 3 to 5 the sentinels
PARTS = ["prefix", "middle", "suffix", "P", "S", "M"]
MARKS = tuple(Piece(1, i, i + 3) for i in range(0, 9, 3))


def unit_starts(text: str) -> Iterator[np.ndarray]:
    """Places where units begin, slice by slice."""
    letter_before = False
    for at in range(0, len(text), SLICE):
        points = np.frombuffer(text[at : at + SLICE].encode("utf-32-le"), np.uint32)
        lower = points | 0x20
        letter = (lower >= 97) & (lower <= 122) & (points < 128)
        follows = letter & np.append(letter_before, letter[:-1])
        letter_before = bool(letter[-1])
        yield np.flatnonzero(~follows) + at


def place_of(text: str, unit: int) -> int:
    """Where the unit of this number begins; the end of the text after the last."""
    for starts in unit_starts(text):
        if unit < len(starts):
            return int(starts[unit])
        unit -= len(starts)
    return len(text)


def plan(doc_id: int | None, text: str) -> tuple[int, str, PieceTable]:
    """(units, form, table of the output)."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    units = sum(map(len, unit_starts(text)))
    table = PieceTable(text)
    if not text or h3 % 100 >= PLAIN_FROM or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return units, "plain", table
    form = "spm" if h4 % 100 < SPM_BELOW else "psm"
    cuts = sorted((h1 % (units + 1), h2 % (units + 1)))
    parted = table.cut(*(place_of(text, c) for c in cuts))
    return units, form, parted.arranged([PARTS.index(p) for p in ORDERS[form]], MARKS)


def restore(output: str, form: str) -> PieceTable:
    """The table of the text that `output` was made of."""
    table = PieceTable(output)
    if form == "plain":
        return table
    order = ORDERS[form]
    places, at = [], 0
    for name in order[::2]:  # no sentinel occurs in the text itself
        at = output.index({"P": PREFIX, "S": SUFFIX, "M": MIDDLE}[name], at)
        places += [at, at + len(PREFIX)]
        at += len(PREFIX)
    parted = table.cut(*places[1:])  # begins with a sentinel
    return parted.arranged([order.index(p) for p in ("prefix", "middle", "suffix")])


def _transformed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = []
        for id_, text in zip(batch["id"], batch["text"]):
            units, form, table = plan(id_.as_py(), text.as_py() or "")
            size = dict(zip(ORDERS.get(form, ()), (p.stop - p.start for p in table.pieces)))
            made.append((units, form, size.get("prefix"), size.get("middle"), table.text(), table.sha256()))
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        columns = [pa.array([m[k] for m in made], kind) for k, kind in enumerate(types)]
        yield pa.RecordBatch.from_arrays([batch["row"], batch["text"], *columns], ["row", "text", *MADE])


def transform(documents: DataFrame) -> DataFrame:
    """`row` (the columns of `documents` but text), `text`, `n` (units), `form`, lengths of prefix and middle
    (null if plain), `output` and its hash."""
    docs = documents.select(
        F.col("doc_id").cast("string").alias("id"), F.struct(*[c for c in documents.columns if c != "text"]).alias("row"), F.col("text").cast("string"))
    out = T.StructType([docs.schema["row"], *T.StructType.fromDDL(
        "text string, n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string")])
    return docs.mapInArrow(_transformed, out)


def restored_sha256(transformed: DataFrame) -> DataFrame:
    """`transformed` with `restored_sha256`, the hash of the text rebuilt from `output` and `form` alone."""

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [restore(o.as_py(), f.as_py()).sha256() for o, f in zip(batch["output"], batch["form"])]
            yield batch.append_column("restored_sha256", pa.array(hashes, pa.string()))

    return transformed.mapInArrow(rebuild, T.StructType([*transformed.schema, T.StructField("restored_sha256", T.StringType())]))
