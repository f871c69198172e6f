"""WARC archives with a two-level capture index.

Writing: each task writes one gzip member per record into archive files in the shared folder. Of
records with equal payloads of at least `MIN_REVISIT` bytes the one with the smallest page id is a
response; the others are revisits without a payload that name it.

Index: captures are sorted by reversed-host URL key and packed into compressed blocks of
`BLOCK_LINES` lines. Each range of keys is one shard file: blocks, then a sparse directory with the
first key of every block. The list of shards has one entry per task and is the upper level. A
lookup searches shards, directory and block by bisection, reads the block's bytes and then the
record's bytes, nothing else. A sequential read of the archives gives the captures to index; what is
returned is read through the index, each task taking a range of keys so that it opens a block once.

Files get a name of their own per attempt and only the names that successful tasks return are ever
read, so a lost executor leaves files that nobody looks at.

Defined results: null html is an empty payload; null URLs have an empty key; a null page id is
never the smallest, and its record has no id; repeated rows with the smallest id are all
responses; no pages give no archives and no rows. Only page_id, url and html are read.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import uuid
import zlib

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import stored
from tidings.session import shared_folder

MIN_REVISIT = 100
BLOCK_LINES = 512
ARCHIVE_BYTES = 64 << 20  # compressed; a larger partition fills several archives
READ = 1 << 20
RANGE_BYTES = 4 << 20  # compressed; records that one task reads through the index
ROWS = 2000  # rows a task hands over at a time
DATE = "2000-01-01T00:00:00Z"  # pages carry no time
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURE = (
    "page_id long, record_type string, key string, digest string, archive string, offset long, length long"
)
RECORD = (
    "page_id long, record_type string, refers_to long, refers_uri string, digest string, payload_bytes long, payload_digest string"
)


def open_folder(path: str):
    """(file system, path in it) of a file anywhere the executors can reach."""
    return arrow_fs.FileSystem.from_uri(path)


# --- URL keys ---------------------------------------------------------------------------------

def url_key(url: str | None) -> str:
    """`com,example,blog)/path?query`: host labels reversed, scheme, user, port and fragment left
    out, so that a site's captures lie side by side."""
    if not url:
        return ")"
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url.strip()).split("#", 1)[0]
    host, slash, path = re.match(r"([^/?]*)(/?)(.*)", rest, re.S).groups()
    host = host.rsplit("@", 1)[-1].split(":", 1)[0].lower().strip(".")
    return re.sub(r"\s", "%20", f"{','.join(reversed(host.split('.')))}){slash or '/'}{path}")


def capture_key(url: str | None, page_id: int | None) -> str:
    return f"{url_key(url)} {'' if page_id is None else page_id}"


# --- records ----------------------------------------------------------------------------------

def classify(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """(page_id, url, payload, digest, record_type, refers_to, refers_uri), a row per page; the
    payload of a revisit is null. Copies are counted before the shuffle, one row per payload."""
    payload = F.coalesce("html", F.lit(""))
    parsed = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    firsts = (
        parsed.filter(F.octet_length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.min_by("url", F.coalesce("page_id", F.lit(2**63 - 1))).alias("first_url"), F.count("*").alias("n"))
        .filter("n > 1")
        .select(F.col("digest").alias("first_digest"), "first_id", "first_url")
    )
    joined = parsed.join(firsts, F.col("digest") == F.col("first_digest"), "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first_id")).alias("refers_to"),
        F.when(again, F.col("first_url")).alias("refers_uri"),
    )


def _clean(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id, url, payload, digest, kind, refers_to, refers_uri) -> bytes:
    """One WARC/1.1 record, not compressed."""
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", _clean(url)))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
        if refers_uri is not None:
            fields.append(("WARC-Refers-To-Target-URI", _clean(refers_uri)))
        block = HTTP
    else:
        block = HTTP + payload.encode()
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _id(field: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", field or "")
    return int(found[1]) if found else None


def _gzip(data: bytes) -> bytes:
    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def members(stream):
    """(offset, length, content) of the gzip members of an open file, one in memory at a time."""
    offset, rest, ended = 0, b"", False
    while True:
        unpack, content, length = zlib.decompressobj(31), [], 0
        while not unpack.eof:
            chunk = rest or (b"" if ended else stream.read(READ))
            rest = b""
            if not chunk:
                if length:
                    raise ValueError("an archive ends inside a record")
                return
            content.append(unpack.decompress(chunk))
            rest = unpack.unused_data
            length += len(chunk) - len(rest)
        yield offset, length, b"".join(content)
        offset += length


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Write a record per page under `folder`; (archive, records, size), a row per archive."""

    def write(batches):
        system, root = open_folder(f"{folder}/archives")
        system.create_dir(root, recursive=True)
        out, name, size, n = None, "", 0, 0
        for batch in batches:
            batch = batch.astype(object).where(batch.notna(), None)
            for row in batch.itertuples(index=False):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, size, n = system.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                data = _gzip(record(*row))
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    yield pd.DataFrame({"archive": [f"{folder}/archives/{name}"], "records": [n], "size": [size]})
        if out is not None:
            out.close()
            yield pd.DataFrame({"archive": [f"{folder}/archives/{name}"], "records": [n], "size": [size]})

    # ids as text: pandas would turn a column with a null into floating point
    texts = {n: F.col(n).cast("string") for n in ("page_id", "refers_to")}
    rows = classify(pages, min_bytes).withColumns(texts).mapInPandas(write, "archive string, records long, size long")
    return stored(rows, "archives")


def scan_archives(archives: DataFrame) -> DataFrame:
    """A capture row for every record, from a sequential read: what the index is made of."""

    def scan(batches):
        for batch in batches:
            for path in batch["archive"]:
                system, place = open_folder(path)
                rows = []
                with system.open_input_stream(place, compression=None) as stream:
                    for offset, length, data in members(stream):
                        fields = parse(data)[0]
                        page_id = _id(fields["WARC-Record-ID"])
                        rows.append((
                            page_id, fields["WARC-Type"], capture_key(fields.get("WARC-Target-URI"), page_id),
                            fields["WARC-Payload-Digest"].partition(":")[2], path, offset, length,
                        ))
                        if len(rows) >= ROWS:
                            yield _frame(rows, CAPTURE)
                            rows = []
                yield _frame(rows, CAPTURE)

    n = max(1, archives.count())  # a row per archive: one task each
    return stored(archives.select("archive").repartition(n).mapInPandas(scan, CAPTURE), "captures")


def _frame(rows, schema: str) -> pd.DataFrame:
    kinds = dict(part.split() for part in schema.split(","))
    frame = pd.DataFrame(rows, columns=list(kinds), dtype=object)
    return frame.astype({n: "Int64" for n, kind in kinds.items() if kind == "long"})


# --- index ------------------------------------------------------------------------------------

def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> list[tuple[str, str]]:
    """Write the sorted captures as index shards; [(first key, shard path)], sorted, an entry per
    task. A hot URL's captures are split over shards, since the page id is part of the key."""

    def pack(batches):
        system, root = open_folder(f"{folder}/index")
        system.create_dir(root, recursive=True)
        out, lines, directory, path = None, [], [], ""

        def flush():
            data = zlib.compress("\n".join(line for _, line in lines).encode(), 6)
            directory.append([lines[0][0], out.tell(), len(data)])
            out.write(data)
            lines.clear()

        for batch in batches:
            for key, kind, digest, archive, offset, length in batch.itertuples(index=False):
                if out is None:
                    path = f"{folder}/index/{uuid.uuid4().hex}.idx"
                    out = system.open_output_stream(f"{root}/{path.rsplit('/', 1)[1]}", compression=None)
                lines.append((key, json.dumps([key, kind, digest, archive, int(offset), int(length)])))
                if len(lines) >= block_lines:
                    flush()
        if out is not None:
            if lines:
                flush()
            data, at = zlib.compress(json.dumps(directory).encode(), 6), out.tell()
            out.write(data)
            out.write(struct.pack("<QQ", at, len(data)))
            out.close()
            yield pd.DataFrame({"first": [directory[0][0]], "shard": [path]})

    shards = (
        captures.select("key", "record_type", "digest", "archive", "offset", "length")
        .repartitionByRange("key", "offset")
        .sortWithinPartitions("key", "offset")
        .mapInPandas(pack, "first string, shard string")
    )
    return sorted(tuple(r) for r in stored(shards, "shards").collect())


class Index:
    """Lookups in a written index; a task keeps the directories of the shards it has used and the
    last block."""

    def __init__(self, shards: list[tuple[str, str]], keep: int = 16):
        self.shards, self.firsts, self.keep, self.open = shards, [s[0] for s in shards], keep, {}
        self.last, self.block = None, ([], [])

    def _directory(self, path: str):
        if path not in self.open:
            while len(self.open) >= self.keep:
                self.open.pop(next(iter(self.open)))[0].close()
            system, place = open_folder(path)
            file = system.open_input_file(place)
            at, length = struct.unpack("<QQ", file.read_at(16, file.size() - 16))
            directory = json.loads(zlib.decompress(file.read_at(length, at)))
            self.open[path] = (file, directory, [d[0] for d in directory])
        return self.open[path]

    def find(self, key: str):
        """The index lines with this key, by bisection of shards, directory and block. Equal keys
        may run over a border, so the search starts in the last block that begins before them."""
        for s in range(max(0, _before(self.firsts, key)), len(self.shards)):
            if self.firsts[s] > key:
                return
            file, directory, firsts = self._directory(self.shards[s][1])
            for b in range(max(0, _before(firsts, key)), len(directory)):
                if firsts[b] > key:
                    break
                if self.last != (s, b):
                    _, at, length = directory[b]
                    lines = [json.loads(x) for x in zlib.decompress(file.read_at(length, at)).decode().split("\n")]
                    self.last, self.block = (s, b), (lines, [line[0] for line in lines])
                lines, keys = self.block
                i = _before(keys, key) + 1
                while i < len(lines) and keys[i] == key:
                    yield lines[i]
                    i += 1


def _before(keys: list[str], key: str) -> int:
    """The last place whose key is smaller, -1 if none is."""
    lo, hi = 0, len(keys)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (mid + 1, hi) if keys[mid] < key else (lo, mid)
    return lo - 1


class Archives:
    """Records by range reads; a task keeps the archives it has used open."""

    def __init__(self, keep: int = 16):
        self.keep, self.open = keep, {}

    def read(self, archive: str, offset: int, length: int) -> tuple[dict[str, str], bytes]:
        if archive not in self.open:
            while len(self.open) >= self.keep:
                self.open.pop(next(iter(self.open))).close()
            system, place = open_folder(archive)
            self.open[archive] = system.open_input_file(place)
        return parse(zlib.decompress(self.open[archive].read_at(length, offset), 31))


def read_all(captures: DataFrame, shards: list[tuple[str, str]]) -> DataFrame:
    """A row for every record that the index has under the captures' keys, read by range; payload
    length and digest are worked out from what was read, and null for a revisit. The captures give
    keys only, so what the index lacks or misplaces is not in the result."""

    def look(batches):
        index, archives, rows = Index(shards), Archives(), []
        for batch in batches:
            for key in batch["key"]:
                for _, kind, _, archive, offset, length in index.find(key):
                    fields, payload = archives.read(archive, offset, length)
                    page_id, full = _id(fields["WARC-Record-ID"]), fields["WARC-Type"] == "response"
                    if kind != fields["WARC-Type"] or key != capture_key(fields.get("WARC-Target-URI"), page_id):
                        raise ValueError(f"the index names another record than {archive} has at {offset}")
                    rows.append((
                        page_id, kind, _id(fields.get("WARC-Refers-To")), fields.get("WARC-Refers-To-Target-URI"),
                        fields["WARC-Payload-Digest"].partition(":")[2],
                        len(payload) if full else None, hashlib.sha256(payload).hexdigest() if full else None,
                    ))
                    if len(rows) >= ROWS:
                        yield _frame(rows, RECORD)
                        rows = []
        yield _frame(rows, RECORD)

    size = captures.agg(F.sum("length")).first()[0] or 0
    keys = captures.select("key").distinct().repartitionByRange(1 + size // RANGE_BYTES, "key").sortWithinPartitions("key")
    return stored(keys.mapInPandas(look, RECORD), "records")


def fetch(targets: DataFrame, shards: list[tuple[str, str]]) -> DataFrame:
    """(refers_to, refers_uri, digest) to the payload length and digest read from the response."""

    def look(batches):
        index, archives = Index(shards), Archives()
        for batch in batches:
            rows = []
            for target, uri, digest in batch.astype(object).where(batch.notna(), None).itertuples(index=False):
                for _, kind, found, archive, offset, length in index.find(capture_key(uri, int(target))):
                    if kind == "response" and found == digest:
                        payload = archives.read(archive, offset, length)[1]
                        rows.append((int(target), digest, len(payload), hashlib.sha256(payload).hexdigest()))
                        break
            yield pd.DataFrame(rows, columns=["t_id", "t_digest", "t_bytes", "t_sha"])

    return targets.mapInPandas(look, "t_id long, t_digest string, t_bytes long, t_sha string")


def roundtrip(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Write the pages as archives, index them and read everything back through the index: (page_id,
    payload_bytes, payload_digest, record_type, refers_to), a row per record. What a revisit stands for is read
    from its response, once for each response."""
    folder = shared_folder(pages.sparkSession, "warc")
    captures = scan_archives(write_archives(pages, folder, min_bytes))
    shards = write_index(captures, folder)
    records = read_all(captures, shards)
    targets = records.filter("record_type = 'revisit'").select("refers_to", "refers_uri", "digest").distinct()
    found = fetch(targets, shards)
    joined = records.join(found, (F.col("refers_to") == F.col("t_id")) & (F.col("digest") == F.col("t_digest")), "left")
    return joined.select(
        "page_id",
        F.coalesce("payload_bytes", "t_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "t_sha").alias("payload_digest"),
        "record_type", "refers_to",
    )
