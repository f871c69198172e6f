"""Benchmark decontamination by a prefix-filtered set join.

Every item is cut into windows of `size` words. A window occurs in a document only if all its
shingles do, so one of them, its rarest over all documents, is the necessary prefix. Documents
meet windows on that shingle alone; the shingle's offset fixes where the window would start, the
lengths say whether it fits, and the words are then compared one by one.

Columns only. Defined results: a null text has no words and is clean; an item without words has
no window; an item of fewer words than a window is one window; items without an id are found but
not listed; repeated documents give repeated rows; empty tables give clean or no rows. Only
`doc_id`, `text`, `item_id` and `text` are read, so other columns may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import ascii_lower, stored, words

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 3
# Windows in one broadcast, some 200 bytes each. A larger benchmark is joined in several blocks.
BLOCK = 200_000


def text_words(text: Column) -> Column:
    return words(ascii_lower(text), SEPARATORS)


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, win, span): the distinct windows of every item and the words in their shingles."""
    items = benchmark.select("item_id", text_words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    n = F.size("words")
    starts = F.when(n > size, F.sequence(F.lit(1), n - size + 1)).otherwise(F.array(F.lit(1)))
    return (
        items.select("item_id", "words", F.explode(starts).alias("start"))
        .select("item_id", F.slice("words", F.col("start"), size).alias("win"))
        .distinct()
        .withColumn("span", F.least(F.lit(SHINGLE), F.size("win")))
    )


def shingle_key(array: str, at: Column, span: int) -> Column:
    return F.xxhash64(F.lit(span), *[F.get(array, at + i) for i in range(span)])


def _shingles(wins: DataFrame, span: int) -> DataFrame:
    """(.., offset, key) for every shingle of the windows."""
    last = F.size("win") - span
    return wins.select("*", F.explode(F.sequence(F.lit(0), last)).alias("offset")).withColumn(
        "key", shingle_key("win", F.col("offset"), span)
    )


def _positions(documents: DataFrame, first: int) -> DataFrame:
    """A row for every word position from `first`; -1 stands for the document itself."""
    parsed = documents.select("doc_id", F.xxhash64("text").alias("version"), text_words(F.col("text")).alias("words"))
    return parsed.select(
        "doc_id", "version", "words", F.explode(F.sequence(F.lit(first), F.greatest(F.size("words") - 1, F.lit(first)))).alias("pos")
    )


def prefixes(documents: DataFrame, wins: DataFrame, span: int) -> DataFrame:
    """(key, offset, win, item_id): each window under its rarest shingle, by the number of times
    the shingles occur in all documents. Windows with a shingle that occurs nowhere are left out."""
    tokens = _shingles(wins, span)
    wanted = tokens.select("key").distinct()
    counts = (
        _positions(documents, 0)
        .select(shingle_key("words", F.col("pos"), span).alias("key"))
        .join(F.broadcast(wanted), "key")
        .groupBy("key")
        .agg(F.count("*").alias("n"))
    )
    ranked = tokens.join(counts, "key", "left").groupBy("item_id", "win").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "offset")).alias("least")
    )
    return ranked.filter(F.col("least.n") > 0).select("least.key", "least.offset", "win", "item_id")


def _blocks(wins: DataFrame, block: int) -> list[tuple[DataFrame, int]]:
    """(windows, words in their shingles) in blocks that are small enough to broadcast."""
    sizes = {r["span"]: r["n"] for r in wins.groupBy("span").agg(F.count("*").alias("n")).collect()}  # 3 rows at most
    out = []
    for span, n in sorted(sizes.items()):
        parts = -(-n // block)
        part = F.pmod(F.xxhash64("win", "item_id"), F.lit(parts))
        out += [(wins.filter((F.col("span") == span) & (part == i)), span) for i in range(parts)]
    return out


def hits(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """(doc_id, version, n_words, start, stop, item_id): a row without `start` for every document,
    and one for every occurrence of a window."""
    wins = stored(windows(benchmark, size), "windows")
    found = []
    for part, span in _blocks(wins, block):
        first = 0 if found else -1
        keyed = _positions(documents, first).withColumn("key", shingle_key("words", F.col("pos"), span))
        right = F.broadcast(stored(prefixes(documents, part, span), "prefixes")).select(
            F.col("key").alias("p_key"), "offset", "win", "item_id"
        )
        start = F.col("pos") - F.col("offset")
        holds = (
            (F.col("key") == F.col("p_key"))
            & (F.col("pos") >= 0)
            & (start >= 0)
            & (start + F.size("win") <= F.size("words"))
            & (F.slice("words", F.greatest(start, F.lit(0)) + 1, F.size("win")) == F.col("win"))
        )
        joined = keyed.join(right, holds, "left").filter((F.col("pos") == -1) | F.col("p_key").isNotNull())
        found.append(
            joined.select(
                "doc_id", "version", F.size("words").alias("n_words"),
                start.alias("start"), (start + F.size("win")).alias("stop"), "item_id",
            )
        )
    if not found:
        parsed = documents.select("doc_id", F.xxhash64("text").alias("version"), F.size(text_words(F.col("text"))).alias("n_words"))
        none = F.lit(None).cast("int")
        return parsed.select("*", none.alias("start"), none.alias("stop"), F.lit(None).cast("long").alias("item_id"))
    return reduce(DataFrame.unionByName, found)


def contamination(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """(doc_id, version, n_words, n_hit, n_items, items array, contaminated), a row per document.

    `version` is a hash of the text, so that rows with one id and different texts stay apart."""
    spans = F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "stop")))
    grouped = hits(documents, benchmark, size, block).groupBy("doc_id", "version").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.count_if(F.col("start").isNull()).alias("copies"),
        F.array_sort(spans).alias("spans"),
        F.array_sort(F.transform(F.collect_set("item_id"), lambda i: i.cast("string"))).alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("total"), F.lit(0).alias("upto")),
        lambda a, x: F.struct(
            (a["total"] + F.greatest(F.lit(0), x["stop"] - F.greatest(x["start"], a["upto"]))).alias("total"),
            F.greatest(a["upto"], x["stop"]).alias("upto"),
        ),
        lambda a: a["total"].cast("long"),
    )
    return grouped.select(
        "doc_id", "version", "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items",
        (F.size("spans") > 0).alias("contaminated"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def decontaminate(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents in which no window of the benchmark occurs."""
    bad = contamination(documents, benchmark, size).filter("contaminated").select(
        F.col("doc_id").alias("_bad_id"), F.col("version").alias("_bad_version")
    ).distinct()
    same = documents["doc_id"].eqNullSafe(bad["_bad_id"]) & (F.xxhash64(documents["text"]) == bad["_bad_version"])
    return documents.join(bad, same, "left_anti")
