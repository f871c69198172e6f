"""Feed documents to raw records."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.config import DAYS_BACK, MAX_PER_TOPIC
from tidings.functions.binding import let, once
from tidings.functions.links import dedup_key
from tidings.functions.quality import is_low_quality
from tidings.functions.text import split_title
from tidings.functions.times import is_recent, parse_published, to_iso
from tidings.operators.editions import dedup_and_cap
from tidings.schemas import FEED_ITEM

# Sections that hide tags, of one item at most. Possessive loops, so that length takes no stack.
CDATA = r"<!\[CDATA\[(?:[^\]<]++|\](?!\]>)|<(?!item[\s>]|!\[CDATA\[))*+\]\]>"
COMMENT = r"<!--(?:[^-]++|-(?!->))*+-->"
# from an opening tag to its closing one, the next opening one or the end, passing over such sections
ITEM = rf"<item(?=[\s>])(?:[^<]++|{CDATA}|{COMMENT}|<(?!/item\s*>|item[\s>]))*+(?:</item\s*>)?"
PIECES = rf"{COMMENT}|{CDATA}|{ITEM}"
# an ampersand that begins no XML entity
XML_ENTITIES = ("amp", "lt", "gt", "quot", "apos")
STRAY = r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);)"
ITEM_OR_RAW = T.StructType([*FEED_ITEM.fields, T.StructField("_corrupt_record", T.StringType())])
RECORD_FIELDS = [
    "topic", "title", "source", "link", "published_at", "collected_at", "run_date",
]
# one feed is one request: a topic on a run date
FEED = ["run_date", "topic"]

# publication time -> condition; other columns of the item may be used
InWindow = Callable[[Column], Column]


def read_feed_documents(spark: SparkSession, path: str) -> DataFrame:
    """(content, file, partition columns..) with one landed feed document per row. Partition
    folders such as run_date=2026-09-14/topic=Markets become columns."""
    return (
        spark.read.option("wholetext", True)
        .text(path)
        .withColumnRenamed("value", "content")
        .withColumn("file", F.col("_metadata.file_path"))
    )


def read_feed_items(spark: SparkSession, path: str) -> DataFrame:
    """Items straight from landed XML files, for feeds whose order does not matter. Broken
    documents give no items."""
    return spark.read.format("xml").option("rowTag", "item").schema(FEED_ITEM).load(path)


def numbered_entities(text: Column) -> Column:
    """Named entities of HTML, which XML does not know, by number; XML's own five stay."""
    table = F.create_map(*[F.lit(x) for name, code in sorted(name2codepoint.items()) if name not in XML_ENTITIES for x in (name, f"#{code}")])

    def numbered(part: Column) -> Column:
        name = F.regexp_extract(part, r"^([A-Za-z][A-Za-z0-9]*);", 1)
        return let(F.try_element_at(table, name), lambda code: F.when(code.isNull(), part).otherwise(
            F.concat(code, F.substr(part, F.length(name) + 1))))

    return F.array_join(F.transform(F.split(text, "&"), numbered), "&")


def feed_items(documents: DataFrame, keep: list[str], content: str = "content") -> DataFrame:
    """One row per item with its `position` in the document; `keep` names the document's columns
    to carry along.

    Items are cut out of the text and parsed one by one, so a broken item costs no other one. Tags
    inside CDATA sections and comments do not count. An item that does not parse is tried again with
    HTML's entities by number and stray ampersands escaped; if it still fails it is `unparsed`. A document without items gives one row without a position."""
    parse = lambda text: F.from_xml(text, ITEM_OR_RAW, {"mode": "PERMISSIVE"})
    found = F.filter(F.regexp_extract_all(content, F.lit(PIECES), F.lit(0)), lambda p: F.startswith(p, F.lit("<item")))
    pieces = documents.select(*keep, F.posexplode_outer(found).alias("position", "piece"))
    # a filter on what becomes of an item would otherwise be moved down and parse it again for each use
    first = once(pieces, "item", parse(F.col("piece")))
    broken = F.col("tried")["_corrupt_record"].isNotNull()
    repaired = F.regexp_replace(numbered_entities(F.col("piece")), STRAY, "&amp;")
    again = once(first.withColumnRenamed("item", "tried"), "item", F.coalesce(parse(F.when(broken, repaired)), "tried"))
    return again.select(
        *keep,
        "position",
        (F.col("item")["_corrupt_record"].isNotNull()).alias("unparsed"),
        F.col("item.title").alias("raw_title"),
        F.col("item.link").alias("link"),
        F.col("item.pubDate").alias("pub_date"),
        F.col("item.source._VALUE").alias("raw_source"),
    )


def classify_items(items: DataFrame, in_window: InWindow) -> DataFrame:
    """Items with title, source and time worked out, and `dropped`: outside_window, low_quality
    or null for an item to keep."""
    worked = F.struct(
        parse_published(F.col("pub_date")).alias("published"),
        split_title(F.col("raw_title"), F.col("raw_source")).alias("titled"),
    )
    titled = once(items, "_t", worked)
    title, published = F.col("_t.titled.title"), F.col("_t.published")
    return titled.select(
        *[name for name in items.columns if name not in ("raw_title", "raw_source", "pub_date", "unparsed")],
        title.alias("title"),
        F.col("_t.titled.source").alias("source"),
        published.alias("published"),
        F.when(F.col("position").isNull(), F.lit("no_items"))
        .when(F.col("unparsed"), F.lit("unparsed"))
        .when(~in_window(published), F.lit("outside_window"))
        .when(is_low_quality(title), F.lit("low_quality"))
        .alias("dropped"),
    )


def daily_window(days_back: int = DAYS_BACK) -> InWindow:
    """The daily run's window before the `collected_at` timestamp of the item."""
    return lambda published: is_recent(published, F.col("collected_at"), days_back)


def drop_counts(classified: DataFrame, feed: list[str] = FEED) -> DataFrame:
    """(feed.., items, low_quality, outside_window, unparsed) counted before any cap; a feed without
    items counts zero of each."""
    return classified.groupBy(*feed).agg(
        F.count("position").alias("items"),
        F.count_if(F.col("dropped") == "low_quality").alias("low_quality"),
        F.count_if(F.col("dropped") == "outside_window").alias("outside_window"),
        F.count_if(F.col("dropped") == "unparsed").alias("unparsed"),
    )


def feed_records(
    classified: DataFrame,
    *,
    feed: list[str] = FEED,
    position: list[str] = ["position"],
    limit: int = MAX_PER_TOPIC,
    extra: dict[str, str] | None = None,
) -> DataFrame:
    """Raw records of the kept items: repeated links removed, newest first, at most `limit` per
    feed, `place` from 1. `extra` adds constant fields and never replaces a schema field."""
    kept = classified.filter(F.col("dropped").isNull()).withColumn(
        "link", F.coalesce("link", F.lit(""))
    )
    keyed = kept.withColumn(
        "headline_id", dedup_key(F.col("link"), F.col("title"), F.col("source"))
    )
    capped = dedup_and_cap(keyed, feed, newest="published", position=position, limit=limit)
    added = {k: v for k, v in (extra or {}).items() if k not in RECORD_FIELDS}
    return capped.select(
        "topic", "title", "source", "link",
        to_iso(F.col("published")).alias("published_at"),
        to_iso(F.col("collected_at")).alias("collected_at"),
        F.col("run_date").cast("string").alias("run_date"),
        *[F.lit(value).alias(name) for name, value in added.items()],
        "place",
    )


def read_items(documents: DataFrame, in_window: InWindow, order: list[str] = []) -> DataFrame:
    """The classified items of documents with topic, run_date, collected_at, content."""
    return classify_items(feed_items(documents, [*FEED, "collected_at", *order]), in_window)


def parse_feed(
    documents: DataFrame,
    *,
    in_window: InWindow | None = None,
    days_back: int = DAYS_BACK,
    limit: int = MAX_PER_TOPIC,
    extra: dict[str, str] | None = None,
    order: list[str] = [],
) -> tuple[DataFrame, DataFrame]:
    """(records, drop counts) of feed documents with topic, run_date, collected_at, content.

    A feed may be spread over several documents; `order` names the columns that put them in
    sequence. Documents are parsed where they are read; only keys, ranks and kept items move."""
    classified = read_items(documents, in_window or daily_window(days_back), order)
    records = feed_records(
        classified, position=[*order, "position"], limit=limit, extra=extra
    )
    return records, drop_counts(classified)
