"""Raw landing zone: JSON lines under raw/landing=<n>/date=YYYY-MM-DD/topic_slug=<slug>/.

A landing writes its batch once, with the key of every record, and never touches what is there. Then
one file in `catalogue` names its folders; without it the landing does not exist. Readers go by
the catalogue, so a day is read from its own folders, whatever else has landed. Of several versions
of a record the one of the first landing counts; days of one landing are read as they are, others
are merged on reading, until `compact` writes them as one.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.functions.links import dedup_key
from tidings.functions.text import slug
from tidings.schemas import RAW_RECORD
from tidings.session import scratch
from tidings.sources.files import children, exists, remove

PARTITIONS = ["date", "topic_slug"]
_FIELDS = RAW_RECORD.fieldNames()
_COLUMNS = [*_FIELDS, *PARTITIONS]
_READ = ", ".join(f"{name} string" for name in [*_FIELDS, "key", *PARTITIONS]) + ", landing long"
# n records of a folder; `whole`: versions of earlier landings are in it
ENTRY = "landing long, date string, topic_slug string, n long, whole boolean"
CATALOGUE = "catalogue"


def catalogue(spark: SparkSession, raw_dir: str) -> DataFrame:
    """(landing, date, topic_slug, n, whole) of the folders to read, a row for each: what a later
    landing holds as a whole is left out."""
    folder = f"{raw_dir}/{CATALOGUE}"
    if not exists(spark, folder):
        return spark.createDataFrame([], ENTRY)
    entries = spark.read.schema(ENTRY).option("recursiveFileLookup", True).json(folder)
    whole = entries.filter("whole").groupBy("date").agg(F.max("landing").alias("since"))
    return entries.join(whole, "date", "left").filter("landing >= coalesce(since, 0)").select(*[f.split()[0] for f in ENTRY.split(", ")])


def _folders(spark: SparkSession, raw_dir: str, dates: set[str] | None) -> tuple[list[str], list[str]]:
    """Folders of days that lie in one landing, and of days that lie in several."""
    # as many rows as landed days and topics
    landings: dict[str, set[int]] = {}
    for row in catalogue(spark, raw_dir).select("date", "landing").distinct().collect():
        if dates is None or row["date"] in dates:
            landings.setdefault(row["date"], set()).add(row["landing"])
    of = lambda many: [
        f"{raw_dir}/landing={n}/date={day}" for day, found in sorted(landings.items()) if (len(found) > 1) == many for n in sorted(found)]
    return of(False), of(True)


def _read(spark: SparkSession, raw_dir: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], _READ)
    return spark.read.schema(_READ).option("basePath", raw_dir).json(folders)


def _latest_merged(spark: SparkSession, raw_dir: str, dates: set[str] | None = None) -> DataFrame:
    """The records of the given days, of all without, with `key`, one version of each."""
    single, several = _folders(spark, raw_dir, dates)
    fields = [*_COLUMNS, "key"]
    frame = _read(spark, raw_dir, single).select(*fields)
    if several:
        frame = frame.unionByName(_first(_read(spark, raw_dir, several), "landing").select(*fields))
    return frame


def read_raw(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Every landed record with `date` and `topic_slug`. The date stays text; filters on it prune
    folders."""
    return _latest_merged(spark, raw_dir).select(*_COLUMNS)


def read_partition(
    spark: SparkSession, raw_dir: str, run_dates: date | str | Iterable[date | str]
) -> DataFrame:
    """Records of one or several run dates; a missing date gives no rows."""
    if isinstance(run_dates, (date, str)):
        run_dates = [run_dates]
    return _latest_merged(spark, raw_dir, {str(value) for value in run_dates}).select(*_COLUMNS)


def dated(records: DataFrame) -> DataFrame:
    """Records of folders whose name is a date. The condition is about the folder column only, so
    stray folders are left out before anything is read."""
    return records.filter(F.rlike("date", F.lit(r"^\d{4}-\d{2}-\d{2}$")) & F.col("date").try_cast("date").isNotNull())


def partition_dates(spark: SparkSession, raw_dir: str) -> DataFrame:
    """run_date: dates with at least one landed record, ascending, by the catalogue alone."""
    return dated(catalogue(spark, raw_dir)).select(F.col("date").cast("date").alias("run_date")).distinct().orderBy("run_date")


def _first(keyed: DataFrame, *order: str) -> DataFrame:
    """One version per key of a day's topic, the first by `order`, then by time of collection and place.
    One aggregate with partial results, so repeated copies never travel."""
    rank = F.struct(*order, F.col("collected_at"), *(["place"] if "place" in keyed.columns else []), *_FIELDS)
    return (
        keyed.groupBy(*PARTITIONS, "key")
        .agg(F.min_by(F.struct(*_FIELDS), rank).alias("record"))
        .select(*PARTITIONS, "key", "record.*")
    )


def _keyed(records: DataFrame) -> DataFrame:
    """Records with all fields as text, folder names, `key` and what orders their copies."""
    have = set(records.columns)
    number = lambda n: (F.col(n) if n in have else F.lit(0)).cast("long").alias(n)
    return records.select(
        "date", slug(F.col("topic")).alias("topic_slug"),
        dedup_key(F.col("link"), F.col("title"), F.col("source")).alias("key"),
        *[(F.col(n) if n in have else F.lit(None)).cast("string").alias(n) for n in _FIELDS], number("ord"), number("place"),
    )


def _land(spark: SparkSession, raw_dir: str, rows: DataFrame, whole: bool) -> DataFrame:
    """Write `rows` as the next landing and enter it; returns its entries, one per folder. Inside a
    folder rows go from the latest to the earliest publication; the range partitioning lets a
    crowded topic fill several files in that order."""
    entered = children(spark, f"{raw_dir}/{CATALOGUE}")
    landing = max(map(int, entered), default=0) + 1
    folder = f"{raw_dir}/landing={landing}"
    latest_first = [F.coalesce("published_at", F.lit("")).desc(), F.desc("key")]
    (
        rows.repartitionByRange(*PARTITIONS, *latest_first)
        .sortWithinPartitions(*PARTITIONS, *latest_first)
        .write.mode("overwrite")  # what a landing that was not entered left behind
        .partitionBy(*PARTITIONS)
        .json(folder)
    )
    written = spark.read.schema(_READ).json(folder).groupBy(*PARTITIONS).agg(F.count("*").alias("n"))
    entries = [(landing, r["date"], r["topic_slug"], r["n"], whole) for r in written.collect()]
    if entries:  # one file, there as a whole or not at all
        spark.createDataFrame(entries, ENTRY).coalesce(1).write.json(f"{raw_dir}/{CATALOGUE}/{landing:012d}")
    return spark.createDataFrame(entries, ENTRY)


def write_partitions(spark: SparkSession, raw_dir: str, records: DataFrame) -> DataFrame:
    """Land records in their days and return (date, topic, n) of the (date, topic) folders that occur
    in them, with what landed there before.

    `records` carries the run date as text in `date` and, to order its copies, `ord`. A version that
    has landed before stays; landing the same records again changes nothing that is read."""
    landed = _land(spark, raw_dir, _first(_keyed(records), "ord"), whole=False)
    days = {r["date"] for r in landed.select("date").distinct().collect()}
    stored = _latest_merged(spark, raw_dir, days).join(F.broadcast(landed.select(*PARTITIONS)), PARTITIONS, "left_semi")
    return stored.groupBy("date", "topic").agg(F.count("*").alias("n"))


def compact(spark: SparkSession, raw_dir: str) -> None:
    """Write the days that lie in several landings as one landing of their merged versions."""
    _, several = _folders(spark, raw_dir, None)
    if several:
        rows = _first(_read(spark, raw_dir, several), "landing")
        _land(spark, raw_dir, rows, whole=True)


def repair(spark: SparkSession, raw_dir: str) -> None:
    """Bring folders and catalogue together from one listing: landings that were never entered and
    landings of which nothing is read go, and folders `date=` that others put here are landed."""
    names = children(spark, raw_dir)
    needed = {f"landing={r['landing']}" for r in catalogue(spark, raw_dir).select("landing").distinct().collect()}
    for name in names:
        if name.startswith("landing=") and name not in needed:
            remove(spark, f"{raw_dir}/{name}")
    foreign = sorted(n for n in names if n.startswith("date="))
    if foreign:
        schema = ", ".join(f"{name} string" for name in _COLUMNS)
        with scratch(spark) as store:
            given = spark.read.schema(schema).option("basePath", raw_dir).json([f"{raw_dir}/{n}" for n in foreign])
            write_partitions(spark, raw_dir, store(dated(given)))
        for name in foreign:
            remove(spark, f"{raw_dir}/{name}")
