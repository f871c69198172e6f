"""History tables as versions of sorted Parquet, a folder for each month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.functions.quality import RULES, low_quality_reason, rules_name
from tidings.operators.sightings import upsert
from tidings.schemas import HEADLINES, SENTIMENT
from tidings.session import scratch
from tidings.sources import directory
from tidings.sources.files import exists
from tidings.sources.snapshots import Snapshot, commit, current, tidy, write_snap

TABLES = {"headlines": HEADLINES, "sentiment": SENTIMENT}
# what a month is made of, and the order of rows inside it
MONTH_OF = {"headlines": "first_run_date", "sentiment": "scored_at"}
SORT_BY = {
    # by the day last seen: what an edition shows lies together in every month, and the row groups
    # of stories that ended before are skipped by their statistics
    "headlines": ["last_run_date", "first_run_date", "topic", "headline_id"],
    "sentiment": ["scored_at", "headline_id", "model"],
}


SPANS = "topic string, first_run_date date, last_run_date date, n long, hidden long"


def month_column(table: str) -> Column:
    return F.date_format(MONTH_OF[table], "yyyy-MM")


def _root(history_dir: str, table: str) -> str:
    return f"{history_dir.rstrip('/')}/{table}"


def _read(spark: SparkSession, table: str, snapshot: Snapshot, months: set[str] | None = None) -> DataFrame:
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in TABLES[table])}, month string"
    folders = snapshot.folders(months)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", snapshot.data).parquet(*folders).drop("snap")


def read_table(spark: SparkSession, history_dir: str, table: str, months: set[str] | None = None) -> DataFrame:
    """The newest version of a history table, or the given months of it, with its `month` folder
    column; empty when nothing is stored. Columns go by name. Filters on `month` prune folders."""
    return _read(spark, table, current(spark, _root(history_dir, table)), months)


def stories(spark: SparkSession, history_dir: str, table: str, ids: DataFrame) -> DataFrame:
    """The rows of the stories in `ids` (headline_id). Reads the months that the directory names."""
    snapshot = current(spark, _root(history_dir, table))
    months = directory.months_of(spark, snapshot.key_folder, ids)
    return _read(spark, table, snapshot, months).join(ids.select("headline_id").distinct(), "headline_id", "left_semi")


def within(frame: DataFrame, first_day, last_day) -> DataFrame:
    """Headlines first seen between two dates, with the month range stated as well, so that
    other months are not listed or read."""
    return frame.filter(
        F.col("month").between(str(first_day)[:7], str(last_day)[:7])
        & F.col("first_run_date").between(F.to_date(F.lit(str(first_day))), F.to_date(F.lit(str(last_day))))
    )


def load_history(spark: SparkSession, history_dir: str) -> dict[str, DataFrame]:
    return {
        table: read_table(spark, history_dir, table).select(*schema.fieldNames())
        for table, schema in TABLES.items()
    }


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n) of several frames. Parquet answers a bare count from its footers."""
    out = None
    for name, frame in tables.items():
        part = frame.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def count_files(spark: SparkSession, history_dir: str) -> int:
    """Parquet files of the newest version."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    total = 0
    for table in TABLES:
        folders = current(spark, _root(history_dir, table)).folders()
        total += files.load(folders).select("length").count() if folders else 0  # contents are not read
    return total


def _with_month(frame: DataFrame, table: str) -> DataFrame:
    return frame.select(*TABLES[table].fieldNames()).withColumn("month", month_column(table))


def export_table(frame: DataFrame, history_dir: str, table: str) -> None:
    """Replace a whole history table by one new version, which months that no longer occur are not
    part of. `frame` may read the version before."""
    spark, before = frame.sparkSession, current(frame.sparkSession, _root(history_dir, table))
    after = Snapshot(before.root, before.version)  # a new generation of the directory
    pairs = write_snap(_with_month(frame, table), after, SORT_BY[table])
    written = Snapshot(after.root, after.version, tuple(pairs), after.keys)
    directory.add(spark, after.key_folder, _read(spark, table, written), known=False)
    commit(spark, before, pairs, after.keys)


def export_history(tables: dict[str, DataFrame], history_dir: str) -> None:
    for table, frame in tables.items():
        export_table(frame, history_dir, table)


def compact(spark: SparkSession, history_dir: str, table: str) -> None:
    """Rewrite the months that lie in several snaps, and the directory without repeated and stale
    entries, as one new version, and remove what it does not name."""
    before = current(spark, _root(history_dir, table))
    many = {m for m in before.months() if len(before.folders({m})) > 1}
    pairs = [p for p in before.pairs if p[0] not in many]
    pairs += write_snap(_read(spark, table, before, many), before, SORT_BY[table]) if many else []
    after = Snapshot(before.root, before.version, tuple(pairs))
    directory.add(spark, after.key_folder, _read(spark, table, after), known=False)
    commit(spark, before, pairs, after.keys)
    tidy(spark, before.root)


def _months(frame: DataFrame) -> set[str]:
    """Distinct months, a list as long as the history has months."""
    return {row["month"] for row in frame.select("month").distinct().collect()}


def upsert_months(spark: SparkSession, history_dir: str, batch: DataFrame) -> set[str]:
    """Load one collapsed batch into the stored headlines, rewriting only the months it touches, as
    one new version. Returns the rewritten months.

    The directory names the months that may hold the batch's stories; others are not opened. A late
    sighting can move a row to an earlier month; both months are rewritten."""
    before = current(spark, _root(history_dir, "headlines"))
    with scratch(spark) as store:
        batch = store(batch.withColumn("month", month_column("headlines")))
        ids = batch.select("headline_id").distinct()
        touched = directory.months_of(spark, before.key_folder, ids) | _months(batch)
        if not touched:
            return set()
        merged = store(_with_month(upsert(_read(spark, "headlines", before, touched), batch), "headlines"))
        pairs = write_snap(merged, before, SORT_BY["headlines"])
        directory.add(spark, before.key_folder, merged.join(ids, "headline_id", "left_semi"))
        commit(spark, before, [p for p in before.pairs if p[0] not in touched] + pairs)
    return touched


def _live(snapshot: Snapshot) -> Column:
    """Whether `month` still lies in `snap`: it can have moved on to another."""
    return F.concat_ws("/", "month", "snap").isin(*[f"{m}/{s}" for m, s in snapshot.pairs])


def flagged_titles(spark: SparkSession, history_dir: str, rules=RULES, snapshot: Snapshot | None = None) -> DataFrame:
    """headline_id, reason of the stored stories a rule flags, as `quality.flagged_stories` gives it.

    What the rules say about a snap is stored beside it, under a name made of the rules, as snaps
    never change: only titles of new snaps meet the patterns, and other rules begin anew."""
    snapshot = snapshot or current(spark, _root(history_dir, "headlines"))
    folder = f"{snapshot.root}/flags/{rules_name(rules)}"
    for snap in sorted({s for _, s in snapshot.pairs}):
        place = f"{folder}/snap={snap}"
        if not exists(spark, f"{place}/_SUCCESS"):
            held = spark.read.schema("headline_id string, title string, month string").parquet(f"{snapshot.data}/snap={snap}")
            failing = held.withColumn("reason", low_quality_reason(F.col("title"), rules)).filter("reason IS NOT NULL")
            failing.write.mode("overwrite").parquet(place)
    if not snapshot.pairs:
        return spark.createDataFrame([], "headline_id string, reason string")
    flags = spark.read.schema("headline_id string, title string, month string, reason string, snap string").option("basePath", folder).parquet(
        *sorted({f"{folder}/snap={s}" for _, s in snapshot.pairs}))
    return flags.filter(_live(snapshot)).groupBy("headline_id").agg(F.min_by("reason", "title").alias("reason"))


def span_counts(spark: SparkSession, history_dir: str, rules=RULES) -> DataFrame:
    """(topic, first_run_date, last_run_date, n, hidden): the stored rows counted, good ones as `n`.

    The counts of a snap are stored beside it, so only new snaps are read. What an upsert moves or
    changes needs no subtraction: it rewrites every month that holds a story of its batch, and with
    the old snap its counts no longer count. For the same reason counts of older snaps stay right when
    a batch brings a story its first failing title: all rows of that story lie in the new snap."""
    snapshot = current(spark, _root(history_dir, "headlines"))
    folder, schema = f"{snapshot.root}/counts/{rules_name(rules)}", f"month string, {SPANS}, snap string"
    missing = [s for s in sorted({s for _, s in snapshot.pairs}) if not exists(spark, f"{folder}/snap={s}/_SUCCESS")]
    flagged = flagged_titles(spark, history_dir, rules, snapshot).select("headline_id", F.lit(True).alias("flagged")) if missing else None
    for snap in missing:
        held = spark.read.schema("headline_id string, topic string, first_run_date date, last_run_date date, month string").parquet(
            f"{snapshot.data}/snap={snap}")
        held.join(flagged, "headline_id", "left").groupBy("month", "topic", "first_run_date", "last_run_date").agg(
            F.count_if(F.col("flagged").isNull()).alias("n"), F.count_if("flagged").alias("hidden"),
        ).write.mode("overwrite").parquet(f"{folder}/snap={snap}")
    if not snapshot.pairs:
        return spark.createDataFrame([], SPANS)
    counts = spark.read.schema(schema).option("basePath", folder).parquet(*sorted({f"{folder}/snap={s}" for _, s in snapshot.pairs}))
    return counts.filter(_live(snapshot)).groupBy("topic", "first_run_date", "last_run_date").agg(
        F.sum("n").alias("n"), F.sum("hidden").alias("hidden"))


def unscored(spark: SparkSession, history_dir: str, keys: DataFrame) -> DataFrame:
    """The (headline_id, model) of `keys` without a stored score."""
    key = ["headline_id", "model"]
    return keys.select(*key).join(stories(spark, history_dir, "sentiment", keys).select(*key), key, "left_anti")


def append_sentiment(spark: SparkSession, history_dir: str, scored: DataFrame) -> None:
    """Add new scores as one new version; existing files stay as they are. A second score of a
    story by one model is an error, found before anything is written. Only keys of the new rows are
    looked up, in the months the directory names."""
    before = current(spark, _root(history_dir, "sentiment"))
    with scratch(spark) as store:
        scored = store(_with_month(scored, "sentiment"))
        key = ["headline_id", "model"]
        twice = scored.groupBy(*key).count().filter("count > 1").select(*key)
        known = stories(spark, history_dir, "sentiment", scored).select(*key).join(scored.select(*key), key, "left_semi")
        clash = twice.unionByName(known).first()
        if clash is not None:
            raise ValueError(f"story scored twice: {clash['headline_id']} {clash['model']}")
        pairs = write_snap(scored, before, SORT_BY["sentiment"])
        directory.add(spark, before.key_folder, scored)
        commit(spark, before, [*before.pairs, *pairs])
