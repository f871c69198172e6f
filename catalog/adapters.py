"""The given tables as inputs of the operators.

Every event is one sighting of a story; its user and the number in `props` name the story. The
same definitions stand once as Spark columns and once as SQL for the comparison. Text that both
sides share (titles, links) is one SQL expression over story_no, s, k and topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.functions.labels import label_from_score
from tidings.operators import quality, sightings
from tidings.session import configure, own_folder, scratch, shared_folder
from tidings.sources import files, history
from tidings.sources.feeds import FEED

# configured topics: three that occur, out of order, and one that does not
TOPICS = (("view", "page view"), ("purchase", "buy"), ("click", "link click"), ("podcast", "audio"))
MODEL_A, MODEL_B = "vader", "finbert"

TITLE = """CASE story_no % 20
  WHEN 0 THEN 'Are Investors Undervaluing Company ' || s || ' (CO) Right Now?'
  WHEN 1 THEN 'Company ' || s || ' Stock Quote Price and Forecast'
  WHEN 2 THEN 'symbol__' || s || ' update'
  WHEN 3 THEN 'Widget ' || s || ' Market worth $2 billion by 2031 | Acme Research'
  WHEN 4 THEN 'Firm ' || s || ' stock price today: shares fall after the delivery miss'
  WHEN 5 THEN 'AI chip ' || s || ' market to reach $500 billion by 2030 | Reuters'
  WHEN 6 THEN 'Firm ' || s || ' vs. NFLX: Which Stock Is the Better Value Option?'
  WHEN 7 THEN 'Price of {{ticker}} ' || s
  WHEN 8 THEN 'Opinion | Story ' || s || ' - a second look at profits'
  WHEN 9 THEN '   '
  WHEN 10 THEN CASE WHEN k % 2 = 0 THEN 'Story ' || s || ' gains on upbeat results'
                    ELSE 'STORY  ' || s || '  GAINS ON UPBEAT RESULTS' END
  WHEN 11 THEN 'Story ' || s || ' warns of losses and layoffs'
  WHEN 12 THEN CASE WHEN topic = 'error' THEN 'Is Firm ' || s || ' (FRM) Stock Undervalued Right Now?'
                    ELSE 'Firm ' || s || ' holds annual meeting' END
  WHEN 13 THEN 'Story ' || s || ' update ' || CAST(k AS STRING)
  WHEN 14 THEN 'Is Firm ' || s || ' (NYSE:FRM) Outperforming Other Energy Stocks This Year?'
  WHEN 15 THEN 'Council ' || s || ' opens a bridge'
  WHEN 16 THEN 'Plain story ' || s
  WHEN 17 THEN 'Tesla story ' || s || ' rallies as markets surge'
  WHEN 18 THEN 'Energy fund ' || s || ' slides on weak demand'
  ELSE 'Council ' || s || ' publishes calendar' END"""
SOURCE = """CASE WHEN story_no % 20 IN (3, 18) THEN NULL
  ELSE 'src' || CAST(story_no % 17 AS STRING) END"""
# copies of a story differ in tracking noise only; two kinds of story have no usable link
LINK = """CASE
  WHEN story_no % 20 IN (10, 16) THEN CASE WHEN k % 2 = 0 THEN '' ELSE '#' END
  WHEN k % 4 = 0 THEN 'https://www.example.com/news/' || s || '?id=' || s || '&utm_source=' || CAST(k AS STRING)
  WHEN k % 4 = 1 THEN 'http://EXAMPLE.com/news/' || s || '/?utm_medium=' || CAST(k AS STRING) || '&id=' || s || '#top'
  WHEN k % 4 = 2 THEN 'https://example.com/news/' || s || '?oc=' || CAST(k AS STRING) || '&id=' || s
  ELSE 'HTTPS://www.Example.com/news/' || s || '//?ref=x&id=' || s || '&UTM_campaign=y' END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ord, ts, topic, k, story_no, s) per event."""
    k = F.get_json_object("props", "$.k").cast("long")
    story_no = F.col("user_id") * 10 + F.col("k") % 10
    return (
        table(spark, sf_dir, "events")
        # the file is one row group: dealt out, so that parsing and keys use every core
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "event_id")
        .select(F.col("event_id").alias("ord"), "ts", F.col("event_type").alias("topic"),
                "user_id", k.alias("k"))
        .withColumn("story_no", story_no)
        .withColumn("s", F.col("story_no").cast("string"))
        .drop("user_id")
    )


def iso(ts) -> F.Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def minutes(count) -> F.Column:
    return F.make_dt_interval(mins=count.cast("int"))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text records with `ord` and the event's `k`."""
    return events(spark, sf_dir).select(
        "ord", "k", "topic",
        F.expr(TITLE).alias("title"), F.expr(SOURCE).alias("source"), F.expr(LINK).alias("link"),
        F.when(F.col("k") != 0, iso(F.col("ts") - minutes(F.col("k")))).alias("published_at"),
        iso(F.col("ts")).alias("collected_at"),
        F.date_format("ts", "yyyy-MM-dd").alias("run_date"),
    )


def typed_sightings(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return sightings.normalize(raw_records(spark, sf_dir), keep)


def fresh_headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headlines table worked out from the events."""
    return sightings.collapse(typed_sightings(spark, sf_dir))


_STORES: dict[tuple[str, str], str] = {}


def stored_history(spark: SparkSession, sf_dir: str, renew: bool = False) -> str:
    """Folder with the history tables of `sf_dir`, written on first use in a session. Analytics
    read the stored history, as they would in production."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if renew or key not in _STORES or not files.exists(spark, _STORES[key]):
        folder = shared_folder(spark, "history")
        export_fresh(spark, sf_dir, folder)
        _STORES[key] = folder
    return _STORES[key]


def export_fresh(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Both history tables worked out from the events, whose keys and times are worked out once."""
    with scratch(spark) as store:
        typed = store(typed_sightings(spark, sf_dir, ("k",)))
        history.export_history({"headlines": sightings.collapse(typed), "sentiment": _made_scores(typed)}, folder)


def headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.load_history(spark, stored_history(spark, sf_dir))["headlines"]


def sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.load_history(spark, stored_history(spark, sf_dir))["sentiment"]


def good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.good_headlines(headlines(spark, sf_dir))


def fresh_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of two models per story; the second model has seen only stories filed under
    `purchase` at least once."""
    return _made_scores(typed_sightings(spark, sf_dir, ("k",)))


def _made_scores(typed: DataFrame) -> DataFrame:
    story = (
        typed.groupBy("headline_id")
        .agg(
            F.sum("k").alias("k"),
            F.count_if(F.col("topic") == "purchase").alias("purchases"),
            F.max("collected_at").alias("scored_at"),
        )
    )
    a = ((F.col("k") * 37) % 201 - 100).cast("double") / 101
    b = ((F.col("k") * 53 + 7) % 201 - 100).cast("double") / 101
    return (
        story.select(
            "headline_id", "scored_at",
            F.inline(
                F.array(
                    F.struct(F.lit(MODEL_A).alias("model"), a.alias("score"), F.lit(True).alias("has")),
                    F.struct(F.lit(MODEL_B).alias("model"), b.alias("score"),
                             (F.col("purchases") > 0).alias("has")),
                )
            ),
        )
        .filter("has")
        .select("headline_id", "model", label_from_score(F.col("score")).alias("label"), "score", "scored_at")
    )


def rater_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two 0/1 raters of documents: label_a, label_b, lang, source."""
    rated = table(spark, sf_dir, "labels").join(
        table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), "doc_id"
    )
    return rated.select(
        "doc_id", "lang", "source",
        F.col("quality").cast("string").alias("label_a"), F.col("toxic").cast("string").alias("label_b"),
    )


def _escaped(text) -> F.Column:
    return F.replace(text, F.lit("&"), F.lit("&amp;"))


def feed_documents(spark: SparkSession, sf_dir: str, past_day: bool = False) -> DataFrame:
    """One feed document per event: a single item. Dates come with two zones, some are missing
    and some are two days old; with `past_day` every date lies on the day before."""
    raw = events(spark, sf_dir).select(
        "*", F.expr(TITLE).alias("title"), F.expr(SOURCE).alias("source"), F.expr(LINK).alias("link")
    )
    day = F.make_dt_interval(F.lit(1))
    at = (
        F.col("ts") - day if past_day
        else F.when(F.col("k") % 10 == 7, F.col("ts") - day - day).otherwise(F.col("ts") - minutes(F.col("k")))
    )
    mail = "EEE, dd MMM yyyy HH:mm:ss"
    stamp = (
        F.when(F.col("k") == 0, F.lit("not a date"))
        .when(F.col("k") % 4 == 1, F.concat(F.date_format(at + F.make_dt_interval(hours=F.lit(2)), mail), F.lit(" +0200")))
        .otherwise(F.concat(F.date_format(at, mail), F.lit(" GMT")))
    )
    named = F.concat(F.lit('<source url="https://example.com">'), F.col("source"), F.lit("</source>"))
    item = F.concat(
        F.lit("<rss><channel><item><title>"), F.col("title"), F.lit(" - "),
        F.coalesce("source", F.lit("Agency")), F.lit("</title><link>"), _escaped(F.col("link")),
        F.lit("</link><pubDate>"), stamp, F.lit("</pubDate>"), F.coalesce(named, F.lit("")),
        F.lit("</item></channel></rss>"),
    )
    return raw.select(
        # a plain date, not by way of text: a filter on the day meets every event
        *[F.to_date("ts").alias(n) if n == "run_date" else F.col(n) for n in FEED],
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("collected_at"),
        "ord", item.alias("content"),
    )


def run_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run dates that have feed documents, told apart where the events are read."""
    return table(spark, sf_dir, "events").select(F.to_date("ts").alias("run_date")).distinct()


def long_feeds(spark: SparkSession, sf_dir: str, past_day: bool = False) -> DataFrame:
    """Feed documents of up to 64 items in the order of `ord`, collected at the start of their day,
    with bare ampersands and `&nbsp;`. Every seventh item is broken. A feed of the topic `podcast`
    has no items on any day."""
    single = feed_documents(spark, sf_dir, past_day)
    item = F.replace(F.regexp_extract("content", "(?s)<item>.*</item>", 0), F.lit("&amp;"), F.lit("&"))
    item = F.replace(item, F.lit("</title>"), F.lit("&nbsp;</title>"))
    item = F.when(F.col("ord") % 7 == 0, F.lit("<item><title>Cut <b></title></item>")).otherwise(item)
    full = single.groupBy("run_date", "topic", F.floor(F.col("ord") / 64).alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("ord", item.alias("item")))).alias("items")
    ).select("run_date", "topic", "part", F.array_join(F.transform("items", lambda i: i["item"]), "\n").alias("body"))
    bare = single.select("run_date", F.lit("podcast").alias("topic"), F.lit(0).cast("long").alias("part"), F.lit("").alias("body")).distinct()
    return full.unionByName(bare).select(
        "run_date", "topic", "part", F.col("run_date").cast("timestamp_ntz").alias("collected_at"),
        F.concat(F.lit("<rss><channel>"), "body", F.lit("</channel></rss>")).alias("content"),
    )


