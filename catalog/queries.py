"""Registered queries: each operator over the given tables, next to the SQL it must equal.

Dates and times are returned as text and averages to four digits, so both engines print alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import adapters as A
from catalog.oracle import ISO, MODEL_A, MODEL_B, label_case, reason_case, sql
from tidings.functions import labels, links, quality as quality_functions, text, times
from tidings.operators import activity, agreement, dimensions, editions, quality, scoring, sightings
from tidings.plans import jobs, reports, views
from tidings.session import shared_folder
from tidings.sources import documents, feeds, files, history, raw
from tidings.streaming import jobs as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if oracle:
            ORACLES[function.__name__] = oracle
        return function

    return register


def plain(frame: DataFrame) -> DataFrame:
    """Dates and timestamps as text."""
    kinds = {name for name, kind in frame.dtypes if kind in ("date", "timestamp", "timestamp_ntz")}
    return frame.select(
        *[F.col(f"`{n}`").cast("string").alias(n) if n in kinds else F.col(f"`{n}`") for n in frame.columns]
    )


def rounded(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({name: F.round(name, 4) for name in names})


HEAD = """headline_id, topic, title, source, link, CAST(published_at AS VARCHAR) AS published_at,
  CAST(first_seen_at AS VARCHAR) AS first_seen_at, CAST(last_seen_at AS VARCHAR) AS last_seen_at,
  CAST(first_run_date AS VARCHAR) AS first_run_date, CAST(last_run_date AS VARCHAR) AS last_run_date"""


# ---------------------------------------------------------------- sources and sinks

_RECORD = """run_date, topic, title, source, link, strftime(published, {iso}) AS published_at,
  strftime(collected_at, {iso}) AS collected_at, place""".format(iso=ISO)


@query(sql(f"SELECT {_RECORD} FROM feedtop", "feedtop"))
def feed_parse(spark, sf):
    records, _ = feeds.parse_feed(A.feed_documents(spark, sf), order=["ord"])
    return records.withColumn("place", F.col("place").cast("long"))


@query(sql("""SELECT run_date, topic, count(*) AS items,
  count(*) FILTER (WHERE NOT outside AND reason IS NOT NULL) AS low_quality,
  count(*) FILTER (WHERE outside) AS outside_window, CAST(0 AS BIGINT) AS unparsed FROM feed GROUP BY run_date, topic""", "feed"))
def feed_drop_counts(spark, sf):
    _, drops = feeds.parse_feed(A.feed_documents(spark, sf), order=["ord"])
    return plain(drops)


# the same items in long documents: collected at the start of the day, every seventh broken
_LONG = """SELECT * REPLACE (CAST(run_date AS TIMESTAMP) AS collected_at,
    published IS NOT NULL AND published < CAST(run_date AS TIMESTAMP) - INTERVAL 1 day AS outside), ord % 7 = 0 AS broken FROM feed"""


@query(sql(f"""SELECT run_date, topic, count(*) AS items, count(*) FILTER (WHERE NOT broken AND NOT outside AND reason IS NOT NULL) AS low_quality,
  count(*) FILTER (WHERE NOT broken AND outside) AS outside_window, count(*) FILTER (WHERE broken) AS unparsed
  FROM ({_LONG}) GROUP BY run_date, topic
  UNION ALL SELECT DISTINCT run_date, 'podcast', 0, 0, 0, 0 FROM feed""", "feed"))
def feed_malformed(spark, sf):
    """Drop counts of long feeds that are not well-formed, with feeds without items."""
    _, drops = feeds.parse_feed(A.long_feeds(spark, sf), order=["part"])
    return plain(drops)


@query(sql("""SELECT ord, i AS position, i = 2 AS unparsed, CASE i WHEN 0 THEN 'Caf\u00e9 ' || s || '\u2019s day & night' WHEN 1 THEN 'A </item> in ' || s
  WHEN 3 THEN 'Last ' || s END AS title FROM st, (SELECT unnest(range(4)) AS i)""", "st"))
def feed_repaired(spark, sf):
    """Items of feeds with entities of HTML, tags in CDATA and comments, and an item that is never closed."""
    told = lambda title: f"<item><title>{title}</title><link>https://e.com/{{}}</link></item>"
    body = "<rss><channel><!-- " + told("Hidden") + " -->" + told("Caf&eacute; {}&rsquo;s day &amp; night") + told("<![CDATA[A </item> in {}]]>") + \
        told("Cut {}").replace("</item>", "") + told("Last {}") + "</channel></rss>"
    parts = body.split("{}")
    content = F.concat(*[x for p in parts for x in (F.lit(p), F.col("s"))][:-1])
    items = feeds.feed_items(A.events(spark, sf).select("ord", content.alias("content")), ["ord"])
    return items.select("ord", F.col("position").cast("long"), "unparsed", F.when(~F.col("unparsed"), F.col("raw_title")).alias("title"))


@query(sql(f"""SELECT {_RECORD} FROM (SELECT *, row_number() OVER (PARTITION BY run_date, topic ORDER BY published DESC NULLS LAST, ord) AS place FROM (
  SELECT * FROM ({_LONG}) WHERE reason IS NULL AND NOT outside AND NOT broken
  QUALIFY row_number() OVER (PARTITION BY run_date, topic, headline_id ORDER BY published DESC NULLS LAST, ord) = 1) QUALIFY place <= 8)""", "feed"))
def feed_item_order(spark, sf):
    """Records of long feeds; items of one time keep the order of their feed."""
    records, _ = feeds.parse_feed(A.long_feeds(spark, sf), order=["part"])
    return records.withColumn("place", F.col("place").cast("long"))


def _landed(spark, sf, records=None) -> jobs.Paths:
    """The records landed as raw partitions in a new folder."""
    paths = jobs.Paths(shared_folder(spark, "catalog"))
    records = A.raw_records(spark, sf) if records is None else records
    raw.write_partitions(spark, paths.raw, records.withColumn("date", F.col("run_date")))
    return paths


# records of a day's topic with one version per key
_FIRST = """SELECT run_date AS date, topic AS topic_slug, topic, title, source, link, published_at, collected_at, run_date
  FROM raw JOIN (SELECT ord, headline_id FROM typed) USING (ord)
  QUALIFY row_number() OVER (PARTITION BY run_date, topic, headline_id ORDER BY {order}) = 1"""
_RAW_FIELDS = ["date", "topic_slug", "topic", "title", "source", "link", "published_at", "collected_at", "run_date"]


@query(sql(_FIRST.format(order="ord"), "raw", "typed"))
def raw_read_partition(spark, sf):
    paths = _landed(spark, sf)
    dates = [r["run_date"] for r in raw.partition_dates(spark, paths.raw).collect()]
    return raw.read_partition(spark, paths.raw, dates).select(*_RAW_FIELDS)


@query(sql("SELECT DISTINCT run_date FROM raw", "raw"))
def raw_partition_dates(spark, sf):
    return plain(raw.partition_dates(spark, _landed(spark, sf).raw))


@query(sql(_FIRST.format(order="substr(collected_at, 12, 2) >= '12', ord"), "raw", "typed"))
def raw_merge(spark, sf):
    """A morning run and a later run on the same days: stored versions stay."""
    records = A.raw_records(spark, sf).withColumn("date", F.col("run_date"))
    morning = F.substr("collected_at", F.lit(12), F.lit(2)) < "12"
    paths = _landed(spark, sf, records.filter(morning))
    raw.write_partitions(spark, paths.raw, records.filter(~morning))
    return raw.read_raw(spark, paths.raw).select(*_RAW_FIELDS)


def _stored(spark, sf) -> jobs.Paths:
    paths = jobs.Paths(shared_folder(spark, "catalog"))
    A.export_fresh(spark, sf, paths.history)
    return paths


@query(sql("""SELECT 'headlines' AS "table", count(*) AS n FROM head
  UNION ALL SELECT 'sentiment', count(*) FROM sent""", "head", "sent"))
def history_load_counts(spark, sf):
    return history.table_counts(history.load_history(spark, _stored(spark, sf).history))


@query(sql(f"SELECT {HEAD}, strftime(first_run_date, '%Y-%m') AS month FROM head", "head"))
def history_export_roundtrip(spark, sf):
    return plain(history.read_table(spark, _stored(spark, sf).history, "headlines"))


@query(sql(f"SELECT {HEAD} FROM head", "head"))
def history_upsert_months(spark, sf):
    """A stored span, then earlier and later sightings loaded on top, rewriting touched months."""
    paths = jobs.Paths(shared_folder(spark, "catalog"))
    typed = A.typed_sightings(spark, sf)
    history.export_table(sightings.collapse(typed.filter("run_date < '2024-01-16'")), paths.history, "headlines")
    history.upsert_months(spark, paths.history, sightings.collapse(typed.filter("run_date >= '2024-01-16'")))
    return plain(history.load_history(spark, paths.history)["headlines"])


@query(sql("""SELECT (SELECT count(DISTINCT strftime(first_run_date, '%Y-%m')) FROM head)
  + (SELECT count(DISTINCT strftime(scored_at, '%Y-%m')) FROM sent) AS months, true AS all_counted""", "head", "sent"))
def history_file_count(spark, sf):
    """Stored months of both tables, and whether every file that holds rows is counted."""
    folder = _stored(spark, sf).history
    held = None
    for name in history.TABLES:
        part = history.read_table(spark, folder, name).select(F.lit(name).alias("t"), "month", F.col("_metadata.file_path").alias("file"))
        held = part if held is None else held.unionByName(part)
    return held.agg(
        F.count_distinct("t", "month").alias("months"),
        (F.count_distinct("file") == history.count_files(spark, folder)).alias("all_counted"),
    )


# ---------------------------------------------------------------- projections and filters


@query(sql("""SELECT ord, CASE WHEN trim(title) = '' THEN '- ' || coalesce(source, 'Agency') ELSE trim(title) END AS title,
  coalesce(source, CASE WHEN ord % 2 = 0 THEN 'Agency' END, 'Unknown') AS source FROM raw""", "raw"))
def title_split(spark, sf):
    """Titles with the source appended; where no source is named every other title has none."""
    r = A.raw_records(spark, sf)
    suffix = F.when(
        F.col("source").isNotNull() | (F.col("ord") % 2 == 0),
        F.concat(F.lit(" - "), F.coalesce("source", F.lit("Agency"))),
    )
    full = F.concat(F.col("title"), F.coalesce(suffix, F.lit("")))
    return r.select("ord", text.split_title(full, F.col("source")).alias("t")).select("ord", "t.*")


_DOC_AT = """CASE WHEN k = 0 THEN NULL WHEN k % 10 = 7 THEN ts - INTERVAL 2 day ELSE ts - k * INTERVAL 1 minute END"""


def _dated_items(spark, sf) -> DataFrame:
    items = feeds.feed_items(A.feed_documents(spark, sf), ["ord", "collected_at", "run_date"])
    return items.withColumn("published", times.parse_published(F.col("pub_date")))


@query(sql(f"SELECT ord, strftime({_DOC_AT}, {ISO}) AS published_at FROM st", "st"))
def published_parse(spark, sf):
    return _dated_items(spark, sf).select("ord", times.to_iso(F.col("published")).alias("published_at"))


@query(sql(f"""SELECT ord, {_DOC_AT} IS NULL OR date_trunc('second', {_DOC_AT}) >= date_trunc('second', ts) - INTERVAL 1 day AS inside
  FROM st""", "st"))
def window_recent(spark, sf):
    inside = times.is_recent(F.col("published"), F.col("collected_at"))
    return _dated_items(spark, sf).select("ord", inside.alias("inside"))


@query(sql(f"""SELECT ord, {_DOC_AT} IS NOT NULL AND CAST({_DOC_AT} AS DATE) = CAST(ts AS DATE) AS inside FROM st""".replace(
    f"{_DOC_AT} IS NOT NULL AND", "k <> 0 AND"), "st"))
def window_utc_day(spark, sf):
    inside = times.on_utc_day(F.col("published"), F.col("run_date"))
    return _dated_items(spark, sf).select("ord", inside.alias("inside"))


@query(sql(f"SELECT ord, {reason_case('title')} AS reason FROM raw", "raw"))
def quality_reason(spark, sf):
    return A.raw_records(spark, sf).select(
        "ord", quality_functions.low_quality_reason(F.col("title")).alias("reason")
    )


@query(sql(f"SELECT ord, topic, title, {reason_case('title')} IS NULL AS kept FROM raw", "raw"))
def quality_split(spark, sf):
    kept, dropped = quality.split(A.raw_records(spark, sf).select("ord", "topic", "title"))
    return kept.withColumn("kept", F.lit(True)).unionByName(dropped.withColumn("kept", F.lit(False)))


@query(sql("SELECT title, source, link, place FROM edition WHERE topic = 'view'", "edition"))
def edition_topic(spark, sf):
    good = A.good(spark, sf)
    latest = reports.latest_report(good, A.sentiment(spark, sf), run_date=_last_day(good), topics=A.TOPICS)
    block = reports.edition_of_topic(latest, "VIEW")
    return block.select(F.posexplode("articles").alias("place", "a")).select(
        "a.title", F.nullif(F.col("a.source"), F.lit("Unknown")).alias("source"),
        F.nullif(F.col("a.link"), F.lit("")).alias("link"), (F.col("place") + 1).cast("long").alias("place"),
    )


@query(sql("""SELECT ord, headline_id, topic, title, source, link, CAST(published_at AS VARCHAR) AS published_at,
  CAST(collected_at AS VARCHAR) AS collected_at, CAST(run_date AS VARCHAR) AS run_date FROM typed""", "typed"))
def sightings_normalize(spark, sf):
    return plain(A.typed_sightings(spark, sf))


@query(sql(f"SELECT {_RECORD}, 'backfill' AS collection FROM feedtop", "feedtop"))
def raw_tag_collection(spark, sf):
    records, _ = feeds.parse_feed(
        A.feed_documents(spark, sf), order=["ord"], extra={"collection": "backfill", "topic": "ignored"}
    )
    return records.withColumn("place", F.col("place").cast("long"))


# ---------------------------------------------------------------- joins


@query(sql(f"SELECT {HEAD} FROM good", "good"))
def good_headlines(spark, sf):
    return plain(A.good(spark, sf))


_PENDING = f"""SELECT headline_id, min(title) AS title FROM good AS h
  WHERE NOT EXISTS (SELECT 1 FROM sent AS s WHERE s.headline_id = h.headline_id AND s.model = '{MODEL_B}')
  GROUP BY headline_id"""


@query(sql(_PENDING, "good", "sent"))
def pending_sentiment(spark, sf):
    return scoring.pending(A.good(spark, sf), A.sentiment(spark, sf), MODEL_B)


def _kept(frame: DataFrame) -> DataFrame:
    """`frame` as a written table, for inputs that are tables in production and read repeatedly."""
    folder = shared_folder(frame.sparkSession, "table")
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def _stored_and_batch(spark, sf):
    typed = A.typed_sightings(spark, sf)
    middle = F.col("run_date").between("2024-01-08", "2024-01-20")
    return _kept(sightings.collapse(typed.filter(middle))), _kept(sightings.collapse(typed.filter(~middle)))


@query(sql("""SELECT count(*) FILTER (WHERE s.topic IS NULL) AS inserted, count(s.topic) AS seen_again
  FROM batch AS b LEFT JOIN stored AS s USING (headline_id, topic)""", "stored", "batch"))
def upsert_counts(spark, sf):
    return sightings.upsert_counts(*_stored_and_batch(spark, sf))


@query(sql("""SELECT h.topic, CAST(h.first_run_date AS VARCHAR) AS day, s.model, count(*) AS n, round(avg(s.score), 4) AS avg,
  count(*) FILTER (WHERE s.label = 'positive') AS positive, count(*) FILTER (WHERE s.label = 'neutral') AS neutral,
  count(*) FILTER (WHERE s.label = 'negative') AS negative
  FROM good AS h JOIN sent AS s USING (headline_id) GROUP BY h.topic, h.first_run_date, s.model""", "good", "sent"))
def daily_sentiment(spark, sf):
    out = activity.daily_sentiment(A.good(spark, sf), A.sentiment(spark, sf), "1970-01-01", "9999-12-31")
    return plain(rounded(out, "avg"))


@query(sql("""SELECT headline_id, topic, title, source, link, CAST(last_run_date AS VARCHAR) AS last_run_date,
  label_a, score_a, label_b, score_b FROM paired""", "paired"))
def paired_scores(spark, sf):
    return plain(_paired(spark, sf))


def _paired(spark, sf):
    return agreement.paired_scores(A.good(spark, sf), A.sentiment(spark, sf), MODEL_A, MODEL_B)


def _story_pairs(spark, sf):
    return agreement.one_row_per_story(_paired(spark, sf), A.TOPICS)


@query(sql("""SELECT DISTINCT s.headline_id, s.model, s.label, s.score FROM sent AS s
  WHERE s.headline_id IN (SELECT headline_id FROM edition)""", "edition", "sent"))
def edition_scores(spark, sf):
    chosen = editions.edition(A.good(spark, sf))
    found = editions.scores_by_story(A.sentiment(spark, sf), chosen)
    return found.select("headline_id", F.explode("scores").alias("model", "s")).select("headline_id", "model", "s.*")


@query(sql("""SELECT model, count(*) AS n FROM sent WHERE headline_id IN (SELECT headline_id FROM good) GROUP BY model""",
           "good", "sent"))
def sentiment_counts(spark, sf):
    return activity.sentiment_counts(A.good(spark, sf), A.sentiment(spark, sf))


@query(sql("""SELECT c.topic, CAST(c.day AS VARCHAR) AS day, coalesce(n.n, 0) AS "count"
  FROM calendar AS c LEFT JOIN counts AS n USING (topic, day)""", "calendar", "counts"))
def trends_zero_fill(spark, sf):
    series = reports.trend_series(A.good(spark, sf), A.sentiment(spark, sf), topics=A.TOPICS)
    return plain(series.select("topic", "day", "count"))


_SIZES = """SELECT t.ord, t.topic, t.query,
  (SELECT count(*) FROM edition AS e WHERE e.topic = t.topic) AS edition,
  (SELECT count(*) FROM good AS g WHERE g.topic = t.topic) AS total FROM topics AS t"""


@query(sql(_SIZES, "topics", "edition", "good"))
def topic_totals_config(spark, sf):
    return reports.topic_sizes(A.good(spark, sf), topics=A.TOPICS)


@query(sql("""SELECT CAST(d AS VARCHAR) AS run_date FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2023-12-22', TIMESTAMP '2024-02-18', INTERVAL 1 day)) AS DATE) AS d)
  WHERE d NOT IN (SELECT CAST(ts AS DATE) FROM events)"""))
def backfill_missing_dates(spark, sf):
    landed = raw.partition_dates(spark, _landed(spark, sf).raw)
    return plain(dimensions.missing_dates(landed, "2024-02-19", 59))


# ---------------------------------------------------------------- aggregates


@query(sql("""SELECT topic, CAST(first_run_date AS VARCHAR) AS day, count(*) AS n FROM good GROUP BY ALL""", "good"))
def daily_counts(spark, sf):
    return plain(activity.daily_counts(A.good(spark, sf), "1970-01-01", "9999-12-31"))


@query(sql("SELECT topic, count(*) AS n FROM good GROUP BY topic", "good"))
def topic_totals(spark, sf):
    return activity.topic_totals(A.good(spark, sf))


@query(sql("""SELECT count(*) AS headlines, CAST(min(first_run_date) AS VARCHAR) AS first_run_date,
  CAST(max(last_run_date) AS VARCHAR) AS last_run_date, (SELECT count(*) FROM rundays) AS run_days FROM good""",
           "good", "rundays"))
def history_overview(spark, sf):
    return plain(activity.history_overview(A.good(spark, sf)))


@query(sql("SELECT CAST(run_date AS VARCHAR) AS run_date, new_headlines, seen_again FROM activity", "activity"))
def daily_activity(spark, sf):
    return plain(activity.daily_activity(A.good(spark, sf)))


@query(sql("""SELECT coalesce(source, 'Unknown') AS source, count(DISTINCT headline_id) AS n FROM good GROUP BY 1
  ORDER BY n DESC, source LIMIT 10""", "good"))
def top_sources(spark, sf):
    return activity.top_sources(A.good(spark, sf))


@query(sql("SELECT CAST(max(last_run_date) AS VARCHAR) AS run_date FROM good", "good"))
def latest_run_date(spark, sf):
    return plain(activity.latest_run_date(A.good(spark, sf)))


@query(sql("SELECT CAST(d AS VARCHAR) AS run_date FROM rundays", "rundays"))
def run_dates(spark, sf):
    return plain(activity.run_dates(A.good(spark, sf)))


@query(sql("SELECT headline_id, reason FROM lowq", "lowq"))
def low_quality_stories(spark, sf):
    return quality.flagged_stories(A.headlines(spark, sf))


@query(sql("SELECT (SELECT count(*) FROM head) - (SELECT count(*) FROM good) AS excluded_low_quality", "head", "good"))
def low_quality_rows(spark, sf):
    return quality.hidden_rows(A.headlines(spark, sf))


@query(sql(f"""SELECT (SELECT count(*) FROM typed WHERE run_date NOT BETWEEN DATE '2024-01-08' AND DATE '2024-01-20') AS raw_records,
  (SELECT count(*) FROM batch AS b WHERE NOT EXISTS (SELECT 1 FROM stored AS s WHERE s.headline_id = b.headline_id AND s.topic = b.topic)) AS inserted,
  (SELECT count(*) FROM (SELECT DISTINCT headline_id, topic, run_date FROM typed WHERE run_date NOT BETWEEN DATE '2024-01-08' AND DATE '2024-01-20'))
  - (SELECT count(*) FROM batch AS b WHERE NOT EXISTS (SELECT 1 FROM stored AS s WHERE s.headline_id = b.headline_id AND s.topic = b.topic)) AS seen_again,
  (SELECT count(*) FROM typed WHERE run_date NOT BETWEEN DATE '2024-01-08' AND DATE '2024-01-20' AND {reason_case('title')} IS NOT NULL) AS flagged""",
           "typed", "stored", "batch"))
def load_summary(spark, sf):
    typed = A.typed_sightings(spark, sf).withColumn("date", F.col("run_date"))
    middle = F.col("run_date").between("2024-01-08", "2024-01-20")
    return jobs.load_summary(sightings.collapse(typed.filter(middle)), typed.filter(~middle))


# ---------------------------------------------------------------- windows, sorts, top k


@query(sql(f"SELECT {HEAD} FROM head", "head"))
def batch_collapse(spark, sf):
    return plain(A.fresh_headlines(spark, sf))


@query(sql("""SELECT topic, headline_id, title, source, link, CAST(published_at AS VARCHAR) AS published_at, place FROM edition""",
           "edition"))
def edition_top_k(spark, sf):
    good = A.good(spark, sf)
    return plain(editions.edition(good, _last_day(good)).withColumn("place", F.col("place").cast("long")))


@query(sql("""SELECT CAST(run_date AS VARCHAR) AS run_date, topic, headline_id, ord,
  row_number() OVER (PARTITION BY run_date, topic ORDER BY published_at DESC NULLS LAST, ord) AS place
  FROM (SELECT * FROM typed QUALIFY row_number() OVER (PARTITION BY run_date, topic, headline_id ORDER BY published_at DESC NULLS LAST, ord) = 1)
  QUALIFY place <= 8""", "typed"))
def feed_dedup_cap(spark, sf):
    kept = editions.dedup_and_cap(A.typed_sightings(spark, sf), ["run_date", "topic"], position=["ord"])
    return plain(kept.select("run_date", "topic", "headline_id", "ord", F.col("place").cast("long").alias("place")))


@query(sql("SELECT headline_id, topic, title, label_a, label_b FROM stories", "stories"))
def story_primary_topic(spark, sf):
    return _story_pairs(spark, sf).select("headline_id", "topic", "title", "label_a", "label_b")


@query(sql("""SELECT headline_id, topic, CAST(last_run_date AS VARCHAR) AS last_run_date, label_a, score_a, label_b, score_b,
  round(score_b - score_a, 4) AS gap FROM stories WHERE label_a <> label_b
  ORDER BY stories.last_run_date DESC, abs(score_b - score_a) DESC, headline_id LIMIT 60""", "stories"))
def disagreements(spark, sf):
    return plain(
        agreement.disagreements(_story_pairs(spark, sf)).select(
            "headline_id", "topic", "last_run_date", "label_a", "score_a", "label_b", "score_b", "gap"
        )
    )


@query(sql("""SELECT headline_id, score_a AS a, score_b AS b, label_a = label_b AS same FROM stories
  ORDER BY headline_id LIMIT 2000""", "stories"))
def score_pairs_sample(spark, sf):
    return agreement.score_pairs(_story_pairs(spark, sf))


# ---------------------------------------------------------------- scalar functions

# page addresses in three spellings: as they are, with noise, and in capitals with a slash
_NOISY = """regexp_replace(url, '#.*$', '') || CASE WHEN strpos(url, '?') > 0 THEN '&' ELSE '?' END || 'zeta=1&Alpha=%7Ex+y&OC=9#frag'"""
_LOUD = """'HTTP://WWW.' || upper(regexp_extract(url, '^https?://([^/?#]+)', 1)) || regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) || '//'"""


@query(sql(f"""WITH u AS (SELECT page_id, 'plain' AS kind, url FROM pages UNION ALL SELECT page_id, 'noisy', {_NOISY} FROM pages
  UNION ALL SELECT page_id, 'loud', {_LOUD} FROM pages),
  p AS (SELECT page_id, kind, regexp_replace(lower(regexp_extract(url, '^(?i:https?)://([^/?#]+)', 1)), '^www\\.', '') AS host,
    rtrim(regexp_extract(url, '^(?i:https?)://[^/?#]+([^?#]*)', 1), '/') AS path,
    list_sort(list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda x: x <> ''
      AND NOT regexp_matches(x, '(?i)^(utm_[^=]*|oc|gclid|fbclid|mc_cid|mc_eid|cmpid|ref|ncid)='))) AS q FROM u)
  SELECT page_id, kind, 'https://' || host || CASE WHEN path = '' THEN '/' ELSE path END
    || CASE WHEN len(q) > 0 THEN '?' || replace(array_to_string(q, '&'), '%7E', '~') ELSE '' END AS link FROM p"""))
def link_normalize(spark, sf):
    pages = A.table(spark, sf, "pages")
    url = F.col("url")
    bare = F.regexp_replace(url, "#.*$", "")
    noisy = F.concat(bare, F.when(F.contains(url, F.lit("?")), "&").otherwise("?"), F.lit("zeta=1&Alpha=%7Ex+y&OC=9#frag"))
    loud = F.concat(
        F.lit("HTTP://WWW."), F.upper(F.regexp_extract(url, "^https?://([^/?#]+)", 1)),
        F.regexp_extract(url, "^https?://[^/?#]+([^?#]*)", 1), F.lit("//"),
    )
    spellings = F.create_map(F.lit("plain"), url, F.lit("noisy"), noisy, F.lit("loud"), loud)
    return pages.select("page_id", F.explode(spellings).alias("kind", "spelled")).select(
        "page_id", "kind", links.normalize_link(F.col("spelled")).alias("link")
    )


# sharp s expands in the caseless form
_NORM = "trim(regexp_replace(replace(lower({}), 'ß', 'ss'), '[\\s\\x0b\\x1c-\\x1f\\x85\\p{{Z}}]+', ' ', 'g'))"


@query(sql(f"SELECT doc_id, {_NORM.format('text')} AS text FROM documents"))
def text_normalize(spark, sf):
    return A.table(spark, sf, "documents").select("doc_id", text.normalize_text(F.col("text")).alias("text"))


@query(sql(f"""SELECT doc_id, substr(sha256('title:' || {_NORM.format('text')} || '|source:' || {_NORM.format('source')}), 1, 16) AS headline_id
  FROM documents"""))
def dedup_key(spark, sf):
    key = links.dedup_key(F.lit(None).cast("string"), F.col("text"), F.col("source"))
    return A.table(spark, sf, "documents").select("doc_id", key.alias("headline_id"))


@query(sql("""SELECT p_partkey, coalesce(nullif(trim(regexp_replace(lower(p_name || ' & ' || p_type), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'topic') AS slug
  FROM part"""))
def topic_slug(spark, sf):
    label = F.concat_ws(" & ", "p_name", "p_type")
    return A.table(spark, sf, "part").select("p_partkey", text.slug(label).alias("slug"))


@query(sql(f"""SELECT event_id, strftime(ts, {ISO}) AS iso, strftime(ts - INTERVAL 90 minute, {ISO}) AS shifted FROM events"""))
def iso_roundtrip(spark, sf):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    utc = times.to_iso(times.parse_iso(F.concat(stamp, F.lit("Z"))))
    shifted = times.to_iso(times.parse_iso(F.concat(stamp, F.lit("+01:30"))))
    return A.table(spark, sf, "events").select("event_id", utc.alias("iso"), shifted.alias("shifted"))


@query(sql("""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - 1 AS VARCHAR) AS day,
  'Yesterday, ' || strftime(CAST(o_orderdate AS DATE) - 1, '%b %d') AS label FROM orders"""))
def edition_label(spark, sf):
    day = F.to_date("o_orderdate")
    return plain(
        A.table(spark, sf, "orders").select(
            "o_orderkey", times.edition_day(day).alias("day"), times.edition_label(day).alias("label")
        )
    )


_SCORE_OF_K = "CAST((k * 37) % 201 - 100 AS DOUBLE) / 100"


@query(sql(f"""SELECT ord, CASE WHEN k = 0 THEN NULL ELSE {label_case(_SCORE_OF_K)} END AS label FROM ev""", "ev"))
def label_from_score(spark, sf):
    score = F.when(F.col("k") != 0, ((F.col("k") * 37) % 201 - 100).cast("double") / 100)
    return A.events(spark, sf).select("ord", labels.label_from_score(score).alias("label"))


# the largest and smallest component and the first one stand in for class probabilities
_PROBS = """list_max(e) AS pos, -list_min(e) AS neg, abs(e[1]) AS neu FROM
  (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"""
_FROM_PROBS = f"""SELECT vec_id, CASE WHEN pos >= neu AND pos >= neg THEN 'positive' WHEN neu >= neg THEN 'neutral' ELSE 'negative' END AS label,
  round(pos - neg, 4) AS score FROM (SELECT vec_id, {_PROBS})"""


def _class_columns(spark, sf) -> DataFrame:
    e = F.col("embedding").cast("array<double>")
    return A.table(spark, sf, "embeddings").select(
        "vec_id", F.array_max(e).alias("pos"), (-F.array_min(e)).alias("neg"), F.abs(F.get(e, F.lit(0))).alias("neu")
    )


@query(sql(_FROM_PROBS))
def label_from_probs(spark, sf):
    classes = F.array(
        *[F.struct(F.lit(n).alias("label"), F.col(c).alias("score")) for n, c in (("Positive", "pos"), ("neutral", "neu"), ("NEGATIVE", "neg"))]
    )
    return _class_columns(spark, sf).select("vec_id", labels.label_from_probs(classes).alias("s")).select("vec_id", "s.*")


@query(sql(f"""SELECT headline_id, CASE WHEN bool_or(model = '{MODEL_B}') THEN '{MODEL_B}' ELSE '{MODEL_A}' END AS model
  FROM sent GROUP BY headline_id""", "sent"))
def primary_model(spark, sf):
    available = A.sentiment(spark, sf).groupBy("headline_id").agg(F.collect_set("model").alias("models"))
    return available.select("headline_id", labels.primary_model(F.col("models")).alias("model"))


# ---------------------------------------------------------------- scorers


def _length_model():
    """Stand-in for an outside model: the score is read off the length of the text."""
    def score(texts):
        values = [(len(t) % 21 - 10) / 10 for t in texts]
        return [("positive" if v > 0 else "negative" if v < 0 else "neutral", v) for v in values]

    return score


_BY_LENGTH = """SELECT doc_id, CASE WHEN v > 0 THEN 'positive' WHEN v < 0 THEN 'negative' ELSE 'neutral' END AS label, v AS score
  FROM (SELECT doc_id, CAST(length(text) % 21 - 10 AS DOUBLE) / 10 AS v FROM documents)"""


@query(sql(_BY_LENGTH))
def score_pluggable(spark, sf):
    registry = scoring.ScorerRegistry(length=scoring.batch_scorer(_length_model))
    scorer = registry.choose(["length"])["length"]
    return A.table(spark, sf, "documents").select("doc_id", scorer(F.col("text")).alias("s")).select("doc_id", "s.*")


def _length_classes():
    def classify(texts):
        out = []
        for t in texts:
            p = (len(t) % 21) / 20
            out.append([{"label": "Positive", "score": p}, {"label": "neutral", "score": 0.4}, {"label": "negative", "score": 1 - p}])
        return out

    return classify


@query(sql("""SELECT doc_id, CASE WHEN p >= 0.4 AND p >= 1 - p THEN 'positive' WHEN 0.4 >= 1 - p THEN 'neutral' ELSE 'negative' END AS label,
  round(p - (1 - p), 4) AS score FROM (SELECT doc_id, CAST(length(text) % 21 AS DOUBLE) / 20 AS p FROM documents)"""))
def score_probs(spark, sf):
    scorer = scoring.probability_scorer(_length_classes)
    return A.table(spark, sf, "documents").select("doc_id", scorer(F.col("text")).alias("s")).select("doc_id", "s.*")


_WEIGHTS = ", ".join(f"('{w}', {v})" for w, v in scoring.LEXICON.items())


def _lexicon_sql(body: str, key: str) -> str:
    return f"""SELECT {key}, {label_case('score')} AS label, score FROM (
      SELECT {key}, round(total / sqrt(total * total + 15), 4) AS score FROM (
        SELECT t.{key}, coalesce(sum(CAST(w.weight AS DOUBLE)), 0) AS total FROM ({body}) AS t
        LEFT JOIN (SELECT {key}, unnest(regexp_extract_all(lower(txt), '[a-z]+')) AS word FROM ({body})) AS x USING ({key})
        LEFT JOIN (VALUES {_WEIGHTS}) AS w(word, weight) ON w.word = x.word GROUP BY t.{key}))"""


@query(_lexicon_sql("SELECT doc_id, text AS txt FROM documents", "doc_id"))
def score_lexicon(spark, sf):
    return A.table(spark, sf, "documents").select("doc_id", scoring.lexicon_score(F.col("text")).alias("s")).select("doc_id", "s.*")


@query(sql(f"SELECT headline_id, 'lexicon' AS model, label, score, '2024-02-01 00:00:00' AS scored_at FROM ("
           + _lexicon_sql("SELECT headline_id, min(title) AS txt FROM good GROUP BY headline_id", "headline_id") + ")", "good"))
def score_pending(spark, sf):
    scored = scoring.score_pending(
        A.good(spark, sf), A.sentiment(spark, sf), scoring.default_registry().choose(["lexicon"]), "2024-02-01T00:00:00Z"
    )
    return plain(scored)


@query(sql(f"""SELECT headline_id, model, label, score, CAST(scored_at AS VARCHAR) AS scored_at FROM sent
  UNION ALL SELECT headline_id, '{MODEL_B}', {label_case('score')}, score, '2024-02-01 00:00:00' FROM (
    SELECT headline_id, CAST(length(title) % 201 - 100 AS DOUBLE) / 100 AS score FROM ({_PENDING}))""", "sent", "good"))
def sentiment_append(spark, sf):
    def by_length(title):
        score = (F.length(title) % 201 - 100).cast("double") / 100
        return F.struct(labels.label_from_score(score).alias("label"), score.alias("score"))

    stored = A.sentiment(spark, sf)
    stories = scoring.pending(A.good(spark, sf), stored, MODEL_B)
    return plain(scoring.append_scores(stored, scoring.score_stories(stories, MODEL_B, by_length, "2024-02-01T00:00:00Z")))


# ---------------------------------------------------------------- agreement

_KAPPA = """WITH m AS (SELECT {by}, label, sum(a) AS a, sum(b) AS b, sum(h) AS h FROM (
    SELECT {by}, label_a AS label, 1 AS a, 0 AS b, CAST(label_a = label_b AS INT) AS h FROM raters
    UNION ALL SELECT {by}, label_b, 0, 1, 0 FROM raters) GROUP BY ALL),
  t AS (SELECT {by}, CAST(sum(a) AS BIGINT) AS n, CAST(sum(h) AS DOUBLE) AS h, CAST(sum(a * b) AS DOUBLE) AS e FROM m GROUP BY {by})"""


@query(sql("""SELECT lang, count(*) AS n, round(100 * avg(CAST(label_a = label_b AS DOUBLE)), 2) AS percent_agreement
  FROM raters GROUP BY lang""", "raters"))
def percent_agreement(spark, sf):
    cells = agreement.label_cells(A.rater_pairs(spark, sf), ("lang",))
    return agreement.label_agreement(cells, ("lang",)).drop("cohens_kappa")


@query("WITH raters AS (SELECT d.source, CAST(l.quality AS VARCHAR) AS label_a, CAST(l.toxic AS VARCHAR) AS label_b "
       "FROM labels AS l JOIN documents AS d USING (doc_id)), " + _KAPPA.format(by="source")[5:]
       + """ SELECT source, n, CASE WHEN e = CAST(n AS DOUBLE) * n THEN 1.0
         ELSE round((h / n - e / (CAST(n AS DOUBLE) * n)) / (1 - e / (CAST(n AS DOUBLE) * n)), 4) END AS cohens_kappa FROM t""")
def cohens_kappa(spark, sf):
    cells = agreement.label_cells(A.rater_pairs(spark, sf), ("source",))
    return agreement.label_agreement(cells, ("source",)).drop("percent_agreement")


@query(sql("SELECT label_a, label_b, n FROM matrix", "matrix"))
def confusion_matrix(spark, sf):
    cells = agreement.label_cells(_story_pairs(spark, sf))
    return agreement.confusion_matrix(cells).select("label_a", "label_b", "n")


@query(sql("SELECT round(corr(score_a, score_b), 4) AS score_correlation FROM stories", "stories"))
def score_correlation(spark, sf):
    return agreement.score_correlation(_story_pairs(spark, sf))


_BY_TOPIC = """m AS (SELECT topic, label, sum(a) AS a, sum(b) AS b, sum(h) AS h FROM (
    SELECT topic, label_a AS label, 1 AS a, 0 AS b, CAST(label_a = label_b AS INT) AS h FROM paired
    UNION ALL SELECT topic, label_b, 0, 1, 0 FROM paired) GROUP BY ALL),
  t AS (SELECT topic, CAST(sum(a) AS BIGINT) AS n, CAST(sum(h) AS DOUBLE) AS h, CAST(sum(a * b) AS DOUBLE) AS e FROM m GROUP BY topic)
  SELECT coalesce(c.ord, 4) AS place, topic, coalesce(n, 0) AS n, round(100 * h / n, 2) AS percent_agreement,
    CASE WHEN e = CAST(n AS DOUBLE) * n THEN 1.0 ELSE round((h / n - e / (CAST(n AS DOUBLE) * n)) / (1 - e / (CAST(n AS DOUBLE) * n)), 4) END AS cohens_kappa
  FROM t FULL JOIN topics AS c USING (topic)"""


@query(sql("SELECT 1", "paired", "topics")[: -len("\nSELECT 1")] + ",\n" + _BY_TOPIC)
def agreement_by_topic(spark, sf):
    return agreement.agreement_by_topic(_paired(spark, sf), A.TOPICS)


_DISTRIBUTION = f"""SELECT '{MODEL_A}' AS model, label, (SELECT count(*) FROM stories WHERE label_a = label) AS n, i FROM labels3
  UNION ALL SELECT '{MODEL_B}', label, (SELECT count(*) FROM stories WHERE label_b = label), i FROM labels3"""


@query(sql(f"SELECT model, label, n FROM ({_DISTRIBUTION})", "stories", "labels3"))
def label_distribution(spark, sf):
    cells = agreement.label_cells(_story_pairs(spark, sf))
    return agreement.label_distribution(cells, MODEL_A, MODEL_B).select("model", "label", "n")


# ---------------------------------------------------------------- state


@query(sql("""SELECT coalesce(s.headline_id, b.headline_id) AS headline_id, coalesce(s.topic, b.topic) AS topic,
  CASE WHEN s.topic IS NULL THEN b.title ELSE s.title END AS title,
  CASE WHEN s.topic IS NULL THEN b.source ELSE s.source END AS source,
  CASE WHEN s.topic IS NULL THEN b.link ELSE s.link END AS link,
  CAST(CASE WHEN s.topic IS NULL THEN b.published_at ELSE s.published_at END AS VARCHAR) AS published_at,
  CAST(least(s.first_seen_at, b.first_seen_at) AS VARCHAR) AS first_seen_at,
  CAST(greatest(s.last_seen_at, b.last_seen_at) AS VARCHAR) AS last_seen_at,
  CAST(least(s.first_run_date, b.first_run_date) AS VARCHAR) AS first_run_date,
  CAST(greatest(s.last_run_date, b.last_run_date) AS VARCHAR) AS last_run_date
  FROM stored AS s FULL JOIN batch AS b ON s.headline_id = b.headline_id AND s.topic = b.topic""", "stored", "batch"))
def upsert_state(spark, sf):
    return plain(sightings.upsert(*_stored_and_batch(spark, sf)))


@query(sql(f"SELECT {HEAD} FROM head", "head"))
def replay_is_idempotent(spark, sf):
    """Every sighting loaded a second time on top of itself."""
    again = _kept(sightings.collapse(A.typed_sightings(spark, sf)))
    return plain(sightings.upsert(A.headlines(spark, sf), again))


@query(sql("""SELECT headline_id, topic, title, source, link, CAST(published_at AS VARCHAR) AS published_at,
  CAST(min(collected_at) OVER w AS VARCHAR) AS first_seen_at, CAST(max(collected_at) OVER w AS VARCHAR) AS last_seen_at,
  CAST(min(run_date) OVER w AS VARCHAR) AS first_run_date, CAST(max(run_date) OVER w AS VARCHAR) AS last_run_date
  FROM typed WINDOW w AS (PARTITION BY headline_id, topic)
  QUALIFY row_number() OVER (PARTITION BY headline_id, topic ORDER BY run_date + CAST(k % 3 AS INTEGER), collected_at, ord) = 1""", "typed"))
def history_rebuild(spark, sf):
    """Records landed up to two days late: the partition they landed in ranks first."""
    raw_rows = A.raw_records(spark, sf)
    landed = F.date_add(F.to_date("run_date"), (F.col("k") % 3).cast("int"))
    return plain(sightings.rebuild(sightings.normalize(raw_rows.withColumn("date", landed))))


@query(sql(f"""SELECT {_RECORD.replace(', place', '')}, 'backfill' AS collection FROM pastfeedtop
  WHERE run_date NOT BETWEEN '2024-01-08' AND '2024-01-20'
  UNION ALL SELECT run_date, topic, title, source, link, published_at, collected_at, NULL FROM (
  {_FIRST.format(order='ord')}) WHERE run_date BETWEEN '2024-01-08' AND '2024-01-20'""", "pastfeedtop", "raw", "typed"))
def backfill_land(spark, sf):
    """Some run dates are landed; the backfill lands the others from feed documents."""
    records = A.raw_records(spark, sf)
    paths = _landed(spark, sf, records.filter(F.col("run_date").between("2024-01-08", "2024-01-20")))
    landed = raw.partition_dates(spark, paths.raw)
    wanted, _ = jobs.backfill_records(
        A.feed_documents(spark, sf, past_day=True), landed, "2024-01-31", 30, order=["ord"]
    )
    raw.write_partitions(spark, paths.raw, wanted)
    return raw.read_raw(spark, paths.raw).select(*_RAW_FIELDS[2:], "collection")


_DAYS = """SELECT CAST(unnest(generate_series(max(CAST(run_date AS TIMESTAMP)) - INTERVAL 29 day, max(CAST(run_date AS TIMESTAMP)), INTERVAL 1 day)) AS DATE) AS d FROM raw"""


@query(sql(f"""SELECT (SELECT string_agg(t.topic || ' (' || CAST(d AS VARCHAR) || ')', ',' ORDER BY d, t.ord) FROM ({_DAYS}) AS days, topics AS t
    WHERE NOT EXISTS (SELECT 1 FROM raw AS r WHERE r.topic = t.topic AND CAST(r.run_date AS DATE) = d)) AS failed,
  (SELECT count(*) FROM pastfeed WHERE reason IS NOT NULL AND NOT outside AND CAST(run_date AS DATE) IN (SELECT d FROM ({_DAYS}))) AS low_quality,
  (SELECT count(DISTINCT run_date) FROM got) AS fetched, 30 - (SELECT count(DISTINCT run_date) FROM got) AS empty,
  (SELECT count(*) FROM got) AS records, (SELECT count(*) FROM (SELECT DISTINCT topic, headline_id FROM got)) AS inserted,
  (SELECT count(*) FROM got) - (SELECT count(*) FROM (SELECT DISTINCT topic, headline_id FROM got)) AS seen_again,
  (SELECT count(DISTINCT headline_id) FROM got) AS scored, (SELECT count(*) FROM (SELECT DISTINCT topic, headline_id FROM got)) AS history_after
  """, "pastfeedtop", "raw", "topics").replace("\nSELECT (SELECT string_agg", f""",
got AS (SELECT * FROM pastfeedtop WHERE CAST(run_date AS DATE) IN (SELECT d FROM ({_DAYS})))
SELECT (SELECT string_agg"""))
def backfill_job(spark, sf):
    """The counters of a backfill of the latest 30 run dates into an empty lake."""
    paths = jobs.Paths(shared_folder(spark, "catalog"))
    feeds_ = A.feed_documents(spark, sf, past_day=True)
    today = feeds_.agg(F.date_add(F.max("run_date"), 1).alias("d")).first()["d"]
    run = jobs.run_backfill(
        spark, paths, feeds_, today=today, days=30, now=f"{today}T00:00:00Z", topics=A.TOPICS, order=["ord"]
    )
    stored = history.load_history(spark, paths.history)["headlines"]
    fill = run["backfill"]
    numbers = {
        "low_quality": run["filtered_low_quality"], "fetched": len(fill["fetched"]), "empty": len(fill["empty"]),
        "records": fill["records"], "inserted": run["inserted"], "seen_again": run["seen_again"], "scored": run["scored"]["lexicon"],
    }
    return stored.agg(F.count("*").alias("history_after")).select(
        F.lit(",".join(run["failed_topics"])).alias("failed"),
        *[F.lit(n).cast("long").alias(name) for name, n in numbers.items()], "history_after",
    )


_DAY_RUNS: dict[tuple[str, str], tuple[jobs.Paths, list[dict]]] = {}


def _day_runs(spark, sf) -> tuple[jobs.Paths, list[dict]]:
    """The two latest run dates as daily jobs from their documents, in order, then the earlier one
    replayed from what it landed. Worked out once in a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _DAY_RUNS or not files.exists(spark, _DAY_RUNS[key][0].history):
        paths, documents_ = jobs.Paths(shared_folder(spark, "catalog")), A.feed_documents(spark, sf)
        days = [r["run_date"] for r in A.run_dates(spark, sf).orderBy(F.desc("run_date")).limit(2).collect()][::-1]
        options = {"now": f"{days[-1]}T23:59:59Z", "topics": A.TOPICS}
        runs = [jobs.run_feed_day(spark, paths, documents_, day, order=["ord"], **options) for day in days]
        runs.append(jobs.run_day(spark, paths, days[0], **options))
        _DAY_RUNS[key] = paths, runs
    return _DAY_RUNS[key]


_RUN_DAYS = "SELECT DISTINCT run_date FROM raw ORDER BY run_date DESC LIMIT 2"
# what the job lands on its days
_DAY_ROWS = f"SELECT * FROM feedtop WHERE run_date IN ({_RUN_DAYS})"


@query(sql(f"""SELECT step, run_date, mode, failed, low_quality, raw_records, inserted, raw_records - inserted AS seen_again, scored, history_after FROM (
  SELECT 1 + CAST(d.run_date = (SELECT max(run_date) FROM raw) AS BIGINT) AS step, d.run_date, 'fetch' AS mode,
    (SELECT string_agg(t.topic, ',' ORDER BY t.ord) FROM topics AS t WHERE t.topic NOT IN (SELECT topic FROM raw AS r WHERE r.run_date = d.run_date)) AS failed,
    (SELECT count(*) FROM feed WHERE reason IS NOT NULL AND NOT outside AND feed.run_date = d.run_date) AS low_quality,
    (SELECT count(*) FROM landed AS l WHERE l.run_date = d.run_date) AS raw_records,
    (SELECT count(*) FROM (SELECT min(run_date) AS m FROM landed GROUP BY topic, headline_id) WHERE m = d.run_date) AS inserted,
    (SELECT count(*) FROM (SELECT min(run_date) AS m FROM landed GROUP BY headline_id) WHERE m = d.run_date) AS scored,
    (SELECT count(DISTINCT (topic, headline_id)) FROM landed AS l WHERE l.run_date <= d.run_date) AS history_after
  FROM ({_RUN_DAYS}) AS d
  UNION ALL SELECT 3, min(run_date), 'replay', '', 0, count(*) FILTER (WHERE run_date = (SELECT min(run_date) FROM landed)), 0, 0,
    count(DISTINCT (topic, headline_id)) FROM landed)""", "feedtop", "raw", "topics").replace(
    "\nSELECT step", f",\nlanded AS ({_DAY_ROWS})\nSELECT step"))
def run_day_job(spark, sf):
    """The counters of the daily job: two days in order, then a replay of the first, which adds nothing."""
    _, runs = _day_runs(spark, sf)
    rows = [
        (step, r["run_date"], r["mode"], ",".join(r["failed_topics"]), r["filtered_low_quality"], r["raw_records"], r["inserted"],
         r["seen_again"], r["scored"]["lexicon"], r["history_after"])
        for step, r in enumerate(runs, 1)
    ]
    return spark.createDataFrame(rows, """step long, run_date string, mode string, failed string, low_quality long, raw_records long,
        inserted long, seen_again long, scored long, history_after long""")


@query(sql(f"""SELECT headline_id, topic, title, nullif(source, '') AS source, nullif(link, '') AS link, CAST(published AS VARCHAR) AS published_at,
  CAST(min(collected_at) OVER w AS VARCHAR) AS first_seen_at, CAST(max(collected_at) OVER w AS VARCHAR) AS last_seen_at,
  min(run_date) OVER w AS first_run_date, max(run_date) OVER w AS last_run_date
  FROM ({_DAY_ROWS}) WINDOW w AS (PARTITION BY headline_id, topic)
  QUALIFY row_number() OVER (PARTITION BY headline_id, topic ORDER BY run_date) = 1""", "feedtop", "raw"))
def run_day_history(spark, sf):
    """The history after those jobs."""
    paths, _ = _day_runs(spark, sf)
    return plain(history.load_history(spark, paths.history)["headlines"])


@query(sql("""SELECT topic, CAST(first_run_date AS VARCHAR) AS first_run_date, CAST(last_run_date AS VARCHAR) AS last_run_date,
  count(*) FILTER (WHERE lowq.headline_id IS NULL) AS n, count(lowq.headline_id) AS hidden
  FROM head LEFT JOIN lowq USING (headline_id) GROUP BY ALL""", "head", "lowq"))
def history_span_counts(spark, sf):
    """The counts kept beside the history, over two loads of which the second moves rows of the first."""
    paths = jobs.Paths(shared_folder(spark, "catalog"))
    typed = A.typed_sightings(spark, sf)
    late = F.dayofmonth("run_date") % 2 == 0
    for part in (late, ~late):
        history.upsert_months(spark, paths.history, sightings.collapse(typed.filter(part)))
        counts = history.span_counts(spark, paths.history)
    return plain(counts)


@query(sql("""SELECT count(*) AS n, round(100 * avg(CAST(label_a = label_b AS DOUBLE)), 2) AS percent_agreement,
  (SELECT string_agg(CAST(n AS VARCHAR), ',' ORDER BY "row", col) FROM matrix) AS matrix FROM stories""", "stories", "matrix"))
def compare_job(spark, sf):
    """The agreement document of the job, as read back."""
    paths = _stored(spark, sf)
    report = jobs.compare(spark, paths, MODEL_A, MODEL_B, topics=A.TOPICS)
    cells = F.transform(F.flatten("confusion_matrix.matrix"), lambda n: n.cast("string"))
    return report.select("n", "percent_agreement", F.array_join(cells, ",").alias("matrix"))


# ---------------------------------------------------------------- reports


@query(sql("SELECT e.topic, e.place, e.headline_id AS id, e.title FROM edition AS e JOIN topics AS t USING (topic)", "edition", "topics"))
def report_document_roundtrip(spark, sf):
    """The latest document written as JSON and read back, its articles unfolded."""
    good = A.good(spark, sf)
    latest = reports.latest_report(good, A.sentiment(spark, sf), run_date=_last_day(good), topics=A.TOPICS)
    folder = shared_folder(spark, "document")
    documents.write_document(latest, folder)
    read = documents.read_document(spark, folder, latest.schema)
    return read.select(F.inline("topics")).select("label", F.posexplode("articles").alias("at", "a")).select(
        F.col("label").alias("topic"), (F.col("at") + 1).cast("long").alias("place"), "a.id", "a.title"
    )


@query(sql(f"""SELECT e.topic, e.place, e.headline_id AS id, e.title, coalesce(e.source, 'Unknown') AS source, coalesce(e.link, '') AS link,
  strftime(e.published_at, {ISO}) AS published,
  CASE WHEN b.model IS NOT NULL THEN b.model ELSE a.model END AS model,
  CASE WHEN b.model IS NOT NULL THEN b.label ELSE a.label END AS label,
  CASE WHEN b.model IS NOT NULL THEN b.score ELSE a.score END AS score,
  CAST(a.model IS NOT NULL AS BIGINT) + CAST(b.model IS NOT NULL AS BIGINT) AS models
  FROM edition AS e LEFT JOIN sent AS a ON a.headline_id = e.headline_id AND a.model = '{MODEL_A}'
  LEFT JOIN sent AS b ON b.headline_id = e.headline_id AND b.model = '{MODEL_B}'""", "edition", "sent"))
def report_latest(spark, sf):
    good = A.good(spark, sf)
    articles = reports.edition_articles(good, A.sentiment(spark, sf), _last_day(good))
    return articles.select(
        "topic", F.col("place").cast("long").alias("place"), "id", "title", "source", "link", "published",
        "sentiment.model", "sentiment.label", "sentiment.score", F.size("scores").cast("long").alias("models"),
    )


@query(sql("""SELECT topic, CAST(day AS VARCHAR) AS day, "count", model, avg, n, positive, neutral, negative FROM trend""", "trend"))
def report_trends(spark, sf):
    return plain(_trend(spark, sf).drop("ord"))


def _last_day(good: DataFrame):
    """The latest run date as a value, so that scans filter on a literal."""
    return activity.latest_run_date(good).first()["run_date"]


def _trend(spark, sf) -> DataFrame:
    good = A.good(spark, sf)
    series = reports.trend_series(good, A.sentiment(spark, sf), end_date=_last_day(good), topics=A.TOPICS)
    return reports.trend_rows(series)


@query(sql("""SELECT count(*) AS n, round(100 * avg(CAST(label_a = label_b AS DOUBLE)), 2) AS percent_agreement,
  (WITH c AS (SELECT count(*) AS n, CAST(count(*) FILTER (WHERE label_a = label_b) AS DOUBLE) / count(*) AS po FROM stories),
    e AS (SELECT CAST(sum(x.n * y.n) AS DOUBLE) AS hits FROM (SELECT label_a AS l, count(*) AS n FROM stories GROUP BY 1) AS x
      JOIN (SELECT label_b AS l, count(*) AS n FROM stories GROUP BY 1) AS y USING (l))
    SELECT round((po - hits / (CAST(n AS DOUBLE) * n)) / (1 - hits / (CAST(n AS DOUBLE) * n)), 4) FROM c, e) AS cohens_kappa,
  round(corr(score_a, score_b), 4) AS score_correlation,
  (SELECT string_agg(CAST(n AS VARCHAR), ',' ORDER BY "row", col) FROM matrix) AS matrix,
  least(count(*), 2000) AS score_pairs, least(count(*) FILTER (WHERE label_a <> label_b), 60) AS disagreements,
  (SELECT count(*) FROM (SELECT topic FROM paired UNION SELECT topic FROM topics)) AS topics FROM stories""",
           "stories", "matrix", "topics"))
def report_agreement(spark, sf):
    good, scores = A.good(spark, sf), A.sentiment(spark, sf)
    pairs = _kept(reports.report_pairs(good, scores, MODEL_A, MODEL_B))
    report = reports.agreement_report(good, scores, MODEL_A, MODEL_B, topics=A.TOPICS, pairs=pairs)
    cells = F.transform(F.flatten("confusion_matrix.matrix"), lambda n: n.cast("string"))
    return report.select(
        "n", "percent_agreement", "cohens_kappa", "score_correlation", F.array_join(cells, ",").alias("matrix"),
        *[F.size(name).cast("long").alias(name) for name in ("score_pairs", "disagreements")],
        F.size("by_topic").cast("long").alias("topics"),
    )


@query(sql(f"""SELECT (SELECT count(*) FROM good) AS headlines, (SELECT count(*) FROM head) - (SELECT count(*) FROM good) AS excluded_low_quality,
  (SELECT CAST(min(first_run_date) AS VARCHAR) FROM good) AS first_run_date, (SELECT CAST(max(last_run_date) AS VARCHAR) FROM good) AS last_run_date,
  (SELECT count(*) FROM rundays) AS run_days, '{MODEL_B}' AS "primary",
  (SELECT string_agg(model || '=' || CAST(n AS VARCHAR), ',' ORDER BY model) FROM (SELECT model, count(*) AS n FROM sent
    WHERE headline_id IN (SELECT headline_id FROM good) GROUP BY model)) AS scored,
  (SELECT string_agg(topic || '=' || CAST(edition AS VARCHAR) || '/' || CAST(total AS VARCHAR), ',' ORDER BY ord) FROM ({_SIZES})) AS topics,
  (SELECT string_agg(CAST(run_date AS VARCHAR) || '=' || CAST(new_headlines AS VARCHAR) || '/' || CAST(seen_again AS VARCHAR), ',' ORDER BY run_date) FROM activity) AS daily,
  (SELECT string_agg(source || '=' || CAST(n AS VARCHAR), ',' ORDER BY n DESC, source) FROM (SELECT coalesce(source, 'Unknown') AS source,
    count(DISTINCT headline_id) AS n FROM good GROUP BY 1 ORDER BY n DESC, source LIMIT 10)) AS sources""",
           "head", "good", "sent", "topics", "edition", "activity"))
def report_status(spark, sf):
    folder = A.stored_history(spark, sf)
    spans = history.span_counts(spark, folder)
    status = reports.status_report(
        A.headlines(spark, sf), A.sentiment(spark, sf), topics=A.TOPICS, flagged=history.flagged_titles(spark, folder),
        run_date=_last_day(spans.filter("n > 0")), spans=spans,
    )

    def listed(column, render) -> F.Column:
        return F.array_join(F.transform(column, render), ",")

    def pair(name, *numbers):
        return lambda r: F.concat(r[name], F.lit("="), F.concat_ws("/", *[r[n].cast("string") for n in numbers]))

    scored = F.array_sort(F.map_entries("history.sentiment"))
    return status.select(
        "history.headlines", "history.excluded_low_quality", "history.first_run_date", "history.last_run_date",
        "history.run_days", "models.primary",
        listed(scored, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))).alias("scored"),
        listed("topics", pair("label", "edition", "total")).alias("topics"),
        listed("daily", pair("run_date", "new_headlines", "seen_again")).alias("daily"),
        listed("sources", pair("source", "n")).alias("sources"),
    )


# ---------------------------------------------------------------- derived views


def _articles(spark, sf) -> DataFrame:
    good = A.good(spark, sf)
    rows = _kept(editions.edition(good, _last_day(good)))
    return reports.edition_articles(good, A.sentiment(spark, sf), rows=rows)


@query(sql("""SELECT m.topic, m.model, round(m.avg, 4) AS avg, m.n, (SELECT count(*) FROM edition AS e WHERE e.topic = m.topic) AS "of",
  m.fallback FROM mood AS m""", "mood", "edition"))
def topic_mood(spark, sf):
    return rounded(views.topic_mood(_articles(spark, sf)), "avg")


@query(sql("""SELECT topic, model, count(*) FILTER (WHERE label = 'positive') AS positive, count(*) FILTER (WHERE label = 'neutral') AS neutral,
  count(*) FILTER (WHERE label = 'negative') AS negative, count(*) AS n FROM escores GROUP BY topic, model""", "escores"))
def label_mix(spark, sf):
    return views.label_mix(_articles(spark, sf))


@query(sql(f"""SELECT e.topic, count(*) FILTER (WHERE a.label IS NOT NULL AND b.label IS NOT NULL) AS n,
  count(*) FILTER (WHERE a.label <> b.label) AS differ,
  coalesce(string_agg(e.headline_id, ',' ORDER BY e.place) FILTER (WHERE a.label <> b.label), '') AS ids
  FROM edition AS e LEFT JOIN sent AS a ON a.headline_id = e.headline_id AND a.model = '{MODEL_A}'
  LEFT JOIN sent AS b ON b.headline_id = e.headline_id AND b.model = '{MODEL_B}' GROUP BY e.topic""", "edition", "sent"))
def edition_disagreement(spark, sf):
    out = views.edition_disagreement(_articles(spark, sf), MODEL_A, MODEL_B)
    return out.withColumn("ids", F.array_join("ids", ","))


@query(sql("""SELECT most_positive, round(high_avg, 4) AS high_avg, most_negative, round(low_avg, 4) AS low_avg FROM (
  SELECT arg_max(topic, k) AS most_positive, max(avg) AS high_avg, arg_min(topic, k) AS most_negative, min(avg) AS low_avg, count(*) AS n
  FROM (SELECT m.topic, m.avg, row_number() OVER (ORDER BY m.avg, t.ord DESC) AS k FROM mood AS m JOIN topics AS t USING (topic) WHERE NOT m.fallback))
  WHERE n > 1 AND high_avg <> low_avg""", "mood", "topics"))
def mood_extremes(spark, sf):
    moods = views.topic_mood(_articles(spark, sf))
    return rounded(views.mood_extremes(moods, A.TOPICS), "high_avg", "low_avg")


@query(sql("""SELECT topic, CAST(day AS VARCHAR) AS day, "count", model, avg, n FROM trend
  WHERE day > (SELECT max(day) FROM trend) - 14""", "trend"))
def trend_tail(spark, sf):
    return plain(views.trend_tail(_trend(spark, sf)).select("topic", "day", "count", "model", "avg", "n"))


_WINDOW = f"""FROM (SELECT topic, day, max("count") AS "count", coalesce(max(n) FILTER (WHERE model = '{MODEL_A}'), 0) AS n,
  max(avg) FILTER (WHERE model = '{MODEL_A}') AS avg FROM trend WHERE day > (SELECT max(day) FROM trend) - 30 GROUP BY topic, day)"""


@query(sql(f"""SELECT topic, CAST(sum("count") AS BIGINT) AS total, CAST(sum(n) AS BIGINT) AS scored, count(*) FILTER (WHERE "count" > 0) AS active_days,
  round(sum(avg * n) / nullif(sum(n), 0), 4) AS average {_WINDOW} GROUP BY topic""", "trend"))
def window_view(spark, sf):
    return rounded(views.window_view(_trend(spark, sf), MODEL_A, 30), "average")


@query(sql(f"""SELECT CAST(sum(c) AS BIGINT) AS total, CAST(sum(s) AS BIGINT) AS scored, count(*) FILTER (WHERE c > 0) AS headline_days,
  count(*) FILTER (WHERE s > 0) AS scored_days FROM (SELECT day, sum("count") AS c, sum(n) AS s {_WINDOW} GROUP BY day)""", "trend"))
def window_days(spark, sf):
    return views.window_days(_trend(spark, sf), MODEL_A, 30)


@query(sql("""SELECT topic, model, CAST(max(day) AS VARCHAR) AS day, arg_max(avg, day) AS avg, arg_max(n, day) AS n
  FROM trend WHERE avg IS NOT NULL GROUP BY topic, model""", "trend"))
def last_scored(spark, sf):
    return plain(views.last_scored(_trend(spark, sf)))


@query(sql("""SELECT topic, CAST(day AS VARCHAR) AS day, model, avg, CASE WHEN avg IS NULL THEN NULL WHEN abs(avg) < 0.05 THEN 0
  ELSE CAST(sign(avg) AS INTEGER) * CASE WHEN abs(avg) < 0.2 THEN 1 WHEN abs(avg) < 0.4 THEN 2 ELSE 3 END END AS bin FROM trend""", "trend"))
def score_bins(spark, sf):
    return plain(views.score_bins(_trend(spark, sf)))


@query(sql("""SELECT topic, model, CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day, count(*) AS days FROM (
  SELECT topic, model, day, day - CAST(row_number() OVER (PARTITION BY topic, model ORDER BY day) AS INTEGER) AS island
  FROM trend WHERE avg IS NOT NULL) GROUP BY topic, model, island""", "trend"))
def scored_runs(spark, sf):
    return plain(views.scored_runs(_trend(spark, sf)))


@query(sql("""SELECT label_a, label_b, n, CAST(sum(n) OVER (PARTITION BY "row") AS BIGINT) AS row_total,
  CAST(sum(n) OVER (PARTITION BY col) AS BIGINT) AS col_total,
  round(100.0 * n / nullif(sum(n) OVER (PARTITION BY "row"), 0), 4) AS row_share,
  coalesce("row" <> col AND n > 0 AND row_number() OVER (PARTITION BY "row" <> col ORDER BY n DESC, "row", col) = 1, false) AS largest_mismatch
  FROM matrix""", "matrix"))
def confusion_shares(spark, sf):
    matrix = agreement.confusion_matrix(agreement.label_cells(_story_pairs(spark, sf)))
    return rounded(views.confusion_shares(matrix), "row_share")


@query(sql(f"""SELECT label, round(share_a, 4) AS share_a, round(share_b, 4) AS share_b, round(abs(share_a - share_b), 4) AS gap,
  row_number() OVER (ORDER BY round(abs(share_a - share_b), 9) DESC, i) = 1 AS widest FROM (
  SELECT i, label, max(s) FILTER (WHERE model = '{MODEL_A}') AS share_a, max(s) FILTER (WHERE model = '{MODEL_B}') AS share_b FROM (
    SELECT i, label, model, coalesce(100.0 * n / nullif(sum(n) OVER (PARTITION BY model), 0), 0) AS s FROM ({_DISTRIBUTION})) GROUP BY i, label)""",
           "stories", "labels3"))
def label_gap(spark, sf):
    counts = agreement.label_distribution(agreement.label_cells(_story_pairs(spark, sf)), MODEL_A, MODEL_B)
    return rounded(views.label_gap(counts, MODEL_A, MODEL_B), "share_a", "share_b", "gap")


@query(sql("""SELECT x.v AS sign_a, y.v AS sign_b, (SELECT count(*) FROM stories WHERE sign(score_a) = x.v AND sign(score_b) = y.v) AS n
  FROM (VALUES (1), (0), (-1)) AS x(v), (VALUES (1), (0), (-1)) AS y(v)""", "stories"))
def score_quadrants(spark, sf):
    return views.score_quadrants(_story_pairs(spark, sf))


@query(sql("""WITH f AS (SELECT min(run_date) AS first, max(run_date) AS last FROM activity),
  d AS (SELECT first, CAST(unnest(generate_series(CAST(last AS TIMESTAMP) - (least(30, greatest(14, last - first + 1)) - 1) * INTERVAL 1 day,
    CAST(last AS TIMESTAMP), INTERVAL 1 day)) AS DATE) AS day FROM f)
  SELECT CAST(d.day AS VARCHAR) AS day, a.run_date IS NOT NULL AS run, coalesce(a.new_headlines, 0) AS fresh, coalesce(a.seen_again, 0) AS seen,
  coalesce(a.new_headlines, 0) + coalesce(a.seen_again, 0) AS total, d.day < d.first AS before_history
  FROM d LEFT JOIN activity AS a ON a.run_date = d.day""".replace("WITH f AS", ", f AS", 1), "activity").replace(")\n, f AS", "),\nf AS"))
def ingest_calendar(spark, sf):
    return plain(views.ingest_calendar(activity.daily_activity(A.good(spark, sf))))


@query(sql("""SELECT source, n, round(100.0 * n / max(n) OVER (), 4) AS share FROM (
  SELECT coalesce(source, 'Unknown') AS source, count(DISTINCT headline_id) AS n FROM good GROUP BY 1 ORDER BY n DESC, source LIMIT 10)""", "good"))
def share_of_max(spark, sf):
    return rounded(views.share_of_max(activity.top_sources(A.good(spark, sf))), "share")


# ---------------------------------------------------------------- streaming


def _inbox(spark, sf) -> str:
    """The records as JSON files for a file stream."""
    folder = shared_folder(spark, "inbox")
    A.raw_records(spark, sf).drop("ord", "k").write.json(folder)
    return folder


def _finish(stream) -> None:
    stream.awaitTermination()
    if stream.exception() is not None:
        raise stream.exception()


@query(sql("""SELECT run_date AS date, topic AS topic_slug, topic, title, source, link, published_at, collected_at, run_date
  FROM raw JOIN (SELECT ord, headline_id FROM typed) USING (ord)
  QUALIFY row_number() OVER (PARTITION BY run_date, topic, headline_id
    ORDER BY collected_at, title, source NULLS FIRST, link, published_at NULLS FIRST) = 1""", "raw", "typed"))
def stream_landing(spark, sf):
    paths = jobs.Paths(shared_folder(spark, "catalog"))
    records = streams.read_record_stream(spark, _inbox(spark, sf))
    _finish(streams.land_stream(records, paths, shared_folder(spark, "stream")))
    return raw.read_raw(spark, paths.raw).drop("collection")


# without `ord` the smallest record of a key's earliest time stays
_UPSERTED = """SELECT headline_id, topic, title, source, link, CAST(published_at AS VARCHAR) AS published_at,
  CAST(min(collected_at) OVER w AS VARCHAR) AS first_seen_at, CAST(max(collected_at) OVER w AS VARCHAR) AS last_seen_at,
  CAST(min(run_date) OVER w AS VARCHAR) AS first_run_date, CAST(max(run_date) OVER w AS VARCHAR) AS last_run_date
  FROM typed WINDOW w AS (PARTITION BY headline_id, topic)
  QUALIFY row_number() OVER (PARTITION BY headline_id, topic ORDER BY collected_at, title, source NULLS FIRST, link, published_at NULLS FIRST) = 1"""


@query(sql(_UPSERTED, "typed"))
def stream_upsert(spark, sf):
    paths = jobs.Paths(shared_folder(spark, "catalog"))
    records = streams.read_record_stream(spark, _inbox(spark, sf))
    _finish(streams.upsert_stream(records, paths, shared_folder(spark, "stream")))
    return plain(history.load_history(spark, paths.history)["headlines"])


@query(sql(f"SELECT headline_id, 'lexicon' AS model, label, score, '2024-02-01 00:00:00' AS scored_at FROM ("
           + _lexicon_sql("SELECT headline_id, min(title) AS txt FROM good GROUP BY headline_id", "headline_id") + ")", "good"))
def stream_scoring(spark, sf):
    """The records come twice; the second time adds nothing."""
    paths, inbox, checkpoint = jobs.Paths(shared_folder(spark, "catalog")), _inbox(spark, sf), shared_folder(spark, "stream")
    scorers = scoring.default_registry().choose(["lexicon"])
    for _ in range(2):
        records = streams.read_record_stream(spark, inbox)
        _finish(streams.score_stream(records, paths, checkpoint, scorers, "2024-02-01T00:00:00Z"))
        A.raw_records(spark, sf).drop("ord", "k").write.mode("append").json(inbox)
    return plain(history.load_history(spark, paths.history)["sentiment"])


@query(sql("""SELECT CAST(run_date AS VARCHAR) AS day, topic, count(*) FILTER (k % 50 <> 0) AS n, count(*) FILTER (k % 50 = 0) AS late
  FROM typed, (SELECT max(collected_at) - INTERVAL 2 days AS mark FROM typed WHERE k % 50 <> 0)
  WHERE run_date + INTERVAL 1 day <= mark GROUP BY ALL""", "typed"))
def stream_late_counts(spark, sf):
    """Some sightings arrive after all others: those of closed days are left out and counted."""
    folder, inbox, checkpoint = (shared_folder(spark, n) for n in ("counts", "inbox", "stream"))
    for late in (False, True):
        A.raw_records(spark, sf).filter((F.col("k") % 50 == 0) == F.lit(late)).drop("ord", "k").write.mode("append").json(inbox)
        typed = streams.read_record_stream(spark, inbox).withColumn("collected_at", times.parse_iso(F.col("collected_at")))
        for stream in streams.final_count_stream(typed, folder, checkpoint):
            _finish(stream)
    return plain(streams.late_counts(spark, folder))


@query(sql("SELECT CAST(run_date AS VARCHAR) AS day, topic, count(*) AS n FROM typed GROUP BY ALL", "typed"))
def stream_daily_counts(spark, sf):
    out = shared_folder(spark, "counts")
    typed = streams.read_record_stream(spark, _inbox(spark, sf)).withColumn(
        "collected_at", times.parse_iso(F.col("collected_at"))
    )
    counts = streams.daily_count_stream(typed)
    stream = (
        counts.writeStream.outputMode("complete").option("checkpointLocation", shared_folder(spark, "stream"))
        .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out))
        .trigger(availableNow=True).start()
    )
    _finish(stream)
    return plain(spark.read.parquet(out))
