"""Feeds that are not well-formed lose only the items that are broken."""

from pyspark.sql import functions as F

from tidings.sources import feeds, raw


def item(title, link="http://a.example/x"):
    return f"<item><title>{title}</title><link>{link}</link><pubDate>Mon, 05 Jan 2026 08:00:00 GMT</pubDate></item>"


def test_items_survive_their_neighbours(spark):
    contents = {
        "stray": f"<rss><channel>{item('Cats & dogs - Post', 'http://a.example/1')}{item('Two&nbsp;words - Post', 'http://a.example/2')}</channel></rss>",
        "broken": f"<rss><channel>{item('Good one - Post', 'http://a.example/3')}<item><title>Bad <b></title></item>{item('Good two - Post', 'http://a.example/4')}",
        "empty": "<rss><channel></channel></rss>",
    }
    rows = [(t, "2026-01-05", c) for t, c in contents.items()]
    documents = spark.createDataFrame(rows, "topic string, run_date string, content string").withColumn(
        "collected_at", F.lit("2026-01-05 12:00:00").cast("timestamp_ntz"))
    records, counts = feeds.parse_feed(documents, days_back=2)
    assert {r["title"] for r in records.collect()} == {"Cats & dogs", "Two words", "Good one", "Good two"}
    got = {r["topic"]: (r["items"], r["unparsed"]) for r in counts.collect()}
    assert got == {"stray": (2, 0), "broken": (3, 1), "empty": (0, 0)}


def test_tags_in_sections_and_entities_of_html(spark):
    contents = [
        "<rss><channel><!-- " + item("Hidden") + " -->" + item("Caf&eacute; d&rsquo;Or &amp; co &hearts; &nosuch; - Post"),
        item("<![CDATA[A </item> in a title &amp; more]]>") + "<item ><title>Cut off</title>" + item("Next") + "<item><title>End",
        "<item><title><![CDATA[never closed</title></item>" + item("<![CDATA[closed ] ]> ]]>") + "<items></items><!-- open" + item("After"),
        "<![CDATA[" + item("Text") + "]]>" + item("x" * 200_000 + "<![CDATA[" + "]" * 100_000 + "]]>") + "<!--" + "-" * 100_000,
    ]
    frame = spark.createDataFrame(list(enumerate(contents)), "id int, content string")
    got = {}
    for r in feeds.feed_items(frame, ["id"]).orderBy("id", "position").collect():
        got.setdefault(r["id"], []).append(None if r["unparsed"] else r["raw_title"])
    assert got[0] == ["Caf\u00e9 d\u2019Or & co \u2665 &nosuch; - Post"]
    assert got[1] == ["A </item> in a title &amp; more", None, "Next", None]
    assert got[2] == [None, "closed ] ]>", "After"]
    assert got[3][-1] == "x" * 200_000 + "]" * 100_000


def test_the_version_collected_first_is_landed(spark, tmp_path):
    rows = [("T", "aaa later", "s", "http://a.example/1", None, "2026-01-05T10:00:00Z", "2026-01-05"),
            ("T", "zzz sooner", "s", "http://a.example/1", None, "2026-01-05T09:00:00Z", "2026-01-05")]
    names = "topic string, title string, source string, link string, published_at string, collected_at string, run_date string"
    records = spark.createDataFrame(rows, names).withColumn("date", F.col("run_date"))
    raw.write_partitions(spark, str(tmp_path), records)
    assert [r["title"] for r in raw.read_raw(spark, str(tmp_path)).collect()] == ["zzz sooner"]
    (tmp_path / "date=oddly" / "topic_slug=t").mkdir(parents=True)
    (tmp_path / "date=oddly" / "topic_slug=t" / "x.json").write_text('{"topic": "T"}')
    raw.repair(spark, str(tmp_path))
    assert raw.read_raw(spark, str(tmp_path)).count() == 1
