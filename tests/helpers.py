"""Small inputs for tests."""

from datetime import datetime

from tidings.functions.times import utc
from tidings.operators import sightings
from tidings.schemas import RAW_RECORD, SENTIMENT

NOW = "2026-09-14T09:00:00Z"
JUNK = "Granite Works Stock Quote Price and Forecast"


def record(title, *, topic="Markets", link=None, source="Reuters", published_at="2026-09-14T07:00:00Z",
           collected_at=None, run_date="2026-09-14", collection=None):
    name = "-".join("".join(c if c.isalnum() else " " for c in title.lower()).split())
    return (
        topic, title, source, f"https://example.com/news/{name}" if link is None else link, published_at,
        collected_at or f"{run_date}T09:00:00Z", run_date, collection,
    )


def records(spark, rows):
    """Raw records with their position as `ord` and run date as partition `date`."""
    schema = "ord int, " + ", ".join(f"{f.name} string" for f in RAW_RECORD) + ", date string"
    return spark.createDataFrame([(i, *r, r[6]) for i, r in enumerate(rows)], schema)


def table(spark, rows):
    """A headlines table from raw records loaded in one batch."""
    return sightings.collapse(sightings.normalize(records(spark, rows)))


def scores(spark, headlines, by_title):
    """Sentiment rows from {title: {model: (label, score)}}."""
    rows = [
        (title, model, label, float(score))
        for title, models in by_title.items() for model, (label, score) in models.items()
    ]
    given = spark.createDataFrame(rows, "title string, model string, label string, score double")
    stories = headlines.select("headline_id", "title").distinct()
    return stories.join(given, "title").select(
        "headline_id", "model", "label", "score", utc(NOW).alias("scored_at")
    ).select(*SENTIMENT.fieldNames())


def values(frame, *columns):
    rows = frame.select(*columns).collect() if columns else frame.collect()
    return [tuple(r) if len(r) > 1 else r[0] for r in rows]


def evaluate(spark, build, rows, schema):
    """Values of a column expression over literal rows, in order."""
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"_i int, {schema}")
    return [r["v"] for r in frame.select("_i", build.alias("v")).orderBy("_i").collect()]


def at(text):
    return datetime.fromisoformat(text)
