"""Declared schemas. Raw records are text; the history tables are typed."""

from pyspark.sql import types as T

_S, _TS, _D = T.StringType(), T.TimestampNTZType(), T.DateType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# one sighting of a story as collected; every field is text, dates are ISO 8601
RAW_RECORD = _struct(
    topic=_S, title=_S, source=_S, link=_S, published_at=_S, collected_at=_S, run_date=_S,
    collection=_S,
)

# one row per story and topic
HEADLINES = _struct(
    headline_id=_S, topic=_S, title=_S, source=_S, link=_S, published_at=_TS,
    first_seen_at=_TS, last_seen_at=_TS, first_run_date=_D, last_run_date=_D,
)

# one row per story and model
SENTIMENT = _struct(
    headline_id=_S, model=_S, label=_S, score=T.DoubleType(), scored_at=_TS,
)

# one item element of a feed document
FEED_ITEM = T.StructType(
    [
        T.StructField("title", _S, True),
        T.StructField("link", _S, True),
        T.StructField("pubDate", _S, True),
        T.StructField("source", _struct(_VALUE=_S, _url=_S), True),
    ]
)
FEED_DOCUMENT = T.StructType(
    [
        T.StructField(
            "channel", T.StructType([T.StructField("item", T.ArrayType(FEED_ITEM), True)]), True
        )
    ]
)

SCORE = _struct(label=_S, score=T.DoubleType())
