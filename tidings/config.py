"""Settings of the pipeline. Every operator takes its settings as arguments; these are defaults."""

from __future__ import annotations

from dataclasses import dataclass

# Topics (label, search text), in display order.
TOPICS: tuple[tuple[str, str], ...] = (
    ("Markets", "stock market"),
    ("Tesla", "TSLA Tesla"),
    ("AI", "artificial intelligence"),
    ("Economy", "economy inflation"),
    ("Tech", "technology startups"),
    ("Energy", "oil energy"),
)

# Limits and windows.
MAX_PER_TOPIC = 8
DAYS_BACK = 1
TREND_DAYS = 30
STATUS_DAILY_RUNS = 30
STATUS_TOP_SOURCES = 10
SCORE_PAIRS = 2000
DISAGREEMENTS = 60
BACKFILL_MAX_DAYS = 60
BACKFILL_TAG = "backfill"
SCHEDULE = "0 9 * * *"

# Sentiment labels in report order, cut points, model names by preference.
LABELS: tuple[str, ...] = ("positive", "neutral", "negative")
POSITIVE_CUT = 0.05
NEGATIVE_CUT = -0.05
DEFAULT_MODELS: tuple[str, ...] = ("lexicon",)
MODEL_PREFERENCE: tuple[str, ...] = ("finbert", "vader")
UNKNOWN_SOURCE = "Unknown"


@dataclass(frozen=True)
class Topic:
    label: str
    query: str = ""


def topic_list(topics=TOPICS) -> tuple[Topic, ...]:
    """Validated topics from labels, (label, query) pairs or Topic objects, order kept."""
    out = []
    for item in topics:
        if isinstance(item, Topic):
            out.append(item)
        elif isinstance(item, str):
            out.append(Topic(item))
        else:
            out.append(Topic(*item))
    if len({t.label for t in out}) != len(out):
        raise ValueError("topic labels must be unique")
    return tuple(out)
