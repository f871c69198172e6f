"""UTC times and run-date arithmetic. Timestamps carry no zone and mean UTC."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidings.config import BACKFILL_MAX_DAYS, DAYS_BACK
from tidings.functions.binding import let

# weekday (optional), day, month name, year, hour, minute, second, zone
_MAIL_DATE = (
    r"(?i)^\s*(?:[a-z]+\s*,?\s*)?(\d{1,2})[\s-]+([a-z]{3})[a-z]*[\s-]+(\d{4}|\d{2})\s+"
    r"(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?(?:\s+([+-]\d{4}|[a-z]+))?\b.*$"
)
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
# Zone names of mail dates, in minutes from UTC. Any other name counts as UTC.
_ZONE_MINUTES = {
    "AST": -240, "ADT": -180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300,
    "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}


def _int(text: Column) -> Column:
    return text.try_cast("int")


def parse_published(text: Column) -> Column:
    """Timestamp of an RFC 822 date in UTC; null when missing or invalid. A date without an
    offset is UTC."""
    fields = F.split(F.regexp_replace(text, _MAIL_DATE, "$1|$2|$3|$4|$5|$6|$7"), r"\|", -1)
    return let(fields, lambda f: _assemble([F.get(f, F.lit(i)) for i in range(7)]))


def _assemble(item: list[Column]) -> Column:
    at = F.instr(F.lit(_MONTHS), F.lower(item[1]))
    month = F.when((F.length(item[1]) == 3) & (at % 3 == 1), (at + 2) / 3).cast("int")
    year = _int(item[2])
    year = F.when(
        F.length(item[2]) == 2, year + F.when(year > 68, 1900).otherwise(2000)
    ).otherwise(year)
    second = F.when(item[5] == "", 0).otherwise(_int(item[5]))
    second = F.when(second < 60, second)
    local = F.try_make_timestamp_ntz(
        year, month, _int(item[0]), _int(item[3]), _int(item[4]), second
    )

    zone = F.upper(item[6])
    digits = F.abs(_int(zone))
    offset = F.when(
        F.rlike(zone, F.lit("^[+-]")),
        F.signum(_int(zone)).cast("int") * (F.floor(digits / 100).cast("int") * 60 + digits % 100),
    )
    for name, minutes in _ZONE_MINUTES.items():
        offset = offset.when(zone == name, minutes)
    return local - F.make_dt_interval(mins=offset.otherwise(0))


def parse_iso(text: Column) -> Column:
    """Timestamp of ISO 8601 text in UTC; text without an offset is UTC, bad text is null."""
    return text.try_cast("timestamp").cast("timestamp_ntz")


def to_iso(ts: Column) -> Column:
    """`2026-09-14T07:30:00Z`; null stays null."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def is_recent(published: Column, now: Column, days_back: int = DAYS_BACK) -> Column:
    """Inside the daily window. Undated items stay and there is no upper bound."""
    return published.isNull() | (published >= now - F.make_dt_interval(F.lit(days_back)))


def on_utc_day(published: Column, day: Column) -> Column:
    """Published on that UTC day. Undated items do not count."""
    return published.isNotNull() & (F.to_date(published) == day)


def edition_day(run_date: Column) -> Column:
    """The day whose headlines make the edition of a run date: the day before."""
    return F.date_sub(run_date, 1)


def edition_label(run_date: Column) -> Column:
    """`Yesterday, Sep 13`, or a fixed text when there is no edition."""
    return F.coalesce(
        F.concat(F.lit("Yesterday, "), F.date_format(edition_day(run_date), "MMM dd")),
        F.lit("No edition yet"),
    )


def utc(value: datetime | date | str) -> Column:
    """Literal timestamp in UTC from a datetime (naive means UTC) or ISO text."""
    if isinstance(value, datetime):
        value = value.isoformat()
    return parse_iso(F.lit(str(value)))


def backfill_dates(today: Column, days: int) -> Column:
    """array<date> of the run dates a backfill covers: today - days to yesterday, ascending."""
    if not 1 <= days <= BACKFILL_MAX_DAYS:
        raise ValueError(f"days must be between 1 and {BACKFILL_MAX_DAYS}, got {days}")
    return F.sequence(F.date_sub(today, days), F.date_sub(today, 1))
