"""Text columns: trimming, caseless comparison form, slugs and headline titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidings.config import UNKNOWN_SOURCE
from tidings.functions.binding import let

# The white space characters, spelled out, as trimming by a list of characters and
# a plain character class are both cheaper than a Unicode-aware pattern.
_SPACE_RANGES = (
    ("\t", "\r"), ("\x1c", " "), ("\x85", "\x85"), ("\xa0", "\xa0"), ("\u1680", "\u1680"),
    ("\u2000", "\u200a"), ("\u2028", "\u2029"), ("\u202f", "\u202f"), ("\u205f", "\u205f"),
    ("\u3000", "\u3000"),
)
_SPACES = "".join(chr(c) for lo, hi in _SPACE_RANGES for c in range(ord(lo), ord(hi) + 1))
_SPACE_RUN = "[" + "".join(f"{lo}-{hi}" for lo, hi in _SPACE_RANGES) + "]+"
_PLAIN_LINE = r"^[!-~][ -~]*\z"

# Dotless i has no other caseless form and would become a plain i through upper case; a private
# character stands in for it on the way. Capital sharp s has to be written small first.
_DOTLESS, _STAND_IN = "\u0131", "\ue000"


def strip(text: Column) -> Column:
    """`text` without leading and trailing white space."""
    return F.btrim(text, F.lit(_SPACES))


def casefold(text: Column) -> Column:
    """Caseless comparison form: sharp s and ligatures expand, both sigmas are one letter.

    The middle step also keeps the two case functions apart: Spark simplifies lower(upper(x)) to
    lower(x), which is not the same."""
    upper = F.upper(F.translate(text, f"{_DOTLESS}ẞ", f"{_STAND_IN}ß"))
    return F.translate(F.lower(F.translate(upper, _STAND_IN, _DOTLESS)), "ς", "σ")


def normalize_text(text: Column) -> Column:
    """Caseless text with single spaces and no outer white space; null becomes empty.

    Plain ASCII words with single spaces, the common case, only need lower case."""
    given = F.coalesce(text, F.lit(""))
    spaced = F.contains(given, F.lit("  ")) | F.endswith(given, F.lit(" "))
    full = F.trim(F.regexp_replace(casefold(given), _SPACE_RUN, " "))
    return F.when(F.rlike(given, F.lit(_PLAIN_LINE)) & ~spaced, F.lower(given)).otherwise(full)


def slug(label: Column) -> Column:
    """Lower-case letters and digits joined by single dashes; `topic` when nothing is left."""
    dashed = F.regexp_replace(F.lower(label), "[^a-z0-9]+", "-")
    return F.coalesce(F.nullif(F.btrim(dashed, F.lit("-")), F.lit("")), F.lit("topic"))


def split_title(raw_title: Column, source: Column) -> Column:
    """struct<title, source> from a feed title shaped `headline - Source`.

    A named source is cut off as exactly that suffix. Otherwise the text after the last
    separator goes, and it becomes the source when none is named."""
    texts = F.struct(
        strip(F.coalesce(raw_title, F.lit(""))).alias("raw"),
        strip(F.coalesce(source, F.lit(""))).alias("named"),
    )
    return let(texts, lambda t: _split(t["raw"], t["named"]))


def _split(raw: Column, named: Column) -> Column:
    is_named = named != ""
    tail = F.substring_index(raw, " - ", -1)

    def head(length: Column) -> Column:
        return strip(F.substr(raw, F.lit(1), F.length(raw) - length - 3))

    def parts(title: Column, origin: Column) -> Column:
        return F.struct(title.alias("title"), origin.alias("source"))

    return (
        F.when(
            is_named & F.endswith(raw, F.concat(F.lit(" - "), named)),
            parts(head(F.length(named)), named),
        )
        .when(
            F.contains(raw, F.lit(" - ")),
            parts(head(F.length(tail)), F.when(is_named, named).otherwise(strip(tail))),
        )
        .otherwise(parts(raw, F.when(is_named, named).otherwise(F.lit(UNKNOWN_SOURCE))))
    )
