"""Canonical article links and the dedup key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidings.functions.binding import let
from tidings.functions.text import normalize_text, strip

# Query parameters that do not identify an article (a prefix and whole names).
TRACKING_PREFIX = "utm_"
TRACKING_NAMES = ("oc", "gclid", "fbclid", "mc_cid", "mc_eid", "cmpid", "ref", "ncid")

# authority, path, query
_HTTP_LINK = r"(?s)^(?i:https?)://([^/?#]+)([^?#]*)(?:\?([^#]*))?(?:#.*)?\z"
_TRACKING_PIECE = (
    rf"(?i)(?:^|&)(?:{TRACKING_PREFIX}[^=&]*|{'|'.join(TRACKING_NAMES)})(?:=[^&]*)?(?=&|\z)"
)
_ONE_PLAIN_PAIR = r"^(?:[A-Za-z0-9_.~-]*=[A-Za-z0-9_.~-]*)?\z"
_STRAY_PERCENT = "%(?![0-9A-Fa-f]{2})"
_PLAIN = "^[A-Za-z0-9_.~-]*\\z"


def _decode(text: Column) -> Column:
    """Form decoding that leaves a percent sign without two hex digits as it is. Most text has
    nothing to decode and is passed through."""
    fixed = F.regexp_replace(text, _STRAY_PERCENT, "%25")
    coded = F.contains(text, F.lit("%")) | F.contains(text, F.lit("+"))
    return F.when(coded, F.coalesce(F.try_url_decode(fixed), text)).otherwise(text)


def _encode(text: Column) -> Column:
    """Form encoding where the tilde is plain and the asterisk is escaped."""
    coded = F.replace(
        F.replace(F.url_encode(text), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A")
    )
    return F.when(F.rlike(text, F.lit(_PLAIN)), text).otherwise(coded)


def _query_pair(piece: Column) -> Column:
    key = F.substring_index(piece, "=", 1)
    value = F.substr(piece, F.length(key) + 2)
    return F.struct(_decode(key).alias("key"), _decode(value).alias("value"))


def _is_tracking(pair: Column) -> Column:
    key = F.lower(pair["key"])
    return F.startswith(key, F.lit(TRACKING_PREFIX)) | key.isin(*TRACKING_NAMES)


def _canonical_query(query: Column) -> Column:
    """Parameters without tracking, sorted and encoded.

    Most links keep no parameter or a single plain one, and then taking the tracking pieces out
    of the text is enough."""
    rest = F.ltrim(F.regexp_replace(query, _TRACKING_PIECE, ""), F.lit("&"))

    def choose(kept: Column) -> Column:
        simple = ~F.contains(query, F.lit("%")) & F.rlike(kept, F.lit(_ONE_PLAIN_PAIR))
        return F.when(simple, kept).otherwise(_sorted_query(query))

    return let(rest, choose)


def _sorted_query(query: Column) -> Column:
    pieces = F.filter(F.split(query, "&"), lambda p: p != "")
    pairs = F.filter(F.transform(pieces, _query_pair), lambda p: ~_is_tracking(p))
    encoded = F.transform(
        F.sort_array(pairs),
        lambda p: F.concat(_encode(p["key"]), F.lit("="), _encode(p["value"])),
    )
    return F.array_join(encoded, "&")


def normalize_link(link: Column) -> Column:
    """One spelling per article: https, lower-case host without one leading `www.`, no fragment,
    no tracking parameters, remaining parameters decoded, sorted and encoded again, no trailing
    slash. Null without a usable http(s) link."""
    url = F.regexp_replace(strip(link), "[\t\r\n]", "")
    # a line feed cannot occur in `url`, so it separates the parts
    parts = F.split(F.regexp_replace(url, _HTTP_LINK, "$1\n$2\n$3"), "\n", -1)
    return let(parts, lambda p: F.when(F.size(p) == 3, _assemble(p[0], p[1], p[2])))


def _assemble(authority: Column, path: Column, query: Column) -> Column:
    lower = F.lower(authority)
    host = F.when(F.startswith(lower, F.lit("www.")), F.substr(lower, F.lit(5))).otherwise(lower)
    bare_path = F.rtrim(path, F.lit("/"))
    pieces = F.array(
        F.concat(F.lit("https://"), host, F.when(bare_path == "", "/").otherwise(bare_path)),
        F.when(query != "", let(_canonical_query(query), lambda q: F.when(q != "", q))),
    )
    return F.array_join(pieces, "?")


def dedup_key(link: Column, title: Column, source: Column) -> Column:
    """16 hex digits that identify a story: by canonical link, else by title and source."""
    by_link = F.concat(F.lit("link:"), normalize_link(link))
    by_text = F.concat(
        F.lit("title:"), normalize_text(title), F.lit("|source:"), normalize_text(source)
    )
    key = F.substr(F.sha2(F.coalesce(by_link, by_text), 256), F.lit(1), F.lit(16))
    # never null, and said so: otherwise joins on the key add a null check that computes it twice
    return F.coalesce(key, F.lit(""))
