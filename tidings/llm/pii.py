"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, `+digit`, `digit.digit`, two digits with at most
one blank or hyphen between them, `://`, and cue words such as IBAN. A small parser for each kind
grows the span from the anchor to its borders and checks it; an anchor inside the last match of
its kind is passed over, which gives leftmost matches that do not overlap.

Offsets count code points, ends are exclusive. Defined results: a null or empty text has no spans;
repeated rows give the same result; other columns are kept.
"""

from __future__ import annotations

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "userinfo", "account"]
CUES = ["iban", "ssn", "passport", "account", "acct", "konto", "cuenta", "compte"]
DIGITS = frozenset("0123456789")
ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
LOCAL, LABEL = ALNUM | set("._%+-"), ALNUM | set("-")
PHONE = DIGITS | set(" ().-")


def automaton() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    anchors: dict[str, list[str]] = {"@": ["email"], "://": ["userinfo"]}
    for a in sorted(DIGITS):
        anchors[f"+{a}"] = ["phone"]
        for b in sorted(DIGITS):
            anchors[f"{a}.{b}"] = ["ip"]
            for between in ("", " ", "-"):
                anchors[f"{a}{between}{b}"] = ["card"]
    for cue in CUES:
        for form in (cue, cue.upper(), cue.capitalize()):
            anchors[form] = ["account"]
    for text, kinds in anchors.items():
        made.add_word(text, (kinds[0], len(text)))
    made.make_automaton()
    return made


def _right(text: str, at: int, allowed: frozenset) -> int:
    while at < len(text) and text[at] in allowed:
        at += 1
    return at


def _left(text: str, at: int, floor: int, allowed: frozenset) -> int:
    while at > floor and text[at - 1] in allowed:
        at -= 1
    return at


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


# Each parser gets the text, the anchor's first and last place and the end of the kind's last
# match; it returns (start, stop, valid) or None where nothing begins.

def email(text, first, last, floor):
    start = _left(text, first, floor, LOCAL)
    stop, labels = first, 0
    while True:  # labels, each after the at-sign or a single dot
        end = _right(text, stop + 1, LABEL)
        if end == stop + 1:
            break
        stop, labels = end, labels + 1
        if stop >= len(text) or text[stop] != ".":
            break
    return (start, stop, True) if start < first and labels >= 2 else None


def ip(text, first, last, floor):
    start = _left(text, first, floor, DIGITS)
    parts, at = [], start
    while len(parts) < 4:
        end = _right(text, at, DIGITS)
        if end == at:
            return None
        parts.append(text[at:end])
        at = end + 1
        if len(parts) < 4 and (end >= len(text) or text[end] != "."):
            return None
    return start, at - 1, all(len(p) <= 3 and int(p or 0) <= 255 for p in (p.lstrip("0") for p in parts))


def card(text, first, last, floor):
    stop = last + 1
    while stop < len(text):
        if text[stop] in DIGITS:
            stop += 1
        elif text[stop] in " -" and stop + 1 < len(text) and text[stop + 1] in DIGITS:
            stop += 2
        else:
            break
    digits = text[first:stop].replace(" ", "").replace("-", "")
    return first, stop, 13 <= len(digits) <= 19 and luhn(digits)


def phone(text, first, last, floor):
    run = _right(text, last + 1, PHONE)
    while run > last + 2 and text[run - 1] not in DIGITS:
        run -= 1
    if run <= last + 2:
        return None
    return first, run, 9 <= sum(c in DIGITS for c in text[first:run]) <= 15


def userinfo(text, first, last, floor):
    """scheme://user[:password]@host"""
    start = _left(text, first, floor, ALNUM | set("+.-"))
    at = _right(text, last + 1, LOCAL | set(":"))
    if start == first or at == last + 1 or at >= len(text) or text[at] != "@":
        return None
    host = _right(text, at + 1, LABEL | set("."))
    return (start, host, True) if host > at + 1 else None


def account(text, first, last, floor):
    """A cue, at most a few signs or `no`, then six characters or more with four digits."""
    if first and text[first - 1].isalpha():
        return None
    at = _right(text, last + 1, frozenset(" :#.=-"))
    for word in ("number", "no", "nr"):
        if at > last + 1 and text[at : at + len(word)].lower() == word:
            at = _right(text, at + len(word), frozenset(" :#.=-"))
    stop = _right(text, at, ALNUM | set("-")) if at > last + 1 else at
    value = text[at:stop]
    return (at, stop, True) if len(value) >= 6 and sum(c in DIGITS for c in value) >= 4 else None


PARSERS = {"email": email, "ip": ip, "card": card, "phone": phone, "userinfo": userinfo, "account": account}


def find(text: str | None, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, stop), by kind as listed, then start."""
    out: dict[str, list] = {k: [] for k in KINDS}
    floor = dict.fromkeys(KINDS, 0)
    for last, (kind, length) in anchors.iter(text or ""):
        first = last - length + 1
        if first < floor[kind]:
            continue
        found = PARSERS[kind](text, first, last, floor[kind])
        if found is not None:
            floor[kind] = found[1]
            if found[2]:
                out[kind].append((kind, *found[:2]))
    return [span for kind in KINDS for span in out[kind]]


def scan(documents: DataFrame) -> DataFrame:
    """The documents with `pii`: an array of (kind, start, stop)."""

    @F.pandas_udf("array<struct<kind:string,start:int,stop:int>>")
    def spans(batches: pd.Series) -> pd.Series:
        anchors = automaton()
        return pd.Series([[dict(zip(("kind", "start", "stop"), s)) for s in find(t, anchors)] for t in batches])

    return documents.withColumn("pii", spans("text"))


def digest(documents: DataFrame) -> DataFrame:
    """(doc_id, counts, base_sha256, spans) from the spans of `scan`."""
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))
    return scan(documents.select("doc_id", "text")).select(
        "doc_id", *[count(k) for k in BASE], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("pii")).alias("spans"))
