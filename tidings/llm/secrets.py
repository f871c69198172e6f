"""Secrets in texts: known shapes, and strings whose characters are too evenly spread.

Candidates are long runs of key characters. A window of `WINDOW` characters slides over each one.
The counts of all key characters travel along, packed into a few numbers, and the sum of c*log2(c) is
kept up to date from the two that change, so the Shannon entropy of every window is known. A window
counts when it passes the limit of its character class. Letters alone, digits alone and what the allow-list names
(placeholders, ids in the form of a UUID) never count. A placeholder excuses the piece between
separators (/ _ = -) that it stands in; what lies before and after it is judged on its own.

Columns only, no shuffle. Patterns repeat single characters, never groups, and places are running
sums by parts, so long texts, rulers and base64 neither overflow a stack nor copy arrays over and over. Offsets count code points, ends are exclusive. Defined results: a null
text is empty; spans of one start are in the order of `KINDS`; repeated rows give the same result;
other columns are kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.functions.binding import let

# The shapes that every result must contain.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
VALUE_MIN = 6

KINDS = ["assign", "access", "hex", "entropy"]
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
# bits per character; 20 different characters would have 4.32
LIMITS = {"hex": 3.0, "mixed": 3.5}
ALLOWED = r"(?i)(?:example|sample|dummy|placeholder|changeme|x{6}|0{8}|123456|abcdef)"
UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
# a piece between separators with a placeholder in it
EXCUSED = rf"(?<![A-Za-z0-9+])[A-Za-z0-9+]*?{ALLOWED}[A-Za-z0-9+]*+"
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
PACK, BITS = 12, 5  # counts in a number, bits of a count; a window is shorter than 2 ** BITS
PART = 256  # elements whose running values are made together
SPAN = "array<struct<start:int,stop:int,value:string>>"
MASK = "[secret]"


def running(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """For each of the whole numbers `values` (one at least), all before it put together by `step`,
    from 0. Parts are put together first, so that no long array is copied for every element."""
    def along(part: Column, start: Column) -> Column:
        zero = F.struct(start.cast("int").alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(part, zero, lambda a, x: F.struct(
            step(a["at"], x).cast("int").alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])

    last = F.floor((F.size(values) - 1) / PART).cast("int")
    parts = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(values, k * PART + 1, F.lit(PART)))
    return let(parts, lambda parts: let(
        along(F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, x: step(a, x).cast("int"))), F.lit(0)),
        lambda starts: F.flatten(F.transform(parts, lambda p, k: along(p, F.get(starts, k))))))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """(start, stop, value) of every match, leftmost and not overlapping. `value` is the text of
    `group`. What lies between the matches gives their places."""
    def place(gaps: Column, found: Column, values: Column) -> Column:
        both = F.transform(found, lambda f, i: F.length(F.get(gaps, i)) + F.length(f))
        return let(running(both, lambda a, x: a + x), lambda before: F.transform(values, lambda v, i: F.struct(
            (F.get(before, i) + F.length(F.get(gaps, i))).alias("start"),
            (F.get(before, i) + F.length(F.get(gaps, i)) + F.length(F.get(found, i))).alias("stop"), v.alias("value"))))

    some = let(F.split(text, pattern, -1), lambda gaps: let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: let(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found,
            lambda values: place(gaps, found, values))))
    return F.when(F.rlike(text, F.lit(pattern)), some).otherwise(F.array().cast(SPAN))


def hot_windows(value: Column, limit: Column, width: int = WINDOW) -> Column:
    """(first, last): starts of the first and last window of `value` whose entropy reaches
    `limit`, -1 without any. `value` has `width` characters or more, all of `ALPHABET`."""
    spread = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(width + 1)])  # c * log2(c)
    numbers = -(-len(ALPHABET) // PACK)
    word = lambda code: F.floor(code / PACK).cast("int")
    shift = lambda code: (code % PACK) * BITS

    def count(packed: Column, code: Column) -> Column:
        shifted = F.call_function("shiftright", F.get(packed, word(code)), shift(code))
        return shifted.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")

    def put(packed: Column, code: Column, by: int) -> Column:
        one = F.call_function("shiftleft", F.lit(by).cast("long"), shift(code))
        return F.transform(packed, lambda n, k: F.when(k == word(code), n + one).otherwise(n))

    def moved(a: Column, code: Column, by: int) -> Column:
        """The counts and their sum after one more or one less of `code`."""
        return let(count(a["counts"], code), lambda c: F.struct(
            (a["total"] + F.get(spread, c + by) - F.get(spread, c)).alias("total"), put(a["counts"], code, by).alias("counts")))

    def seen(a: Column, i: Column, first: Column, last: Column) -> Column:
        hot = F.lit(math.log2(width)) - a["total"] / width >= limit
        return F.struct(a["total"].alias("total"), a["counts"].alias("counts"),
                        F.when(hot & (first < 0), i).otherwise(first).alias("first"), F.when(hot, i).otherwise(last).alias("last"))

    def slide(codes: Column) -> Column:
        empty = F.struct(F.lit(0.0).alias("total"), F.array_repeat(F.lit(0).cast("long"), numbers).alias("counts"))
        opening = F.aggregate(F.slice(codes, 1, width), empty, lambda a, c: moved(a, c, 1))

        def step(a: Column, i: Column) -> Column:
            out, into = F.get(codes, i - 1), F.get(codes, i + width - 1)
            same = F.struct(a["total"].alias("total"), a["counts"].alias("counts"))
            changed = F.when(out == into, same).otherwise(let(moved(a, out, -1), lambda b: moved(b, into, 1)))
            return let(changed, lambda b: seen(b, i, a["first"], a["last"]))

        later = F.when(F.size(codes) > width, F.sequence(F.lit(1), F.size(codes) - width)).otherwise(F.array().cast("array<int>"))
        begun = let(opening, lambda b: seen(b, F.lit(0), F.lit(-1), F.lit(-1)))
        return F.aggregate(later, begun, step, lambda a: F.struct(a["first"].alias("first"), a["last"].alias("last")))

    letters = F.array_remove(F.split(value, ""), "")
    return let(F.transform(letters, lambda c: F.call_function("instr", F.lit(ALPHABET), c) - 1), slide)


def stretches(text: Column, width: int = WINDOW) -> Column:
    """The candidates; of one with placeholders, what lies outside their pieces."""
    def between(c: Column, excused: Column) -> Column:
        begin = lambda i: c["start"] + F.when(i > 0, F.get(excused, i - 1)["stop"]).otherwise(0)
        gaps = F.transform(F.split(c["value"], EXCUSED, -1), lambda g, i: F.struct(
            begin(i).alias("start"), (begin(i) + F.length(g)).alias("stop"), g.alias("value")))
        return F.filter(gaps, lambda g: F.length(g["value"]) >= width)

    def outside(c: Column) -> Column:
        return let(matches(c["value"], EXCUSED), lambda excused: between(c, excused))

    def parted(c: Column) -> Column:
        return F.when(F.rlike(c["value"], F.lit(UUID)), F.array().cast(SPAN)).when(
            F.rlike(c["value"], F.lit(ALLOWED)), outside(c)).otherwise(F.array(c))

    return F.flatten(F.transform(matches(text, CANDIDATE), parted))


def entropy_spans(text: Column, width: int = WINDOW, limits: dict[str, float] = LIMITS) -> Column:
    """Spans of the candidates' windows that pass the limit of their class."""
    def judged(c: Column) -> Column:
        value = c["value"]
        mixed = F.rlike(value, F.lit("[0-9]")) & F.rlike(value, F.lit("[A-Za-z]"))
        is_hex = F.rlike(value, F.lit("^([0-9a-f]+|[0-9A-F]+)$"))
        limit = F.when(is_hex, limits["hex"]).otherwise(limits["mixed"])
        hot = F.when(mixed, let(limit, lambda known: hot_windows(value, known, width)))
        return let(hot, lambda h: F.struct(
            (c["start"] + h["first"]).alias("start"), (c["start"] + h["last"] + width).alias("stop"),
            F.when(h["first"] >= 0, value).alias("value"),
        ))

    return F.filter(F.transform(stretches(text, width), judged), lambda s: s["value"].isNotNull())


def _numbered(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["stop"].alias("stop")))


def found(text: Column) -> Column:
    """Sorted (start, kind, stop), kind a place in `KINDS`. Spans of the entropy search that meet a
    known shape are left out."""
    assign = F.filter(matches(text, ASSIGN, 1), lambda s: F.length(s["value"]) >= VALUE_MIN)
    base = F.concat(_numbered(assign, "assign"), _numbered(matches(text, ACCESS), "access"), _numbered(matches(text, HEX), "hex"))
    clear = lambda known: F.filter(
        _numbered(entropy_spans(text), "entropy"),
        lambda s: ~F.exists(known, lambda k: (k["start"] < s["stop"]) & (s["start"] < k["stop"])),
    )
    return let(base, lambda known: F.array_sort(F.concat(known, clear(known))))


def scan(documents: DataFrame) -> DataFrame:
    """The documents with `secrets`, the spans found in the text."""
    return documents.withColumn("secrets", found(F.coalesce("text", F.lit(""))))


def told(spans: Column) -> Column:
    """kind:start:stop of the spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def redact(documents: DataFrame) -> DataFrame:
    """The documents with every secret replaced by `MASK`, `n_chars` brought up to date."""
    text = F.coalesce("text", F.lit(""))

    def masked(spans: Column, before: Column, letters: Column) -> Column:
        """What lies between the spans; one that begins inside an earlier one adds no mask."""
        piece = lambda a, b: F.array_join(F.slice(letters, a + 1, F.greatest(b - a, F.lit(0))), "")
        parts = F.transform(spans, lambda s, i: F.when(
            s["start"] >= F.get(before, i), F.concat(piece(F.get(before, i), s["start"]), F.lit(MASK))).otherwise(F.lit("")))
        end = F.array_max(F.transform(spans, lambda s: s["stop"]))
        return F.concat(F.array_join(parts, ""), piece(end, F.size(letters)))

    def joined(spans: Column) -> Column:
        stops = running(F.transform(spans, lambda s: s["stop"]), lambda a, x: F.greatest(a, x))
        letters = F.array_remove(F.split(text, ""), "")
        return let(stops, lambda before: let(letters, lambda letters: masked(spans, before, letters)))

    spare = "secrets"
    while spare in documents.columns:
        spare += "_"
    clean = F.when(F.size(spare) == 0, F.col("text")).otherwise(joined(F.col(spare)))
    out = documents.withColumn(spare, found(text)).withColumn("text", clean).drop(spare)
    return out.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType)) if "n_chars" in documents.columns else out
