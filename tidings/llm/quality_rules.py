"""Rule-based quality with risk-controlled cutoffs.

Signals per text are ratios; a rule rejects a text whose ratio lies above a cutoff. Cutoffs are
chosen per stratum (language) on labelled good texts: for every candidate on a fixed grid the
number of good texts above it gives an exact binomial (Clopper-Pearson) upper bound on the rate of
false rejection. A cutoff is certified when that bound is at most its share of `ALPHA`. The
confidence is split over rules and strata (Bonferroni). Within a rule the candidates are tested in
a fixed order, from the loosest to the tightest, and the first failure ends the testing, so they
need no further split: a false certificate means that the first candidate beyond the true limit
passed. (The count above a cutoff only grows as it tightens, so what passes is the candidates
that pass each for itself.) The guarantee holds for all rules and strata at once. Of the certified
cutoffs the one that rejects most bad texts is taken, the loosest on a tie; a rule with none
rejects nothing in that stratum.

A stratum with too few good texts to certify even a cutoff that none of them exceeds shares one
pool with all other such strata; its limit then holds for the texts of the pool together, not for
each of its languages. With S groups, the pool among them, a group needs ln(DELTA / rules / S) /
ln(1 - ALPHA / rules) labelled good texts past the base rule: 1,012 with two, 1,151 with four. Only
these numbers, never the values of the signals, decide what is pooled. A pool below that rejects
nothing by a rule, nor does a stratum without any labelled text past the base rule.

Columns only. Labelled texts are counted per grid cell before any shuffle. Defined results: a null
text has no words and fails the base rule; a null language is a stratum of its own; without labels
no rule rejects; labels that disagree about an id count as bad; repeated rows are judged alike.
Columns of the input stay, but for `text` and those named like a measure, `base_failed` or `kept`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidings.functions.binding import let
from tidings.llm.common import spare, stored, words

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
MIN_WORDS = 50
REPEAT_PERCENT = 50

ALPHA = 0.02  # false rejection of good texts, over all rules of a stratum
DELTA = 0.05  # chance that any of the guarantees fails
CELLS = 40  # candidates per rule
# signal -> width of a grid cell; candidates are 1..CELLS widths
RULES = {"symbols": 0.02, "length": 0.5, "dup_lines": 0.01, "repeats": 0.0125}


def repeat_words(array: Column, n: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    Hashes show whether any window repeats; only then are the windows themselves sorted."""
    at = F.sequence(F.lit(0), n - 3)

    def covered(windows: Column) -> Column:
        same = lambda a, b: (a["a"] == b["a"]) & (a["b"] == b["b"]) & (a["c"] == b["c"])
        twice = F.filter(windows, lambda x, i: F.coalesce(same(x, F.get(windows, i - 1)), F.lit(False))
                         | F.coalesce(same(x, F.get(windows, i + 1)), F.lit(False)))
        places = F.sort_array(F.transform(twice, lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("upto"))
        return F.aggregate(
            places, zero,
            lambda s, i: F.struct((s["total"] + i + 3 - F.greatest(i, s["upto"])).alias("total"), (i + 3).alias("upto")),
            lambda s: s["total"],
        )

    def exact(w: Column) -> Column:
        windows = F.transform(at, lambda i: F.struct(
            F.get(w, i).alias("a"), F.get(w, i + 1).alias("b"), F.get(w, i + 2).alias("c"), i.alias("i")))
        return let(F.sort_array(windows), covered)

    def some(w: Column) -> Column:
        hashes = F.transform(at, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(F.size(F.array_distinct(hashes)) == n - 2, F.lit(0)).otherwise(exact(w))

    return F.when(n < 4, F.lit(0)).otherwise(some(array)).cast("long")


def measures(documents: DataFrame) -> DataFrame:
    """The documents with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    parsed = documents.withColumns({
        "_words": words(F.col("text"), SPACE),
        "word_chars": F.length(F.regexp_replace(text, SPACE, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long"),
        "n_dup_lines": let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long"),
    })
    counted = parsed.withColumns({
        "n_words": F.size("_words").cast("long"), "n_repeat_words": repeat_words(F.col("_words"), F.size("_words")),
    }).drop("_words")
    return counted.withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    )


def signals() -> dict[str, Column]:
    """The ratio each rule looks at."""
    per_word = lambda c: F.try_divide(F.col(c).cast("double"), F.col("n_words"))
    return {
        "symbols": per_word("n_symbols"), "length": per_word("word_chars"),
        "dup_lines": per_word("n_dup_lines"), "repeats": per_word("n_repeat_words"),
    }


def cell(value: Column, width: float) -> Column:
    """Number of candidates that the value lies above: candidate c rejects it if cell >= c."""
    above = F.ceil(value / F.lit(width)) - 1
    return F.greatest(F.lit(0), F.least(F.lit(CELLS), F.coalesce(above, F.lit(0)))).cast("int")


def tail(n: Column, k: Column, rate: float) -> Column:
    """P(Binomial(n, rate) <= k). The Clopper-Pearson upper bound for k of n is at most `rate` at
    confidence 1 - d exactly when this is at most d. Terms are kept as logarithms."""
    odds = F.log(F.lit(rate / (1 - rate)))
    zero = F.struct((n * F.log(F.lit(1 - rate))).alias("log"), F.exp(n * F.log(F.lit(1 - rate))).alias("sum"))

    def step(a: Column, i: Column) -> Column:
        return let(a["log"] + F.log((n - i + 1) / i) + odds, lambda t: F.struct(t.alias("log"), (a["sum"] + F.exp(t)).alias("sum")))

    return F.when(k >= n, F.lit(1.0)).otherwise(F.aggregate(
        F.when(k > 0, F.sequence(F.lit(1), k.cast("int"))).otherwise(F.array().cast("array<int>")), zero, step, lambda a: a["sum"]))


def grouping(sizes: DataFrame, share: float, risk: float) -> tuple[DataFrame, int]:
    """`sizes` (stratum, n) with the group each stratum is tested in, null for the pool, and the
    number of groups. The largest strata stand alone, as many as can certify something at the
    confidence that so many groups and the pool leave each."""
    none_above = F.lit(1 - share)
    # no stratum below this stands alone, so at most (good texts / this) rows meet in the window
    able = sizes.filter(F.pow(none_above, F.col("n")) <= risk / 2)
    ranked = able.withColumn("m", F.row_number().over(W.orderBy(F.desc("n"), "stratum")))
    alone = ranked.filter(F.pow(none_above, F.col("n")) <= F.lit(risk) / (F.col("m") + 1)).agg(F.max("m")).first()[0] or 0
    groups = ranked.filter(F.col("m") <= alone).select("stratum", F.col("stratum").alias("group"))
    return sizes.join(groups, "stratum", "left"), alone + 1


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff): the chosen cutoff as a cell number, for the rules that have one."""
    good = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    cells = F.array(*[
        F.struct(F.lit(rule).alias("rule"), cell(signals()[rule], width).alias("cell")) for rule, width in RULES.items()
    ])
    counted = (
        measured.filter(~F.col("base_failed")).select("doc_id", F.coalesce(stratum, F.lit("")).alias("stratum"), F.inline(cells))
        .join(good, "doc_id")
        .groupBy("stratum", "rule", "cell")
        .agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") != 1).alias("bad"))
    )
    counted = stored(counted, "cells")
    # every text has a cell for each rule, so one rule counts them
    sizes = counted.filter(F.col("rule") == next(iter(RULES))).groupBy("stratum").agg(F.sum("good").alias("n"))
    share, risk = alpha / len(RULES), delta / len(RULES)
    grouped, groups = grouping(sizes, share, risk)
    grouped = stored(grouped.select("stratum", F.struct(F.col("group").isNull().alias("pooled"), F.coalesce("group", F.lit("")).alias("name")).alias("group")), "groups")
    counted = counted.join(grouped, "stratum").groupBy("group", "rule", "cell").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    # groups x rules x cells rows from here on
    from_top = W.partitionBy("group", "rule").orderBy(F.desc("cell"))
    grid = counted.select("group", "rule").distinct().select("*", F.explode(F.sequence(F.lit(0), F.lit(CELLS))).alias("cell"))
    rejected = grid.join(counted, ["group", "rule", "cell"], "left").select(
        "group", "rule", "cell",
        F.coalesce(F.sum("good").over(from_top), F.lit(0)).alias("k"), F.coalesce(F.sum("bad").over(from_top), F.lit(0)).alias("caught"),
        F.sum("good").over(W.partitionBy("group", "rule")).alias("n"),
    )
    # more than n * share rejections can never be certified, so their tails are not summed
    possible = rejected.filter((F.col("cell") > 0) & (F.col("k") <= F.col("n") * share))
    certified = possible.filter(tail(F.col("n"), F.col("k"), share) <= risk / groups)
    best = certified.filter("caught > 0").groupBy("group", "rule").agg(F.max_by("cell", F.struct("caught", "cell")).alias("cutoff"))
    return grouped.join(best, "group").select("stratum", "rule", "cutoff")


def verdicts(documents: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The documents without their texts, with the measures, `base_failed` and `kept`. The measures
    are stored: texts are read once, for the cutoffs and for the verdicts."""
    measured = stored(measures(documents).drop("text"), "measures")
    key, limits = spare("stratum", measured.columns), spare("cutoffs", measured.columns)
    chosen = cutoffs(measured, labels, stratum)
    # strata x rules rows, a map for each stratum
    per_stratum = chosen.groupBy(F.col("stratum").alias(key)).agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias(limits))
    joined = measured.join(per_stratum, F.coalesce(stratum, F.lit("")) == F.col(key), "left")
    rejects = [
        F.coalesce(cell(signals()[rule], width) >= F.try_element_at(limits, F.lit(rule)), F.lit(False)) for rule, width in RULES.items()
    ]
    kept = ~F.col("base_failed")
    for reject in rejects:
        kept = kept & ~reject
    return joined.withColumn("kept", kept).drop(key, limits)
