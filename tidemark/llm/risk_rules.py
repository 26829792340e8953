"""Quality rules whose cutoffs come with a guarantee on false rejections.

Base rules are fixed: fewer than 50 words, or more than half of the words in repeated 3-word
windows. On top stand rules "share greater than a cutoff": symbols, capitals and exclamation marks
per character, repeated lines, repeated windows. Their cutoffs are selected per stratum on labelled
holdouts, from a ladder fixed in advance, so no text is used to make up a rule.

A rule may reject at most ``alpha / rules`` of a stratum's good texts, so all together at most
``alpha``. For each rung the exact binomial tail P(X <= k | n, alpha / rules) is the p-value of "the
rule rejects more than that", with k of n good holdout texts rejected. The ladder is tested from lenient
to strict and left at the first rung that fails (fixed-sequence testing needs no correction along the
ladder); rules and strata share ``delta`` by Bonferroni. With probability ``1 - delta`` no rule of any
stratum exceeds its share. A rule without a rung that passes rejects nothing, so a stratum with few
labels (under some 350 good texts at the defaults) keeps all that the base rules keep.

Everything is columns: words, lines and windows are arrays within the row (windows compared by their
64-bit hash), the tail is a sum of at most TERMS terms with a geometric bound for the rest, which can
only raise the p-value. Holdout texts are counted once however many copies or labels they have; a text
labelled both ways counts as bad.

Defined cases: null and empty texts have no words and fail the base rules; a null stratum is one of
its own; label rows without a document, or with null quality, are ignored; without labels only the base
rules reject.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What separates words.
_SPACE = "[\\x20\\x09-\\x0D]+"
_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"

#: Rungs of each rule, lenient to strict; a share above the cutoff rejects.
LADDERS: dict[str, tuple[float, ...]] = {
    "symbol_share": (0.5, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02),
    "loud_share": (0.9, 0.7, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15),
    "line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "window_share": (0.45, 0.4, 0.35, 0.3, 0.25, 0.2),
}
#: Largest share of a stratum's good texts that the rules may reject, and the chance of missing that.
ALPHA, DELTA = 0.08, 0.05
#: Terms of the binomial tail that are added up; the rest is bounded.
TERMS = 2000
#: Strata up to which the cutoffs are broadcast; beyond it they are joined by a shuffle.
BROADCAST_STRATA = 10_000


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` as struct ``row``; ``m``, the base measures; ``shares``, one per rule."""
    whole = F.coalesce(F.col("row")[text], F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: _without(x, _SPACES) != "")
    words = F.array_remove(F.split(whole, _SPACE, -1), "")
    first = docs.select(F.struct("*").alias("row")).select(
        "row", words.alias("w"), lines.alias("lines"),
        F.length(_without(whole, _SPACES)).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(_without(whole, _SYMBOLS))).cast("long").alias("n_symbols"),
        (F.length(whole) - F.length(F.regexp_replace(whole, "[\\p{Lu}!]", ""))).cast("long").alias("n_loud"),
    )
    # Positions of the 3-word windows, ordered by hash: equal windows become neighbours.
    windows = F.when(
        F.size("w") >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size("w") - 3),
            lambda i: F.struct(
                F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("p")
            ),
        ),
    ).otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))
    second = first.select("*", F.sort_array(windows).alias("s"))
    repeated = F.filter(
        "s", lambda x, i: (x["h"] == F.get("s", i - 1)["h"]) | (x["h"] == F.get("s", i + 1)["h"])
    )
    third = second.select("*", F.sort_array(F.transform(repeated, lambda x: x["p"])).alias("at"))
    covered = F.aggregate(
        "at", F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(3), p - s["last"])).cast("long").alias("n")),
        lambda s: s["n"],
    )
    base = F.struct(
        F.size("w").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"), F.size("lines").cast("long").alias("n_lines"), "n_loud",
    )
    # A generator keeps later filters above: pushed down, they would take the arrays' expressions into the
    # functions over their elements and work them out again for each.
    m = third.select(F.explode_outer(F.array(F.struct("row", base.alias("m")))).alias("x")).select("x.row", "x.m")

    def share(part: str, of: str) -> Column:
        return F.when(F.col("m")[of] > 0, F.col("m")[part] / F.col("m")[of]).otherwise(0.0)

    failed = (F.col("m.n_words") < 50) | (100 * F.col("m.n_repeat_words") > 50 * F.col("m.n_words"))
    return m.select("row", "m", failed.alias("base_failed"), F.struct(
        share("n_symbols", "word_chars").alias("symbol_share"), share("n_loud", "word_chars").alias("loud_share"),
        share("n_dup_lines", "n_lines").alias("line_share"), share("n_repeat_words", "n_words").alias("window_share"),
    ).alias("shares"))


def _log_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series at n + 10."""
    x = n + 10.0
    series = (x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x)
    series = series + 1 / (1260 * x * x * x * x * x)
    return reduce(lambda a, j: a - F.log(n + float(j)), range(1, 11), series)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of a binomial(n, p), from above; 1 where k is at or beyond the mean."""
    k, n = k.cast("double"), n.cast("double")
    top = (
        _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
        + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    factor = (1 - p) / p
    steps = F.when(k >= 1, F.sequence(F.lit(0), F.least(k, F.lit(float(TERMS))).cast("int") - 1)).otherwise(
        F.array().cast("array<int>")
    )
    added = F.aggregate(
        steps, F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda s, i: F.struct(
            (s["term"] * (k - i) / (n - k + i + 1) * factor).alias("term"),
            (s["total"] + s["term"] * (k - i) / (n - k + i + 1) * factor).alias("total"),
        ),
    )
    ratio = k / (n - k + 1) * factor
    rest = F.when(k > TERMS, added["term"] * ratio / (1 - ratio)).otherwise(0.0)
    return F.when(k >= n * p, 1.0).otherwise(F.least(F.lit(1.0), F.exp(top) * (added["total"] + rest)))


def select_cutoffs(holdout: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``stratum`` and a struct ``cutoffs`` (null: the rule rejects nothing).

    ``holdout``: ``stratum`` and ``shares`` of good labelled texts that pass the base rules.
    """
    rejected = [
        F.count_if(F.col("shares")[rule] > cutoff).alias(f"k_{rule}_{j}")
        for rule, ladder in LADDERS.items() for j, cutoff in enumerate(ladder)
    ]
    counts = holdout.groupBy("stratum").agg(F.count("*").alias("n"), *rejected)
    # One row per stratum by now.
    counts = counts.withColumn("strata", F.count("*").over(Window.partitionBy(F.lit(0))))
    rungs = counts.select("stratum", "n", "strata", F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(j).alias("j"), F.col(f"k_{rule}_{j}").alias("k"))
        for rule, ladder in LADDERS.items() for j in range(len(ladder))
    ])).alias("r")).select("stratum", "n", "strata", "r.*")
    failed = binomial_tail(F.col("k"), F.col("n"), alpha / len(LADDERS)) > delta / len(LADDERS) / F.col("strata")
    tested = rungs.withColumn("failed", failed)
    # The rung before the first that fails.
    stops = tested.groupBy("stratum").agg(*[
        F.coalesce(F.min(F.when((F.col("rule") == rule) & F.col("failed"), F.col("j"))), F.lit(len(ladder))).alias(rule)
        for rule, ladder in LADDERS.items()
    ])
    return stops.select("stratum", F.struct(*[
        F.get(F.array(*map(F.lit, ladder)), F.col(rule) - 1).alias(rule) for rule, ladder in LADDERS.items()
    ]).alias("cutoffs"))


def calibrate(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", stratum: str = "lang",
    alpha: float = ALPHA, delta: float = DELTA,
) -> DataFrame:
    """Cutoffs from documents that have a label in ``labels`` (``doc_id``, ``quality``)."""
    found = measured(docs.select(F.col(text).alias("t"), F.col(key).alias("k"), F.col(stratum).alias("s")), "t").select(
        F.col("row.k").alias("k"), F.col("row.s").alias("s"), "shares", "base_failed",
        F.xxhash64(F.col("row.t")).alias("copy"),
    )
    return calibrate_measured(found, labels, key, alpha, delta)


def calibrate_measured(
    found: DataFrame, labels: DataFrame, key: str = "doc_id", alpha: float = ALPHA, delta: float = DELTA
) -> DataFrame:
    """Like :func:`calibrate`, from ``k`` (id), ``s`` (stratum), ``shares``, ``base_failed``, ``copy`` (hash of the text)."""
    votes = labels.select(F.col(key).alias("k"), "quality").where("k IS NOT NULL AND quality IS NOT NULL")
    votes = votes.groupBy("k").agg(F.min("quality").alias("quality"))
    once = (
        found.where("NOT base_failed").join(votes, "k")
        .groupBy(F.col("s").alias("stratum"), "copy")
        .agg(F.min("quality").alias("quality"), *[F.max(F.col("shares")[r]).alias(r) for r in LADDERS])
    )
    return select_cutoffs(
        once.where("quality = 1").select("stratum", F.struct(*LADDERS).alias("shares")), alpha, delta
    )


def verdicts(found: DataFrame, stratum: Column, cutoffs: DataFrame) -> DataFrame:
    """``found`` (with ``base_failed`` and ``shares``) with ``kept``; ``cutoffs`` should be a written table."""
    rules = cutoffs.select(F.col("stratum").alias("cut_stratum"), "cutoffs")
    if rules.count() <= BROADCAST_STRATA:
        rules = F.broadcast(rules)
    over = reduce(
        lambda a, b: a | b,
        [F.coalesce(F.col("shares")[r] > F.col("cutoffs")[r], F.lit(False)) for r in LADDERS],
    )
    joined = found.join(rules, stratum.eqNullSafe(F.col("cut_stratum")), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~over).drop("cut_stratum", "cutoffs")
