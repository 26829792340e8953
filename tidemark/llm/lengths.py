"""Exact histogram of encoded lengths and what its suffix sums answer.

Documents are aggregated by their number of token ids; the histogram has one row per length that
occurs, however many documents there are. From it, for each length L:

* ``docs_over`` and ``tokens_over``: documents longer than L, and their tokens;
* ``tokens_truncated``: tokens left if every document is cut to L, for the context limit L;
* ``docs_within`` over ``docs`` in all is the quantile of L.

The sums run within blocks of lengths and then over one row per block, so no task sorts the
whole histogram. Limits between two lengths follow from the row below (:func:`at_limits`).

Defined cases: null and empty texts have length 0 and count; repeated rows count each; an empty
table gives an empty histogram.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import encoder, vocabulary
from tidemark.llm.common import map_rows

#: Lengths in one block of the two-level sums.
BLOCK = 256


def histogram(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``n_tokens``, ``docs``: documents of each encoded length."""
    broadcast = vocabulary(docs.sparkSession, path, pattern)

    def lengths(part: pa.RecordBatch) -> list[tuple]:
        return [(len(ids) // 4,) for ids in encoder(broadcast).encode_many(part.column("text").to_pylist())]

    counted = map_rows(docs.select(F.col(text).alias("text")), lengths, "n_tokens long", "text")
    return counted.groupBy("n_tokens").agg(F.count("*").alias("docs"))


def suffix_sums(counts: DataFrame) -> DataFrame:
    """``n_tokens``, ``docs``, ``docs_within``, ``docs_over``, ``tokens_over``, ``tokens_truncated`` per length.

    ``counts``: ``n_tokens``, ``docs``, small enough to be read twice (write it first).
    """
    counts = counts.withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    tokens = F.col("n_tokens") * F.col("docs")
    blocks = counts.groupBy("block").agg(F.sum("docs").alias("d"), F.sum(tokens).alias("t"))
    after = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    later = blocks.select(
        "block", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("t").over(after), F.lit(0)).alias("later_tokens"), F.sum("d").over(every).alias("all_docs"),
        F.sum("t").over(every).alias("all_tokens"),
    )
    above = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    summed = (
        counts.withColumn("d", F.coalesce(F.sum("docs").over(above), F.lit(0)))
        .withColumn("t", F.coalesce(F.sum(tokens).over(above), F.lit(0)))
        .join(later, "block")
        .withColumn("docs_over", F.col("d") + F.col("later_docs"))
        .withColumn("tokens_over", F.col("t") + F.col("later_tokens"))
        .withColumn("docs_within", F.col("all_docs") - F.col("docs_over"))
    )
    return summed.select(
        "n_tokens", "docs", "docs_within", "docs_over", "tokens_over",
        (F.col("all_tokens") - F.col("tokens_over") + F.col("n_tokens") * F.col("docs_over")).alias("tokens_truncated"),
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """``limit``, ``docs_within``, ``docs_over``, ``tokens_truncated`` for any context limits."""
    wanted = F.explode(F.array(*[F.lit(x).cast("long") for x in limits]))
    total = F.sum(F.col("n_tokens") * F.col("docs"))
    cut = F.sum(F.least("n_tokens", "limit") * F.col("docs"))
    within = F.sum(F.when(F.col("n_tokens") <= F.col("limit"), F.col("docs")).otherwise(0))
    return (
        sums.withColumn("limit", wanted).groupBy("limit")
        .agg(within.alias("docs_within"), (F.sum("docs") - within).alias("docs_over"), cut.alias("tokens_truncated"),
             total.alias("tokens"))
    )


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """``share``, ``n_tokens``: the smallest length with at least that share of the documents within it."""
    wanted = F.explode(F.array(*[F.lit(float(x)) for x in shares]))
    docs = F.col("docs_within") + F.col("docs_over")
    return (
        sums.withColumn("share", wanted).where(F.col("docs_within") >= F.col("share") * docs)
        .groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
    )
