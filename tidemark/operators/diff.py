"""Comparing the current items with the previous state.

Everything here works on narrow rows (id, hash, source, position). Texts and
vectors are fetched later, and only for the rows that changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INSERT, UPDATE, UNCHANGED, DELETE = "insert", "update", "unchanged", "delete"


def dedup_last(df: DataFrame, key: str = "point_id", order: tuple[str, ...] = ("source", "pos")) -> DataFrame:
    """Keep the last row per key, whole.

    Rank 1 lets Spark drop the losers inside each map task, so a key with very
    many copies reaches the shuffle as one row per task.
    """
    window = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def current_points(identified: DataFrame) -> DataFrame:
    """One narrow row per id: ``point_id, source_file, pos, question_hash, copies``.

    The last item by (source, pos) wins; ``copies`` counts all of them.
    """
    last = F.max(F.struct("source", "pos", "question_hash"))
    return (
        identified.groupBy("point_id")
        .agg(last.alias("last"), F.count(F.lit(1)).alias("copies"))
        .select(
            "point_id", F.col("last.source").alias("source_file"), F.col("last.pos").alias("pos"),
            F.col("last.question_hash").alias("question_hash"), "copies",
        )
    )


def _operation() -> Column:
    known_before = F.col("p.point_id").isNotNull() & (
        F.col("p.source_file").isNotNull() | F.col("p.question_hash").isNotNull()
    )
    return (
        F.when(F.col("c.point_id").isNull(), DELETE)
        .when(~known_before, INSERT)
        .when(F.col("c.question_hash").eqNullSafe(F.col("p.question_hash")), UNCHANGED)
        .otherwise(UPDATE)
    )


def compare(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Classify every id of either side in one full outer join.

    ``current`` comes from :func:`current_points`, ``previous`` is the state
    table with unique ids. Result: ``point_id, op, source_file, pos,
    question_hash, copies, previous_source, previous_hash, was_known``; for a
    delete the current columns are null. An entry without source and hash counts
    as new although its id was known.
    """
    return _classified(current, previous, "full_outer")


def compare_upserts(current: DataFrame, previous: DataFrame, small: bool = False) -> DataFrame:
    """:func:`compare` without the ids that only ``previous`` has, which is then only looked up.

    ``small`` says the caller has counted ``current`` and its ids fit a broadcast: ``previous`` is scanned and
    not exchanged, and what it knows of these ids is as small.
    """
    if small:
        known = previous.join(F.broadcast(current.select("point_id")), "point_id", "left_semi")
        return _classified(current, F.broadcast(known), "left")
    return _classified(current, previous, "left")


def _classified(current: DataFrame, previous: DataFrame, how: str) -> DataFrame:
    c, p = current.alias("c"), previous.alias("p")
    return c.join(p, F.col("c.point_id") == F.col("p.point_id"), how).select(
        F.coalesce("c.point_id", "p.point_id").alias("point_id"),
        _operation().alias("op"),
        F.col("c.source_file").alias("source_file"),
        F.col("c.pos").alias("pos"),
        F.col("c.question_hash").alias("question_hash"),
        F.coalesce("c.copies", F.lit(0).cast("bigint")).alias("copies"),
        F.col("p.source_file").alias("previous_source"),
        F.col("p.question_hash").alias("previous_hash"),
        F.col("p.point_id").isNotNull().alias("was_known"),
    )


def diff(identified: DataFrame, previous: DataFrame) -> DataFrame:
    """:func:`compare` straight from items that carry ``point_id`` and ``question_hash``."""
    return compare(current_points(identified), previous)


def inserts(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Current rows whose id has no usable previous entry."""
    usable = previous.where("source_file IS NOT NULL OR question_hash IS NOT NULL")
    return current.join(usable, "point_id", "left_anti")


def updates(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Current rows with a previous entry that holds another hash, or none."""
    c, p = current.alias("c"), previous.alias("p")
    same_id = F.col("c.point_id") == F.col("p.point_id")
    usable = F.col("p.source_file").isNotNull() | F.col("p.question_hash").isNotNull()
    differs = ~F.col("c.question_hash").eqNullSafe(F.col("p.question_hash"))
    return c.join(p, same_id & usable & differs, "left_semi")


def unchanged(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Current rows whose hash equals the previous one."""
    return current.join(previous.select("point_id", "question_hash"), ["point_id", "question_hash"], "left_semi")


def deletions(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Previous rows whose id is gone."""
    return previous.join(current, "point_id", "left_anti")


def keep_sources(
    compared: DataFrame, sources: DataFrame, small: bool = False, salts: int = 32
) -> DataFrame:
    """Take back the deletes of points whose file could not be read this time.

    ``small`` says the caller has counted ``sources`` and they fit a broadcast.
    Otherwise only the deletes are joined, salted, as one source may hold very
    many of them.
    """
    unread = sources.select(F.col("source").alias("previous_source")).distinct().withColumn("_unread", F.lit(True))
    op = F.when((F.col("op") == DELETE) & F.col("_unread"), UNCHANGED).otherwise(F.col("op"))
    if small:
        joined = compared.join(F.broadcast(unread), "previous_source", "left")
        return joined.withColumn("op", op).select(*compared.columns)
    rest, gone = compared.where(F.col("op") != DELETE), compared.where(F.col("op") == DELETE)
    salted = gone.withColumn("_salt", F.pmod(F.xxhash64("point_id"), F.lit(salts)))
    copies = unread.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    joined = salted.join(copies, ["previous_source", "_salt"], "left")
    return rest.unionByName(joined.withColumn("op", op).select(*compared.columns))


def op_counts(compared: DataFrame) -> DataFrame:
    """Distinct ids and item rows per operation."""
    return compared.groupBy("op").agg(
        F.count(F.lit(1)).alias("ids"), F.sum("copies").alias("items")
    )


def next_state(compared: DataFrame) -> DataFrame:
    """State after the run: every id that was not deleted, as it is now."""
    return compared.where(F.col("op") != DELETE).select(
        "point_id",
        F.coalesce("source_file", "previous_source").alias("source_file"),
        F.coalesce("question_hash", "previous_hash").alias("question_hash"),
    )
