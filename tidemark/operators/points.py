"""Building points and applying changes to a set of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: product of an item without one.
DEFAULT_PRODUCT = "General"

POINT_SCHEMA = (
    "id string, vector array<float>, payload struct<question:string,answer:array<string>,"
    "product:string,keywords:array<string>,source:string>"
)


def build_points(items: DataFrame) -> DataFrame:
    """``(id, vector, payload)`` from items with ``point_id``, ``vector`` and ``chunks``.

    An answer without chunks is kept whole as its only chunk. Other columns pass through.
    """
    no_keywords = F.array().cast("array<string>")
    payload = F.struct(
        F.col("q").alias("question"),
        F.when(F.size("chunks") > 0, F.col("chunks")).otherwise(F.array("a")).alias("answer"),
        F.coalesce("product", F.lit(DEFAULT_PRODUCT)).alias("product"),
        F.coalesce("keywords", no_keywords).alias("keywords"),
        F.col("source").alias("source"),
    )
    used = {"point_id", "vector", "q", "a", "chunks", "product", "keywords", "source"}
    return items.select(
        F.col("point_id").alias("id"), F.col("vector").cast("array<float>").alias("vector"),
        payload.alias("payload"), *[c for c in items.columns if c not in used],
    )


def apply_changes(points: DataFrame, upserts: DataFrame, delete_ids: DataFrame, key: str = "id") -> DataFrame:
    """The set after replacing or adding ``upserts`` and removing ``delete_ids``.

    Upserts come first and deletes second, so an id in both ends up deleted.
    """
    gone = delete_ids.select(key)
    untouched = points.join(upserts.select(key).unionByName(gone), key, "left_anti")
    return untouched.unionByName(upserts.join(gone, key, "left_anti").select(*points.columns))
