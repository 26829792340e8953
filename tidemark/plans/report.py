"""Counters of a run as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.corpus import FILE_ERRORS


def corpus_counts(files: DataFrame) -> DataFrame:
    """One row of totals from :func:`tidemark.sources.corpus.file_stats`."""
    failed = F.col("status").isin(*FILE_ERRORS)
    return files.agg(
        F.count(F.lit(1)).alias("files_found"),
        F.count_if(~failed).alias("files_parsed"),
        F.count_if(failed).alias("files_failed"),
        F.count_if(F.col("status") == "too_large").alias("files_too_large"),
        F.count_if(F.col("valid_items") > 0).alias("files_with_items"),
        F.coalesce(F.sum("valid_items"), F.lit(0)).alias("items_valid"),
        F.coalesce(F.sum("invalid_items"), F.lit(0)).alias("items_invalid"),
    )


def change_counts(compared: DataFrame, force: bool = False) -> DataFrame:
    """One row of totals from a comparison. With ``force`` every current item is attempted."""
    op = F.col("op")
    current = op != "delete"
    process = current & F.col("pos").isNotNull() if force else op.isin("insert", "update")
    zero = F.lit(0)
    return compared.agg(
        F.coalesce(F.sum("copies"), zero).alias("evaluated"),
        F.coalesce(F.sum(F.when(process, F.col("copies"))), zero).alias("attempted"),
        F.count_if(process).alias("to_upsert"),
        F.count_if(op == "insert").alias("inserted"),
        F.count_if(op == "update").alias("updated"),
        F.count_if(op == "unchanged").alias("unchanged"),
        F.count_if(op == "delete").alias("to_delete"),
        F.count_if("was_known").alias("previous_points"),
    )
