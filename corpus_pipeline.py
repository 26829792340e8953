"""A training corpus from ``documents``: filtered, deduplicated, decontaminated, encoded.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before it has kept, and is
written before the next one reads it. All but the last return the columns of ``documents``; extra
columns travel along. A row is known by its content, so null or repeated ids are no special case.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontam, risk_rules, simhash, suffix_dedup
from tidemark.llm.common import discard, materialise, shared_folder
from tidemark.plans.tables import table

#: Bytes of a passage that may not occur twice: less than 50 words of any language here take.
PASSAGE = 250
#: Words of a shingle and differing bits of near duplicates, as in the operator's own query.
SHINGLE, DISTANCE = 3, 2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the risk-controlled cutoffs of their language."""
    scratch = shared_folder(spark)
    found = materialise(risk_rules.measured(docs), f"{scratch}/measured")
    narrow = found.select(
        F.col("row.doc_id").alias("k"), F.col("row.lang").alias("s"), F.xxhash64("row.text").alias("copy"),
        "base_failed", "shares",
    )
    cutoffs = materialise(
        risk_rules.calibrate_measured(narrow, table(spark, sf_dir, "labels")), f"{scratch}/cutoffs"
    )
    return risk_rules.verdicts(found, F.col("row.lang"), cutoffs).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked at SHINGLE words and DISTANCE bits: that with the smallest id.

    Null ids come last; of rows with one id, that with the smallest key of its text stays.
    """
    rows = docs.select(F.struct("*").alias("row")).select(
        suffix_dedup.text_key(F.coalesce(F.col("row.text"), F.lit("")).cast("binary")).alias("key"),
        F.col("row.doc_id").alias("id"), F.col("row.text").alias("text"), "row",
    )
    scratch = shared_folder(spark)
    prints = materialise(
        rows.select("key", "id", simhash.fingerprint_column(F.col("text"), SHINGLE).alias("fp")), f"{scratch}/prints"
    )
    found = simhash.near_duplicates(prints, f"{scratch}/work", "id", distance=DISTANCE)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("kept")
    kept = prints.join(found.select("fp", "root"), "fp").groupBy("root").agg(first)
    kept = materialise(kept.select(F.col("kept.key").alias("k"), F.col("kept.id").alias("i")), f"{scratch}/kept")
    discard(spark, f"{scratch}/work")
    chosen = rows.select("key", "id", "row").join(kept, (F.col("key") == F.col("k")) & F.col("id").eqNullSafe(F.col("i")))
    # Rows that repeat the chosen one, id and text, are left.
    return chosen.dropDuplicates(["key"]).select("row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without strings of PASSAGE bytes that also start elsewhere; characters cut in half go too.

    All copies of a passage go, as a document that has it is none the worse without; copies of whole texts are gone by now.
    """
    scratch = shared_folder(spark)
    rows, gone = suffix_dedup.removals(docs, f"{scratch}/work", length=PASSAGE)
    gone = gone.select(
        F.col("key"), F.when(F.coalesce("whole", F.lit(False)), F.lit(b"")).otherwise(F.col("kept")).alias("kept")
    )
    gone = materialise(gone, f"{scratch}/gone")
    discard(spark, f"{scratch}/work")
    text = F.coalesce(suffix_dedup.readable(F.col("kept")), F.col("row.text"))
    changed = rows.join(gone, "key", "left").select(F.col("row").withField("text", text).alias("row"))
    if "n_chars" in docs.columns:
        length = F.coalesce(F.length("row.text").cast("long"), F.lit(0).cast("long"))
        changed = changed.select(F.col("row").withField("n_chars", length.cast(docs.schema["n_chars"].dataType)).alias("row"))
    return changed.select("row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of a benchmark item."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), shared_folder(spark))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids`` (little-endian unsigned 32-bit integers) of each document."""
    vocabulary = bpe.vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = bpe.with_ids(docs.select("doc_id", "lang", "source", "text"), vocabulary)
    return coded.select(
        "doc_id", "lang", "source", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), "ids"
    )


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("decontamination", decontaminated),
    ("encoding", encoded),
]

#: The model-free stages could be told in SQL, the SimHash groups and the encoder could not.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), shared_folder(spark)
    for i, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"{scratch}/stage{i}")
    return docs
