"""The supplied tables seen as a corpus, an earlier state, and raw files.

* current items: every document, and every user turn answered by the turn after it;
* earlier items: the documents somebody has labelled, the benchmark passages and
  the system prompts of conversations. Labelled documents are still there, the
  other two are gone from the current corpus;
* earlier state: the same, with the label deciding what the state remembers: the
  true hash, an outdated one, no hash, or an empty entry;
* raw files: one file per row of a table, well formed or not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.identity import with_identity
from tidemark.operators.diff import dedup_last


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores for work that is heavy per row on a scan with fewer parts than cores.

    A scan with enough parts is left alone, so a large table is never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def document_items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.concat(F.lit("docs\\"), F.col("source"), F.lit(".json")).alias("source"),
        F.col("doc_id").alias("pos"), F.col("text").alias("q"), F.col("text").alias("a"),
        F.col("lang").alias("product"), F.array("lang", "source").alias("keywords"),
    )


def conversation_items(spark: SparkSession, folder: str) -> DataFrame:
    """User turns with the answer that follows. Joined on (conversation, turn), which is
    unique, so a very long conversation spreads like any other rows."""
    turns = table(spark, folder, "conversations")
    questions = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("q"))
    answers = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("a")
    )
    return questions.join(answers, ["conv_id", "turn"]).select(
        _conversation_file("conversations").alias("source"), F.col("turn").alias("pos"), "q", "a",
        F.lit("chat").alias("product"), F.array().cast("array<string>").alias("keywords"),
    )


def _conversation_file(folder: str) -> Column:
    return F.concat(F.lit(folder + "/"), F.col("conv_id").cast("string"), F.lit(".json"))


def current_items(spark: SparkSession, folder: str) -> DataFrame:
    return document_items(spark, folder).unionByName(conversation_items(spark, folder))


def earlier_items(spark: SparkSession, folder: str) -> DataFrame:
    """Earlier items with ``quality`` and ``toxic`` (1 and 0 for those without a label).

    Poorly rated documents had another answer then.
    """
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("pos"), "quality", "toxic")
    documents = document_items(spark, folder).join(labels, "pos").withColumn(
        "a", F.when(F.col("quality") == 1, F.col("a")).otherwise(F.col("product"))
    )
    no_keywords = F.array().cast("array<string>").alias("keywords")
    passages = table(spark, folder, "benchmark").select(
        F.lit("benchmark.json").alias("source"), F.col("item_id").alias("pos"), F.col("text").alias("q"),
        F.col("text").alias("a"), F.lit("benchmark").alias("product"), no_keywords,
        F.lit(1).alias("quality"), F.lit(0).alias("toxic"),
    )
    prompts = table(spark, folder, "conversations").where("role = 'system'").select(
        _conversation_file("prompts").alias("source"), F.col("turn").alias("pos"), F.col("text").alias("q"),
        F.col("text").alias("a"), F.lit("chat").alias("product"), no_keywords,
        F.lit(1).alias("quality"), F.lit(0).alias("toxic"),
    )
    return documents.unionByName(passages).unionByName(prompts)


def earlier_state(spark: SparkSession, folder: str, change_key: str = "question") -> DataFrame:
    """State table: good and clean keeps its hash, good but toxic lost it, poor and clean
    has an outdated one, poor and toxic is an empty entry."""
    last = dedup_last(with_identity(earlier_items(spark, folder), change_key=change_key))
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    return last.select(
        "point_id",
        F.when(good | ~toxic, F.col("source")).alias("source_file"),
        F.when(good & ~toxic, F.col("question_hash"))
        .when(~good & ~toxic, F.sha2(F.col("question_hash"), 256)).alias("question_hash"),
    )


def raw_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(source, content)``: a file per document with a good item, one whose question is
    a number and one without answer; a file per user turn, lacking the answer where none
    followed; web pages; event properties; and an empty list per label."""
    item = F.struct(
        F.col("text").alias("q"), F.col("text").alias("a"), F.col("lang").alias("product"),
        F.array("lang", "source").alias("keywords"),
    )
    untyped = F.struct(
        F.col("n_chars").alias("q"), F.col("text").alias("a"), F.col("lang").alias("product"),
        F.array("lang").alias("keywords"),
    )
    partial = F.struct(F.col("text").alias("q"), F.col("lang").alias("product"))
    members = F.array_join(F.array(*[F.to_json(x) for x in (item, untyped, partial)]), ",")
    documents = spread(table(spark, folder, "documents"), "doc_id").select(
        F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".json")).alias("source"),
        F.concat(F.lit("["), members, F.lit("]")).alias("content"),
    )
    turns = table(spark, folder, "conversations")
    answers = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("a")
    )
    pair = F.struct(
        F.col("text").alias("q"), F.col("a"), F.lit("chat").alias("product"),
        F.array().cast("array<string>").alias("keywords"),
    )
    dialogues = turns.where("role = 'user'").join(answers, ["conv_id", "turn"], "left").select(
        F.concat_ws("/", F.lit("turns"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("source"),
        F.concat(F.lit("["), F.to_json(pair), F.lit("]")).alias("content"),
    )

    def plain(name: str, key: str, content: Column) -> DataFrame:
        return table(spark, folder, name).select(
            F.concat(F.lit(f"{name}/"), F.col(key).cast("string")).alias("source"), content.alias("content")
        )

    files = (
        documents.unionByName(dialogues)
        .unionByName(plain("pages", "page_id", F.col("html")))
        .unionByName(plain("events", "event_id", F.col("props")))
        .unionByName(plain("labels", "doc_id", F.lit("[]")))
    )
    return files.select("source", F.col("content").cast("binary").alias("content"))
