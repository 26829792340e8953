"""One query per operator over the supplied tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe, centroids, decontam, lengths, pu_quality, quotes, resampling, risk_rules, simhash, simple8b, suffix_dedup, url_filter,
    warc,
)
from tidemark.llm.common import materialise, shared_folder
from tidemark.plans.tables import table

RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"

#: Rules of the URL filter, and the sites whose pages make up its list.
URL_RULES = [
    url_filter.Rule("org", "/", "allow"),
    url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
]
LISTED_SITES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def op1_warc_members(spark: SparkSession, folder: str) -> DataFrame:
    scratch = shared_folder(spark)
    pages = table(spark, folder, "pages")
    records = warc.plan_records(pages, "page_id", "url", "html")
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    listing = warc.write_archives(records, f"{scratch}/crawl", date)
    index = warc.normalise(listing, f"{scratch}/crawl", f"{scratch}/records")
    return warc.read_records(index, f"{scratch}/records").select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows, gone = suffix_dedup.removals(docs, shared_folder(spark))
    gone = gone.select("key", "whole", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    size = F.octet_length("data").cast("long").alias("n_bytes")
    own = rows.select("row.doc_id", "key", size, F.sha2("data", 256).alias("own"))
    whole = F.coalesce(F.col("whole"), F.lit(False))
    return own.join(gone, "key", "left").select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", "own")).alias("kept_sha256"),
    )


def op3_pu_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = pu_quality.learn(docs, table(spark, folder, "labels"))
    return pu_quality.scored(docs, model).select(
        "doc_id", pu_quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op4_quote_links(spark: SparkSession, folder: str) -> DataFrame:
    messages = table(spark, folder, "conversations").select(F.col("conv_id").alias("conv"), "turn", "role", "text")
    return quotes.reply_order(messages, shared_folder(spark)).withColumnRenamed("conv", "conv_id")


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    vocabulary = bpe.vocabulary(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return bpe.with_ids(docs, vocabulary, decode=True).select(
        "doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_simple8b(spark: SparkSession, folder: str) -> DataFrame:
    target = shared_folder(spark)
    docs = table(spark, folder, "documents")
    index = simple8b.write_ids(docs, target, public_tokenizers.path(TOKENIZER))
    return simple8b.read_ids(index, target).select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_length_histogram(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("text")
    counts = lengths.histogram(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return lengths.suffix_sums(materialise(counts, shared_folder(spark)))


def op8_risk_rules(spark: SparkSession, folder: str) -> DataFrame:
    scratch = shared_folder(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = materialise(
        risk_rules.measured(docs).select(
            F.col("row.doc_id").alias("k"), F.col("row.lang").alias("s"), F.xxhash64("row.text").alias("copy"),
            "m", "base_failed", "shares",
        ),
        f"{scratch}/measured",
    )
    cutoffs = materialise(
        risk_rules.calibrate_measured(found, table(spark, folder, "labels")), f"{scratch}/cutoffs"
    )
    return risk_rules.verdicts(found, F.col("s"), cutoffs).select(
        F.col("k").alias("doc_id"), "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines",
        "m.n_repeat_words", "base_failed", "kept",
    )


def op9_simhash_blocks(spark: SparkSession, folder: str) -> DataFrame:
    scratch = shared_folder(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    prints = materialise(
        docs.select("doc_id", simhash.fingerprint_column(F.col("text")).alias("fp")), f"{scratch}/prints"
    )
    found = simhash.near_duplicates(prints, scratch)
    return prints.join(found, "fp").select(
        "doc_id", simhash.hex_column(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontam.contamination(docs, table(spark, folder, "benchmark"), shared_folder(spark))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_centroid_tables(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    found, _ = centroids.cluster(vectors, shared_folder(spark), k=40, rounds=5, dims=64, id="vec_id")
    return found.withColumnRenamed("id", "vec_id")


def op12_resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = resampling.resample(docs, table(spark, folder, "benchmark"), shared_folder(spark))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op13_url_bloom(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    listed = pages.where(url_filter.host(F.col("url")).rlike(rf"(?:\A|\.)(?:{'|'.join(LISTED_SITES)})\."))
    found = url_filter.judge(pages, listed, shared_folder(spark), URL_RULES, columns=("page_id",))
    return found.select(
        F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict", "canonical", "listed"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_warc_members, op2_suffix_dedup, op3_pu_quality, op4_quote_links, op5_byte_bpe, op6_simple8b, op7_length_histogram, op8_risk_rules, op9_simhash_blocks, op10_decontaminate, op11_centroid_tables, op12_resampling,
              op13_url_bloom)
}
