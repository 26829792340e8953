"""Queries over the supplied tables, one or more per operator."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.chunking import chunk, explode_chunks, fixed_windows
from tidemark.functions.encoding import encode, hashing_encoder, vector_fault
from tidemark.functions.identity import content_hash, with_identity
from tidemark.operators import diff as d
from tidemark.operators.export import export_batches, export_counts, export_once
from tidemark.operators.points import apply_changes, build_points
from tidemark.operators.search import nearest
from tidemark.options import SyncOptions
from tidemark.plans import tables as t
from tidemark.plans.report import change_counts, corpus_counts
from tidemark.plans.sync import SyncResult, sync
from tidemark.sources import scratch, state, store
from tidemark.sources.corpus import (
    explode_items, file_errors, file_stats, parse_files, rejected_items, valid_items,
)
from tidemark.sources.files import open_root

SIZE, OVERLAP = 1000, 150
SMALL_SIZE, SMALL_OVERLAP = 120, 30
DIM = 384


def doc_identity(spark: SparkSession, folder: str) -> DataFrame:
    items = t.document_items(spark, folder).select("source", "pos", "q")
    return with_identity(items).select(F.col("pos").alias("doc_id"), "source", "point_id", "question_hash")


def content_identity(spark: SparkSession, folder: str) -> DataFrame:
    return t.current_items(spark, folder).select(
        "source", "pos", content_hash(F.col("q"), F.col("a"), F.col("product"), F.col("keywords")).alias("content_hash")
    )


def qa_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return t.conversation_items(spark, folder).select("source", "pos", "q", "a", "product")


def _exploded(spark: SparkSession, folder: str) -> DataFrame:
    return explode_items(parse_files(t.raw_files(spark, folder)))


def qa_valid(spark: SparkSession, folder: str) -> DataFrame:
    return valid_items(_exploded(spark, folder)).withColumn("keywords", F.array_join("keywords", "|"))


def qa_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return rejected_items(_exploded(spark, folder)).select("source", "pos", "reason")


def file_status(spark: SparkSession, folder: str) -> DataFrame:
    return file_stats(_exploded(spark, folder))


def dropped_files(spark: SparkSession, folder: str) -> DataFrame:
    return file_errors(_exploded(spark, folder))


def reject_counts(spark: SparkSession, folder: str) -> DataFrame:
    return rejected_items(_exploded(spark, folder)).groupBy("reason").agg(F.count(F.lit(1)).alias("items"))


def corpus_totals(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_counts(file_status(spark, folder))


def _current(spark: SparkSession, folder: str, change_key: str = "question") -> DataFrame:
    items = t.current_items(spark, folder)
    return d.current_points(with_identity(items, change_key=change_key))


def current_points(spark: SparkSession, folder: str) -> DataFrame:
    return _current(spark, folder)


def dedup_last_wins(spark: SparkSession, folder: str) -> DataFrame:
    last = d.dedup_last(with_identity(t.document_items(spark, folder)))
    return last.select("point_id", "pos", "q", "a", "product", F.array_join("keywords", "|").alias("keywords"))


def _compared(spark: SparkSession, folder: str, change_key: str = "question") -> DataFrame:
    return d.compare(_current(spark, folder, change_key), t.earlier_state(spark, folder, change_key))


def diff_ops(spark: SparkSession, folder: str) -> DataFrame:
    return _compared(spark, folder).withColumn("pos", F.coalesce("pos", F.lit(-1).cast("bigint")))


def diff_counts(spark: SparkSession, folder: str) -> DataFrame:
    return d.op_counts(_compared(spark, folder))


def diff_content_key(spark: SparkSession, folder: str) -> DataFrame:
    return d.op_counts(_compared(spark, folder, "content"))


def change_totals(spark: SparkSession, folder: str) -> DataFrame:
    return change_counts(_compared(spark, folder))


def force_totals(spark: SparkSession, folder: str) -> DataFrame:
    return change_counts(_compared(spark, folder), force=True)


def force_plan(spark: SparkSession, folder: str) -> DataFrame:
    return _compared(spark, folder).select(
        "point_id", F.when(F.col("op") == "delete", "delete").otherwise("upsert").alias("action")
    )


def diff_insert(spark: SparkSession, folder: str) -> DataFrame:
    return d.inserts(_current(spark, folder), t.earlier_state(spark, folder)).select("point_id", "source_file")


def diff_changed(spark: SparkSession, folder: str) -> DataFrame:
    return d.updates(_current(spark, folder), t.earlier_state(spark, folder)).select("point_id", "source_file")


def diff_unchanged(spark: SparkSession, folder: str) -> DataFrame:
    return d.unchanged(_current(spark, folder), t.earlier_state(spark, folder)).select("point_id", "source_file")


def diff_deleted(spark: SparkSession, folder: str) -> DataFrame:
    return d.deletions(_current(spark, folder), t.earlier_state(spark, folder)).select("point_id", "source_file")


def keep_unread(spark: SparkSession, folder: str) -> DataFrame:
    unread = t.table(spark, folder, "conversations").where("role = 'system'").select(
        F.concat(F.lit("prompts/"), F.col("conv_id").cast("string"), F.lit(".json")).alias("source")
    )
    return d.op_counts(d.keep_sources(_compared(spark, folder), unread))


def next_state(spark: SparkSession, folder: str) -> DataFrame:
    return d.next_state(_compared(spark, folder))


def state_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch.shared_folder(spark)
    state.save_state(d.next_state(_compared(spark, folder)), path)
    return state.load_state(spark, path).points


def state_repair(spark: SparkSession, folder: str) -> DataFrame:
    """State texts of many kinds: documents as one-entry states of a foreign version,
    event properties as objects without points, pages as no JSON at all."""
    entry = F.struct(F.col("source").alias("source_file"), F.sha2("text", 256).alias("question_hash"))
    points = F.create_map(F.col("doc_id").cast("string"), entry).alias("indexed_points")
    whole = F.to_json(F.struct(F.col("lang").alias("version"), points))
    texts = (
        t.table(spark, folder, "documents").select(whole.alias("value"))
        .unionByName(t.table(spark, folder, "events").select(F.col("props").alias("value")))
        .unionByName(t.table(spark, folder, "pages").select(F.col("html").alias("value")))
    )
    return state.parse_state(texts).groupBy(
        "version", "version_mismatch"
    ).agg(F.count(F.lit(1)).alias("states"), F.sum(F.size("indexed_points")).cast("bigint").alias("entries"))


def _stored_points(spark: SparkSession, folder: str) -> DataFrame:
    """Earlier items as flat points, without vectors."""
    last = d.dedup_last(with_identity(t.earlier_items(spark, folder), change_key="content"))
    return last.select("point_id", "source", "pos", "question_hash")


def applied_changes(spark: SparkSession, folder: str) -> DataFrame:
    items = with_identity(t.current_items(spark, folder), change_key="content")
    points = _stored_points(spark, folder)
    compared = d.compare(
        d.current_points(items), points.select("point_id", F.col("source").alias("source_file"), "question_hash")
    )
    # Read three times below; the comparison is narrow, so it is cheap to keep.
    changes = scratch.materialise(compared, scratch.shared_folder(spark))
    wanted = changes.where("op IN ('insert', 'update')").select(
        "point_id", F.col("source_file").alias("source"), "pos"
    )
    upserts = items.join(wanted, ["point_id", "source", "pos"], "left_semi").select(
        "point_id", "source", "pos", "question_hash"
    )
    return apply_changes(points, upserts, changes.where("op = 'delete'").select("point_id"), key="point_id")


def chunk_fixed(spark: SparkSession, folder: str) -> DataFrame:
    documents = t.spread(t.table(spark, folder, "documents").select("doc_id", "text"), "doc_id")
    windows = documents.select(
        "doc_id", fixed_windows(F.col("text"), SIZE, OVERLAP).alias("chunks")
    )
    return explode_chunks(windows)


def chunk_fixed_stats(spark: SparkSession, folder: str) -> DataFrame:
    windows = t.table(spark, folder, "pages").select(
        "page_id", fixed_windows(F.col("html"), SMALL_SIZE, SMALL_OVERLAP).alias("chunks")
    )
    total = F.aggregate("chunks", F.lit(0).cast("bigint"), lambda n, c: n + F.length(c))
    return windows.select(
        "page_id", F.size("chunks").cast("bigint").alias("windows"), total.alias("chars"),
        F.sha2(F.array_join("chunks", "|"), 256).alias("digest"),
    )


def chunk_recursive(spark: SparkSession, folder: str) -> DataFrame:
    documents = t.spread(t.table(spark, folder, "documents").select("doc_id", "text"), "doc_id")
    return explode_chunks(chunk(documents, "text", SIZE, OVERLAP).drop("text"))


def chunk_recursive_small(spark: SparkSession, folder: str) -> DataFrame:
    turns = t.spread(t.table(spark, folder, "conversations").select("conv_id", "turn", "text"), "conv_id", "turn")
    return explode_chunks(chunk(turns, "text", SMALL_SIZE, SMALL_OVERLAP).drop("text"))


def chunk_without_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """Without overlap the chunks are the text again, apart from white space."""
    pages = chunk(t.table(spark, folder, "pages").select("page_id", "html"), "html", SIZE, 0)
    longest = F.array_max(F.transform("chunks", lambda c: F.length(c)))
    return pages.select(
        "page_id",
        F.sha2(F.regexp_replace(F.array_join("chunks", ""), r"\s+", ""), 256).alias("digest"),
        (longest <= SIZE).alias("fits"),
        F.exists("chunks", lambda c: F.length(F.trim(c)) == 0).alias("any_blank"),
    )


def payload_build(spark: SparkSession, folder: str) -> DataFrame:
    documents = t.spread(t.document_items(spark, folder), "source", "pos")
    items = with_identity(documents.unionByName(t.conversation_items(spark, folder)))
    items = chunk(items, "a", SIZE, OVERLAP)
    points = build_points(items.withColumn("vector", F.lit(None).cast("array<float>")))
    p = points.select("id", "pos", "payload.*")
    return p.select(
        "id", "pos", "question", "product", "source", F.array_join("keywords", "|").alias("keywords"),
        F.size("answer").cast("bigint").alias("n_chunks"), F.array_join("answer", "\x1e").alias("answer"),
    )


def encode_hashed(spark: SparkSession, folder: str) -> DataFrame:
    documents = t.spread(t.table(spark, folder, "documents").select("doc_id", "text"), "doc_id")
    vectors = encode(documents, "text", None, DIM)
    cells = vectors.select("doc_id", F.posexplode_outer("vector").alias("bucket", "value"))
    return cells.where("value <> 0").select("doc_id", "bucket", F.col("value").cast("double").alias("value"))


def vector_checks(spark: SparkSession, folder: str) -> DataFrame:
    vectors = t.table(spark, folder, "embeddings").withColumn("embedding", F.col("embedding").cast("array<float>"))
    v = F.col("embedding")
    square = F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return vectors.select(
        "vec_id", F.size(v).cast("bigint").alias("dim"), vector_fault(v, 64).alias("fault"), F.round(square, 3).alias("square_norm"),
    )


def export_totals(spark: SparkSession, folder: str) -> DataFrame:
    points = with_identity(t.current_items(spark, folder)).select("point_id", "source", "q")
    return export_counts(export_batches(points, lambda: lambda batch: None, 128))


def export_arrived(spark: SparkSession, folder: str) -> DataFrame:
    """What an outside store has got, and in which batch, after an export that was started twice."""
    target = scratch.qualified(spark, scratch.shared_folder(spark))
    points = with_identity(t.current_items(spark, folder)).select(F.col("point_id").alias("id"), "source")
    points = scratch.materialise(points.distinct(), f"{target}/points")

    def to_files():
        fs, root = open_root(f"{target}/arrived")
        fs.create_dir(root, recursive=True)

        def write(lane: int, batch: int, rows: list[dict]) -> None:
            with fs.open_output_stream(f"{root}/{uuid.uuid4().hex}.json") as out:
                out.write("".join(json.dumps({**r, "lane": lane, "batch": batch}) + "\n" for r in rows).encode())

        return write

    for _ in range(2):
        export_once(points, to_files, f"{target}/ledger", lanes=16).write.format("noop").mode("overwrite").save()
    return spark.read.schema("id string, source string, lane bigint, batch bigint").json(f"{target}/arrived")


def _two_runs(spark: SparkSession, folder: str) -> tuple[str, SyncResult]:
    """Index the earlier items, then bring the collection up to the current ones."""
    path = scratch.shared_folder(spark)
    options = SyncOptions(dim=64, change_key="content")
    earlier = t.earlier_items(spark, folder).drop("quality", "toxic")
    sync(spark, earlier, path, options).close()
    return path, sync(spark, t.current_items(spark, folder), path, options)


def sync_report(spark: SparkSession, folder: str) -> DataFrame:
    _, result = _two_runs(spark, folder)
    return result.report.select(
        "items_valid", "evaluated", "attempted", "to_upsert", "inserted", "updated", "unchanged",
        "upserted", "to_delete", "deleted", "points",
    )


def sync_state(spark: SparkSession, folder: str) -> DataFrame:
    _, result = _two_runs(spark, folder)
    return store.read_state(spark, result.collection)


def _millionths(vector: str) -> Column:
    """Digest of a vector: its components in whole millionths."""
    parts = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(1e6)).cast("string"))
    return F.sha2(F.array_join(parts, ","), 256)


def sync_points(spark: SparkSession, folder: str) -> DataFrame:
    _, result = _two_runs(spark, folder)
    points = store.read_points(spark, result.collection)
    return points.select(
        "id", F.col("payload.question").alias("question"), F.col("payload.product").alias("product"),
        F.col("payload.source").alias("source"), F.size("vector").cast("bigint").alias("dim"),
        F.array_join("payload.keywords", "|").alias("keywords"), F.array_join("payload.answer", "\x1e").alias("answer"),
        _millionths("vector").alias("vector_digest"),
    )


def sync_idle(spark: SparkSession, folder: str) -> DataFrame:
    """A run that finds nothing to do makes no new version."""
    path, options = scratch.shared_folder(spark), SyncOptions(dim=64, change_key="content")
    items = t.current_items(spark, folder)
    first = sync(spark, items, path, options)
    again = sync(spark, items, path, options)
    return again.report.select(
        "evaluated", "to_upsert", "unchanged", "to_delete", "upserted", "deleted", "points",
        (F.col("version") == first.collection.version).alias("same_version"),
    )


#: Questions of so many characters, or a multiple of it, are too much for the encoder of ``sync_skips``.
ODD_LENGTH = 17


def _failing_encoder() -> Callable[[list[str]], Any]:
    encoder = hashing_encoder(64)()

    def encode_all(texts: list[str]) -> Any:
        if any(len(text) % ODD_LENGTH == 0 for text in texts):
            raise ValueError("odd length")
        return encoder(texts)

    return encode_all


def sync_skips(spark: SparkSession, folder: str) -> DataFrame:
    """A run whose encoder fails on some items, and what the next one, with a sound encoder, makes of each item."""
    path, items = scratch.shared_folder(spark), t.current_items(spark, folder)
    options = SyncOptions(dim=64, change_key="content", on_row_error="skip", encoder=_failing_encoder)
    first = sync(spark, items, path, options)
    stored = store.read_rows(spark, first.collection).select(F.col("id").alias("point_id"), _millionths("vector").alias("stored"))
    second = sync(spark, items, path, replace(options, encoder=None))
    return second.changes.select("point_id", "source_file", "op").join(
        first.failed.select("point_id", "error"), "point_id", "left"
    ).join(stored, "point_id", "left")


def _whole(vector: str) -> Column:
    """Vectors in whole 256ths, so that distances are exact in any engine."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("double"))


def nearest_exact(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest by Euclidean distance of every vector whose id is divisible by 20, among all others."""
    points = t.table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), _whole("embedding").alias("vector"))
    return nearest(points, points.where("id % 20 = 0"), 10, "Euclid", skip_same=True)


def nearest_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """The same by dot product, among the vectors of one label: the filter comes before the distances."""
    vectors = t.table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "label", _whole("embedding").alias("vector"))
    return nearest(vectors.where("label = 1"), vectors.where("id % 20 = 0"), 10, "Dot")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        doc_identity, content_identity, qa_pairs, qa_valid, qa_rejects, file_status, dropped_files, reject_counts,
        corpus_totals, current_points, dedup_last_wins, diff_ops, diff_counts, diff_content_key,
        change_totals, force_totals, force_plan, diff_insert, diff_changed, diff_unchanged, diff_deleted,
        keep_unread, next_state, state_roundtrip, state_repair, applied_changes, chunk_fixed,
        chunk_fixed_stats, chunk_recursive, chunk_recursive_small, chunk_without_overlap, payload_build,
        encode_hashed, vector_checks, export_totals, export_arrived, sync_report, sync_state, sync_points, sync_idle, sync_skips,
        nearest_exact, nearest_filtered,
    )
}
