"""The synchronisation run: corpus in, points and report out.

The corpus is scanned once for a narrow ledger (ids, hashes, statuses). The
comparison with the previous state works on that ledger alone. A second scan
fetches the texts of the changed items only; they are spread evenly before the
encoder sees them, and written as one commit together with the deletions.
"""

from __future__ import annotations

import time
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.chunking import chunk
from tidemark.functions.encoding import encode, encode_apart, vector_fault
from tidemark.functions.identity import with_identity
from tidemark.operators.diff import compare, compare_upserts, current_points, keep_sources
from tidemark.operators.points import build_points
from tidemark.options import SyncOptions, encoder_batch
from tidemark.plans.report import change_counts, corpus_counts
from tidemark.sources import corpus as corpus_source
from tidemark.sources import scratch, store
from tidemark.sources.state import empty_state, unique_state

REPORT_SCHEMA = (
    "collection string, version bigint, dry_run boolean, forced boolean, files_found bigint, "
    "files_parsed bigint, files_failed bigint, files_with_items bigint, items_valid bigint, "
    "items_invalid bigint, evaluated bigint, attempted bigint, to_upsert bigint, inserted bigint, "
    "updated bigint, unchanged bigint, upserted bigint, upsert_failed bigint, to_delete bigint, "
    "deleted bigint, delete_failed bigint, simulated_force_deletes bigint, points bigint, duration_s double"
)

# Files that the second scan reads by their names, without listing the others.
ONLY = 1_000

FAILED_SCHEMA = "point_id string, source string, pos bigint, question string, op string, error string"


class SyncResult(NamedTuple):
    """``report`` has one row; ``changes`` is the comparison; ``rejects`` and ``errors``
    list the dropped items and files, ``failed`` the items that the encoder failed on.

    ``points`` are the upserts of this run and ``delete_ids`` the ids it removed. ``collection`` is None after a dry run
    on a collection that does not exist. Call :meth:`close` when the DataFrames are
    no longer needed.
    """

    report: DataFrame
    changes: DataFrame
    rejects: DataFrame
    files: DataFrame
    errors: DataFrame
    failed: DataFrame
    points: DataFrame
    delete_ids: DataFrame
    collection: store.Collection | None
    scratch_path: str

    def close(self) -> None:
        scratch.discard(self.report.sparkSession, self.scratch_path)


def _exploded(
    spark: SparkSession, source: str | DataFrame, sources: DataFrame | None = None, large: list[str] | None = None
) -> DataFrame:
    """Item rows of a folder of JSON files, or of a DataFrame of items or of files.

    ``sources``, when given, is small: files it does not name are not parsed, and not read if it names few. ``large`` names
    files, given by their contents, with items that no variant can hold.
    """
    if isinstance(source, str):
        only = None
        if sources is not None:
            found = [r.source for r in sources.limit(ONLY + 1).collect()]
            only = found if len(found) <= ONLY else None
        if only is not None or sources is None:
            return corpus_source.read_exploded(spark, source, only=only)
        return corpus_source.read_exploded(spark, source).join(F.broadcast(sources), "source", "left_semi")
    if "content" in source.columns:
        if sources is not None:
            source = source.join(F.broadcast(sources), "source", "left_semi")
        if not large:
            return corpus_source.explode_items(corpus_source.parse_files(source))
        huge, others = source.where(F.col("source").isin(large)), source.where(~F.col("source").isin(large))
        cut = corpus_source.large_items(spark, lambda states: corpus_source.content_pieces(huge, states))
        return corpus_source.explode_items(corpus_source.parse_files(others)).unionByName(cut)
    return corpus_source.check_items(source)


def _ledger(exploded: DataFrame, options: SyncOptions) -> DataFrame:
    """Narrow row per item: everything the comparison and the counters need."""
    identified = with_identity(exploded, options.namespace, options.change_key)
    valid = F.col("pos").isNotNull() & F.col("reason").isNull()
    return identified.select(
        "source", "status", "pos", "reason", F.when(~valid, F.col("raw")).alias("raw"),
        F.when(valid, F.col("point_id")).alias("point_id"),
        F.when(valid, F.col("question_hash")).alias("question_hash"),
    )


def encoder_tasks(spark: SparkSession, count: int, options: SyncOptions) -> int:
    """Tasks for so many changed items: a power of two, so that the buckets of the store fall into as few of them as can be."""
    cores = spark.sparkContext.defaultParallelism
    tasks = max(1, -(-count // options.rows_per_task), min(cores, -(-count // options.batch_size)))
    return 1 << (tasks - 1).bit_length()


def _changed_items(
    spark: SparkSession, source: str | DataFrame, wanted: DataFrame, count: int, options: SyncOptions,
    large: list[str] | None = None,
) -> DataFrame:
    """Whole items for the ``count`` positions in ``wanted``.

    They are found by file and position, so ids and hashes are worked out again for
    the fetched rows only. A row that no longer agrees, because its file was changed
    in between, is left out, and the count check then stops the run.
    """
    tasks = encoder_tasks(spark, count, options)
    keys = wanted.select(
        F.col("source_file").alias("source"), "pos",
        F.col("point_id").alias("wanted_id"), F.col("question_hash").alias("wanted_hash"), "op",
    )
    few = count <= options.broadcast_rows
    sources = keys.select("source").distinct() if few else None
    items = corpus_source.valid_items(_exploded(spark, source, sources, large))
    # The encoder gets the same number of tasks whichever way the rows were found.
    found = items.join(F.broadcast(keys) if few else keys, ["source", "pos"]).repartition(tasks, "wanted_id")
    agrees = (F.col("point_id") == F.col("wanted_id")) & (F.col("question_hash") == F.col("wanted_hash"))
    return with_identity(found, options.namespace, options.change_key).where(agrees).drop("wanted_id", "wanted_hash")


def sync(
    spark: SparkSession, source: str | DataFrame, store_path: str, options: SyncOptions | None = None,
    previous: DataFrame | None = None,
) -> SyncResult:
    """Bring the collection at ``store_path`` in line with ``source``.

    ``source`` is the root of a tree of JSON files, or a DataFrame of files
    ``(source, content)`` or of items ``(source, pos, q, a, product, keywords)``, whose
    ``(source, pos)`` is unique. It is read twice and must give the same rows.
    ``previous`` replaces the state kept with the points, as when a state file of
    an earlier system is taken over.
    """
    scratch_path = scratch.shared_folder(spark)
    try:
        return _sync(spark, source, store_path, options or SyncOptions(), previous, scratch_path)
    except BaseException:
        scratch.discard(spark, scratch_path)
        raise


def _sync(
    spark: SparkSession, source: str | DataFrame, store_path: str, options: SyncOptions, previous: DataFrame | None,
    scratch_path: str,
) -> SyncResult:
    started = time.monotonic()
    if options.dry_run:
        collection = store.open_collection(spark, store_path, options.collection)
    else:
        collection = store.ensure_collection(
            spark, store_path, options.collection, options.dim, options.metric, on_mismatch=options.on_mismatch
        )
    taken_over = previous is not None
    previous = unique_state(previous) if taken_over else None

    ledger = scratch.materialise(_ledger(_exploded(spark, source), options), f"{scratch_path}/ledger")
    files = corpus_source.file_stats(ledger)
    found = corpus_counts(files).first()
    large: list[str] = []
    if found.files_too_large:
        # Items beyond what a variant holds: such a file has 128 MB at least, so these are few.
        large = [r.source for r in ledger.where("status = 'too_large'").select("source").distinct().collect()]
        rest = _ledger(_exploded(spark, source.where(F.col("source").isin(large)), large=large), options)
        ledger = scratch.materialise(ledger.where("status <> 'too_large'").unionByName(rest), f"{scratch_path}/whole")
        files = corpus_source.file_stats(ledger)
        found = corpus_counts(files).first()

    current = current_points(ledger.where("point_id IS NOT NULL"))
    if options.apply_deletes:
        known = previous if taken_over else _state(spark, collection, options)
        compared = compare(current, known)
        if options.on_bad_file == "keep" and found.files_failed:
            bad = corpus_source.file_errors(ledger)
            compared = keep_sources(compared, bad, small=found.files_failed <= options.broadcast_rows)
    else:
        compared = _compare_batch(spark, current, found.items_valid, previous, collection, options, f"{scratch_path}/current")
    changes = scratch.materialise(compared, f"{scratch_path}/changes")
    counts = change_counts(changes, options.force).first()
    if counts.evaluated != found.items_valid:
        raise RuntimeError(f"{found.items_valid} valid items, but {counts.evaluated} compared; nothing was changed")
    before = counts.previous_points
    if not options.apply_deletes:
        # Only what the batch names has been looked up.
        before = previous.count() if taken_over else 0 if collection is None else collection.points
    _guard_deletes(counts.to_delete, before, options)

    process = "pos IS NOT NULL" if options.force else "op IN ('insert', 'update')"
    todo = _changed_items(spark, source, changes.where(process), counts.to_upsert, options, large)
    dim = options.dim if collection is None else collection.dim
    todo = chunk(todo, "a", options.chunk_size, options.chunk_overlap)
    built, failed, lost = _encoded(todo, dim, options, f"{scratch_path}/encoded")
    gone = changes.where("op = 'delete'").select(F.col("point_id").alias("id"))
    expected = counts.to_upsert - lost.rows
    if options.max_failed_fraction is not None and lost.rows > options.max_failed_fraction * counts.to_upsert:
        raise ValueError(f"the encoder failed on {lost.rows} of {counts.to_upsert} items; nothing was changed")

    if options.dry_run:
        # The points are worked out in full, as a real run would, and kept aside.
        points = scratch.materialise(built, f"{scratch_path}/points")
        tally = points.agg(F.count("*").alias("n"), F.count_if(vector_fault(F.col("vector"), dim)).alias("faults")).first()
        _check_written(tally.n, expected, tally.faults)
        upserted, deleted = None, None
    else:
        points, upserted, deleted, collection = _write(
            spark, collection, built, gone, counts, lost, taken_over, options
        )

    values = {
        "collection": options.collection, "version": None if collection is None else collection.version,
        "dry_run": options.dry_run, "forced": options.force, **found.asDict(), **counts.asDict(),
        "upserted": upserted, "deleted": deleted, "upsert_failed": lost.rows, "delete_failed": 0,
        # What a forced dry run would announce: every previous point.
        "simulated_force_deletes": before if options.force and options.dry_run else None,
        "points": None if collection is None else collection.points,
        "duration_s": time.monotonic() - started,
    }
    columns = [part.split()[0] for part in REPORT_SCHEMA.split(", ")]
    report = spark.createDataFrame([tuple(values[c] for c in columns)], REPORT_SCHEMA)
    return SyncResult(
        report, changes, corpus_source.rejected_items(ledger), files, corpus_source.file_errors(ledger),
        failed, points.drop("question_hash"), gone, collection, scratch_path,
    )


def _state(
    spark: SparkSession, collection: store.Collection | None, options: SyncOptions, ids: list[str] | None = None
) -> DataFrame:
    return empty_state(spark) if collection is None else store.read_state(spark, collection, options.broadcast_rows, ids)


def _compare_batch(
    spark: SparkSession, current: DataFrame, items: int, previous: DataFrame | None, collection: store.Collection | None,
    options: SyncOptions, path: str,
) -> DataFrame:
    """The comparison of a run that deletes nothing, of ``items`` items: the state is only looked up.

    Few ids are looked up in their buckets; ids that fit a broadcast leave the state where it is; beyond
    that the state meets them bucket by bucket.
    """
    ids = None
    if previous is None and items <= store.LOOKED_UP:
        current = scratch.materialise(current, path)
        ids = [r.point_id for r in current.select("point_id").collect()]
    known = previous if previous is not None else _state(spark, collection, options, ids)
    return compare_upserts(current, known, small=items <= options.broadcast_rows)


class _Lost(NamedTuple):
    """Items the encoder failed on, and those of them that were not indexed before."""

    rows: int = 0
    inserts: int = 0


def _encoded(todo: DataFrame, dim: int, options: SyncOptions, path: str) -> tuple[DataFrame, DataFrame, _Lost]:
    """The points of ``todo``, and the items without a vector: listed with their errors, and counted."""
    kept = ("point_id", "q", "a", "product", "keywords", "source", "chunks", "vector", "question_hash")
    batch = encoder_batch(options.batch_size)
    if options.on_row_error == "fail":
        points = build_points(encode(todo, "q", options.encoder, dim, batch, batch_chars=options.batch_chars).select(*kept))
        return points, todo.sparkSession.createDataFrame([], FAILED_SCHEMA), _Lost()
    apart = encode_apart(todo, "q", options.encoder, dim, batch, batch_chars=options.batch_chars)
    # Written, as the encoder should not run again for the counts and the list.
    rows = scratch.materialise(apart, path)
    wrong = F.col("error").isNotNull()
    lost = rows.agg(F.count_if(wrong).alias("rows"), F.count_if(wrong & (F.col("op") == "insert")).alias("inserts")).first()
    failed = rows.where(wrong).select("point_id", "source", "pos", F.col("q").alias("question"), "op", "error")
    return build_points(rows.where(~wrong).select(*kept)), failed, _Lost(lost.rows, lost.inserts)


def _guard_deletes(to_delete: int, previous_points: int, options: SyncOptions) -> None:
    """A broken scan looks like a mass deletion; stop before it is written."""
    limit = options.max_delete_fraction
    if limit is not None and to_delete > limit * previous_points:
        raise ValueError(
            f"{to_delete} of {previous_points} points would be deleted, more than the allowed share {limit}"
        )


def _check_written(written: int, expected: int, faults: int = 0) -> None:
    if written != expected or faults:
        raise RuntimeError(
            f"{written} points were built for {expected} changed items, {faults} of them with a bad vector; "
            "nothing was committed"
        )


def _write(
    spark: SparkSession, collection: store.Collection, upserts: DataFrame, gone: DataFrame, counts: Row, lost: _Lost,
    taken_over: bool, options: SyncOptions,
) -> tuple[DataFrame, int, int, store.Collection]:
    """Write upserts and deletes as one commit; returns the points and what was written."""
    if counts.to_upsert == 0 and counts.to_delete == 0:
        return spark.createDataFrame([], upserts.schema), 0, 0, collection
    data = store.new_data_path(collection.path, collection.name)
    buckets = store.delta_buckets(collection, counts.to_upsert + counts.to_delete)
    # As many tasks as the upserts have: a bucket is written by few tasks.
    tasks = encoder_tasks(spark, counts.to_delete, options)
    store.write_rows(store.as_rows(upserts, gone.repartition(tasks, "id")), data, buckets)
    rows = store.read_data(spark, data, buckets)
    tally = rows.agg(
        F.count_if(~F.col("deleted")).alias("upserted"), F.count_if("deleted").alias("deleted"),
        F.count_if(~F.col("deleted") & vector_fault(F.col("vector"), collection.dim)).alias("faults"),
    ).first()
    _check_written(tally.upserted, counts.to_upsert - lost.rows, tally.faults)
    # Bucket by bucket, so nothing is exchanged where there are buckets.
    twice = rows.groupBy("id").count().where("count > 1").limit(1).count()
    if twice:
        raise RuntimeError("an id would be written twice; nothing was committed")
    if taken_over:
        # The given state need not agree with the stored points, so count them.
        others = store.read_rows(spark, collection, options.broadcast_rows).join(rows.select("id"), "id", "left_anti").count()
        total = others + tally.upserted
    else:
        total = collection.points + counts.inserted - lost.inserts - tally.deleted
    collection = store.commit_changes(
        spark, collection, data, tally.upserted, tally.deleted, total,
        options.compact_fraction, options.max_deltas, buckets, options.broadcast_rows,
    )
    return rows.where("NOT deleted").drop("deleted"), tally.upserted, tally.deleted, collection
