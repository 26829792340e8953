"""The indexed-points state as a table, and its JSON file form.

File form: ``{"version", "last_run_utc", "indexed_points": {id: {"source_file",
"question_hash"}}}``. Table form: ``(point_id, source_file, question_hash)``.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.json import STRICT_OPTIONS, is_single_value
from tidemark.options import STATE_VERSION
from tidemark.sources import corpus
from tidemark.sources.pieces import elements_of, frames_of, parts_of
from tidemark.sources.scratch import discard, file_sizes, materialise, shared_folder, take_place

STATE_SCHEMA = "point_id string, source_file string, question_hash string"
_ENTRY = "struct<source_file:string,question_hash:string>"
_DOCUMENT = f"struct<version:string,last_run_utc:string,indexed_points:map<string,{_ENTRY}>>"
_EMPTY = f"map_from_arrays(cast(array() AS array<string>), cast(array() AS array<{_ENTRY}>))"


class State(NamedTuple):
    """``points`` in table form and ``runs (version, last_run_utc, version_mismatch)``, a row per file."""

    points: DataFrame
    runs: DataFrame


def parse_state(documents: DataFrame, col: str = "value") -> DataFrame:
    """Parse state texts, repairing what can be repaired.

    Text that is no JSON object counts as the empty state, unusable points as no
    points, an absent version as the current one. A different version is only flagged.
    """
    text = F.col(col)
    doc = F.when(
        F.is_valid_utf8(text) & is_single_value(text), F.from_json(text, _DOCUMENT, STRICT_OPTIONS)
    )
    version = F.coalesce(F.col("doc.version"), F.lit(STATE_VERSION))
    return documents.select(doc.alias("doc")).select(
        version.alias("version"),
        F.col("doc.last_run_utc").alias("last_run_utc"),
        (version != STATE_VERSION).alias("version_mismatch"),
        F.coalesce(F.col("doc.indexed_points"), F.expr(_EMPTY)).alias("indexed_points"),
    )


def state_points(parsed: DataFrame) -> DataFrame:
    """Explode parsed state into one row per point id."""
    entries = parsed.select(F.explode_outer("indexed_points").alias("point_id", "entry"))
    return entries.where("point_id IS NOT NULL").select(
        "point_id", "entry.source_file", "entry.question_hash"
    )


def unique_state(rows: DataFrame) -> DataFrame:
    """One entry per id of a state from elsewhere, the last by source and hash; partial maxima per task."""
    last = F.max(F.struct("source_file", "question_hash"))
    return rows.where("point_id IS NOT NULL").groupBy("point_id").agg(last.alias("last")).select(
        "point_id", "last.source_file", "last.question_hash"
    )


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE_SCHEMA)


def load_state(spark: SparkSession, path: str) -> State:
    """Read a state file, or a folder of them; a missing path is the empty state.

    Files beyond ``LARGE`` bytes are cut into pieces and read by several tasks.
    """
    found = file_sizes(spark, path)
    small = [name for name, size in found if size <= corpus.LARGE]
    large = [(name, size) for name, size in found if size > corpus.LARGE]
    documents = spark.read.text(small, wholetext=True) if small else spark.createDataFrame([], "value string")
    parsed = parse_state(documents)
    points, runs = state_points(parsed), parsed.drop("indexed_points")
    for name, size in large:
        cut = large_state(spark, name, size)
        points, runs = points.unionByName(cut.points), runs.unionByName(cut.runs)
    return State(unique_state(points), runs)


def large_state(spark: SparkSession, path: str, size: int) -> State:
    """One state file, cut into the entries of its points; like :func:`parse_state`, it counts as empty if any of it is no JSON."""
    folder, _, name = path.rpartition("/")
    files = spark.createDataFrame([(name, size)], "source string, size bigint")
    parts = parts_of(lambda states: corpus.file_pieces(files, folder, states), shared_folder(spark), 2)
    # One row: the document with a number in place of what each inner object or list holds.
    plain = F.col("data").cast("string")
    frame = frames_of(parts).select(F.when(F.is_valid_utf8(plain), plain).alias("value"))
    inner = "struct<version:string,last_run_utc:string,indexed_points:map<string,bigint>>"
    doc = F.when(is_single_value(F.col("value")), F.from_json("value", inner, STRICT_OPTIONS))
    about = frame.select(doc.alias("doc")).select("doc.*").first()
    entries = elements_of(parts).select("container", F.when(F.is_valid_utf8(plain), plain).alias("text"))
    entry, item = F.concat(F.lit("{"), "text", F.lit("}")), F.concat(F.lit("["), "text", F.lit("]"))
    empty = F.col("text").rlike(r"\A[ \t\r\n]*\z")
    own = (about.indexed_points or {}).get("#", -1) if about else -1
    sound = empty | is_single_value(entry) | ((F.col("container") != own) & is_single_value(item))
    if about is None or entries.where(~F.coalesce(sound, F.lit(False))).limit(1).count():
        own, about = -1, None
    rows = entries.where((F.col("container") == own) & ~empty).select(
        F.explode(F.from_json(entry, f"map<string,{_ENTRY}>", STRICT_OPTIONS)).alias("point_id", "entry")
    )
    version = (about.version if about else None) or STATE_VERSION
    run = (version, about.last_run_utc if about else None, version != STATE_VERSION)
    return State(
        rows.select("point_id", "entry.source_file", "entry.question_hash"),
        spark.createDataFrame([run], "version string, last_run_utc string, version_mismatch boolean"),
    )


def _stamp(moment: Column | None) -> Column:
    utc = F.to_utc_timestamp(moment if moment is not None else F.current_timestamp(), F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def state_documents(
    state: DataFrame, last_run_utc: Column | None = None, files: int = 1
) -> DataFrame:
    """Nest state rows into ``files`` JSON texts ``(part, value)``.

    Rows are spread by a hash of the unique id, so each text stays near
    ``rows / files`` entries however the sources are skewed.
    """
    stamp = _stamp(last_run_utc)
    entry = F.struct("source_file", "question_hash")
    return (
        state.groupBy(F.pmod(F.xxhash64("point_id"), F.lit(files)).cast("int").alias("part"))
        .agg(F.map_from_entries(F.collect_list(F.struct("point_id", entry))).alias("indexed_points"))
        .select(
            "part",
            F.to_json(
                F.struct(
                    F.lit(STATE_VERSION).alias("version"), stamp.alias("last_run_utc"), "indexed_points"
                )
            ).alias("value"),
        )
    )


def save_state(state: DataFrame, path: str, rows_per_file: int = 50_000) -> int:
    """Write the state as JSON files of about ``rows_per_file`` entries; returns the row count.

    A corpus of ordinary size gives a single file; for one file whatever the size, see :func:`replace_state`.
    ``path`` must be new: it becomes a folder that :func:`load_state` reads back, and its ``_SUCCESS`` marker appears last,
    so an earlier export is never half replaced.
    """
    spark, scratch = state.sparkSession, shared_folder(state.sparkSession)
    rows = materialise(state.select("point_id", "source_file", "question_hash"), scratch)
    total = rows.count()
    files = max(1, -(-total // rows_per_file))
    texts = state_documents(rows, files=files).select("value")
    # A reader takes a file for one document, so no two of them may share one.
    texts.write.mode("errorifexists").option("maxRecordsPerFile", 1).text(path)
    discard(spark, scratch)
    return total


def replace_state(state: DataFrame, path: str, last_run_utc: Column | None = None) -> int:
    """Write the state as the one JSON file ``path``, in place of what is there; returns the row count.

    One document is one file, so one task writes it, an entry a line, as they come; no more than a
    line is held. The file is finished beside ``path`` and then takes its name in one step.
    """
    spark, scratch = state.sparkSession, shared_folder(state.sparkSession)
    rows = materialise(state.select("point_id", "source_file", "question_hash").where("point_id IS NOT NULL"), scratch)
    tally = rows.agg(F.count(F.lit(1)).alias("n"), F.min("point_id").alias("first")).first()
    head = F.concat(
        F.lit('{"version": '), F.to_json(F.array(F.lit(STATE_VERSION))).substr(2, len(STATE_VERSION) + 2), F.lit(', "last_run_utc": "'),
        _stamp(last_run_utc), F.lit('", "indexed_points": {'),
    )
    pair = F.to_json(F.map_from_arrays(F.array("point_id"), F.array(F.struct("source_file", "question_hash"))))
    # Without the braces around it.
    line = F.substring(pair, F.lit(2), F.length(pair) - 2)
    entries = rows.select(
        F.lit(1).alias("place"), "point_id", F.when(F.col("point_id") == tally.first, line).otherwise(F.concat(F.lit(","), line)).alias("value")
    )
    no_id = F.lit(None).cast("string").alias("point_id")
    frame = spark.range(1).select(F.lit(0).alias("place"), no_id, head.alias("value")).unionByName(
        spark.range(1).select(F.lit(2).alias("place"), no_id, F.lit("}}").alias("value"))
    )
    lines = entries.unionByName(frame).repartition(1).sortWithinPartitions("place", "point_id").select("value")
    beside = f"{path}.{uuid.uuid4().hex}"
    lines.write.text(beside)
    written = [name for name, _ in file_sizes(spark, beside)]
    if len(written) != 1:
        raise RuntimeError(f"the state was written to {len(written)} files")
    take_place(spark, written[0], path)
    discard(spark, beside)
    discard(spark, scratch)
    return tally.n
