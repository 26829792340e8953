"""Taking in new files as they arrive.

A stream sees files that appear, never files that vanish, so it only adds and
replaces points; deletions need a full :func:`tidemark.plans.sync.sync`.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.options import SyncOptions
from tidemark.plans.sync import sync
from tidemark.sources.corpus import folder_prefix, relative_path

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def read_file_stream(spark: SparkSession, root: str, max_files_per_trigger: int = 100_000) -> DataFrame:
    """Streaming ``(source, content)`` of the ``*.json`` files below ``root``."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(root)
    )
    prefix = folder_prefix(spark, root)
    return files.select(relative_path(F.col("path"), prefix).alias("source"), "content")


def start_ingest(
    spark: SparkSession, root: str, store_path: str, checkpoint: str, options: SyncOptions | None = None,
    max_files_per_trigger: int = 100_000, processing_time: str | None = None,
) -> StreamingQuery:
    """Upsert arriving files into the collection, one commit per micro-batch.

    Without ``processing_time`` the query takes in what is there and stops. A
    batch that is replayed after a failure finds its ids present and unchanged.
    """
    settings = replace(options or SyncOptions(), apply_deletes=False, dry_run=False)

    def upsert_batch(files: DataFrame, _: int) -> None:
        sync(files.sparkSession, files, store_path, settings).close()

    writer = (
        read_file_stream(spark, root, max_files_per_trigger)
        .writeStream.foreachBatch(upsert_batch)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    return writer.trigger(**trigger).start()
