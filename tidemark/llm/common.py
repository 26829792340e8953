"""Helpers shared by the operators: batches of texts, worker state, scratch tables, shared files."""

from __future__ import annotations

import gc
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.scratch import discard, materialise, shared_folder

__all__ = ["add_columns", "discard", "map_rows", "materialise", "open_fs", "release", "row_slices", "shared_folder", "worker_state"]

#: Bytes of text handled at once inside a Python worker; a longer text is handled alone.
SLICE_BYTES = 2 << 20


def worker_state() -> dict:
    """A dict that lives as long as the Python worker, which Spark reuses for many tasks.

    Functions travel to the workers by value, so module globals would start empty in each task.
    """
    module = sys.modules.get("_tidemark_worker_state")
    if module is None:
        module = sys.modules.setdefault("_tidemark_worker_state", types.ModuleType("_tidemark_worker_state"))
    return module.__dict__.setdefault("values", {})


def row_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of ``batch`` with about ``limit`` bytes of ``column`` each, at least one row."""
    start, held = 0, 0
    sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
    for i, size in enumerate(sizes):
        if i > start and held + (size or 0) > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size or 0
    if start < len(sizes):
        yield batch.slice(start)


def map_rows(df: DataFrame, function: Callable[[pa.RecordBatch], list[tuple]], schema: str, column: str) -> DataFrame:
    """``mapInArrow`` over slices bounded by the bytes of ``column``; ``function`` gives rows of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, column):
                rows = function(part)
                if rows:
                    columns = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), f.type) for c, f in zip(columns, target)], schema=target
                    )

    return df.mapInArrow(run, schema)


def add_columns(
    df: DataFrame, function: Callable[[pa.RecordBatch], list[pa.Array]], added: str, column: str
) -> DataFrame:
    """``df`` with the columns ``added`` (DDL), which ``function`` gives for slices bounded by the bytes of ``column``.

    Unlike a pandas UDF, no more than a slice is held as Python objects at a time.
    """
    from pyspark.sql.types import StructType

    schema = StructType([*df.schema.fields, *StructType.fromDDL(added).fields])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, column):
                yield pa.RecordBatch.from_arrays([*part.columns, *function(part)], names=names)

    return df.mapInArrow(run, schema)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished queries whose frames nobody holds any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; usable on executors for any scheme that pyarrow knows."""
    return pafs.FileSystem.from_uri(uri)
