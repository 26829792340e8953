"""Sending points or deletions to an outside store in batches."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.options import check_positive
from tidemark.sources.files import open_root

RESULT_SCHEMA = "partition int, batch bigint, rows bigint, attempts int, ok boolean, error string"

_RESULT = pa.schema(
    [("partition", pa.int32()), ("batch", pa.int64()), ("rows", pa.int64()),
     ("attempts", pa.int32()), ("ok", pa.bool_()), ("error", pa.string())]
)

ONCE_SCHEMA = "lane bigint, batch bigint, rows bigint, sent boolean, ok boolean, error string"

_ONCE = pa.schema(
    [("lane", pa.int64()), ("batch", pa.int64()), ("rows", pa.int64()), ("sent", pa.bool_()), ("ok", pa.bool_()), ("error", pa.string())]
)

Writer = Callable[[list[dict]], None]


def export_batches(
    df: DataFrame, writer: Callable[[], Writer], batch_size: int = 128, max_retries: int = 2,
    retry_delay: float = 5.0, transient: tuple[type[Exception], ...] = (ConnectionError, TimeoutError),
) -> DataFrame:
    """Send the rows of ``df`` in batches; one result row per batch.

    ``writer`` is a factory called once per task; the function it returns gets a
    list of row dicts and raises when the batch failed. Errors in ``transient``
    are tried again, others count the batch as failed at once. A task that Spark
    runs again sends its batches again, so writes must be keyed by id.
    """
    check_positive("batch_size", batch_size)

    def send(arrow_batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write, partition = writer(), TaskContext.get().partitionId()
        waiting: list[dict] = []
        number = 0

        def flush(batch: list[dict]) -> pa.RecordBatch:
            nonlocal number
            number += 1
            attempts, error = 0, None
            while True:
                attempts += 1
                try:
                    write(batch)
                    error = None
                    break
                except transient as failure:
                    error = str(failure)
                    if attempts > max_retries:
                        break
                    time.sleep(retry_delay)
                except Exception as failure:
                    error = str(failure)
                    break
            outcome = {
                "partition": partition, "batch": number, "rows": len(batch),
                "attempts": attempts, "ok": error is None, "error": error,
            }
            return pa.RecordBatch.from_pylist([outcome], schema=_RESULT)

        for arrow_batch in arrow_batches:
            waiting.extend(arrow_batch.to_pylist())
            while len(waiting) >= batch_size:
                yield flush(waiting[:batch_size])
                waiting = waiting[batch_size:]
        if waiting:
            yield flush(waiting)

    return df.mapInArrow(send, RESULT_SCHEMA)


def lane_of(key: Column, lanes: int) -> Column:
    """The lane of a row: the first 28 bits of its key's MD5, modulo ``lanes``."""
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 7), 16, 10).cast("bigint") % lanes


def export_once(
    df: DataFrame, writer: Callable[[], Callable[[int, int, list[dict]], None]], ledger: str, key: str = "id",
    batch_size: int = 128, lanes: int = 1024,
) -> DataFrame:
    """Send the rows of ``df`` in batches, and no batch again that the ledger has; one row per batch: ``lane, batch, rows, sent, ok, error``.

    The batches of a lane are its rows in order of the unique ``key``, ``batch_size`` at a time from 1, so they are the same in
    every attempt and on any cluster, as long as ``df`` is. A batch that was taken is noted below ``ledger``, a folder in a store that
    pyarrow knows; a task that Spark runs again, and a run that starts again with this ledger, pass over it (``sent`` is
    false). A task lost between sending and noting sends that one batch again, with its old lane and number, and so may
    one that speculation runs twice at a time. Writers get ``(lane, batch, rows)`` and can tell. Failed batches are not noted.
    """
    check_positive("batch_size", batch_size)
    check_positive("lanes", lanes)
    spread = df.withColumn("_lane", lane_of(F.col(key), lanes)).repartition("_lane").sortWithinPartitions("_lane", key)

    def send(arrow_batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write, (fs, root) = writer(), open_root(ledger)
        lane, number, waiting, known = None, 0, [], set()

        def flush() -> dict:
            nonlocal number, waiting
            number, batch, waiting, error = number + 1, waiting, [], None
            sent = number not in known
            if sent:
                try:
                    write(lane, number, batch)
                    with fs.open_output_stream(f"{root}/{lane}/{number}"):
                        pass
                except Exception as failure:
                    error = str(failure)
            return {"lane": lane, "batch": number, "rows": len(batch), "sent": sent, "ok": error is None, "error": error}

        for arrow_batch in arrow_batches:
            done = []
            for row in arrow_batch.to_pylist():
                at = row.pop("_lane")
                if at != lane:
                    if waiting:
                        done.append(flush())
                    lane, number = at, 0
                    fs.create_dir(f"{root}/{lane}", recursive=True)
                    known = {int(f.base_name) for f in fs.get_file_info(pa.fs.FileSelector(f"{root}/{lane}"))}
                waiting.append(row)
                if len(waiting) == batch_size:
                    done.append(flush())
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=_ONCE)
        if waiting:
            yield pa.RecordBatch.from_pylist([flush()], schema=_ONCE)

    return spread.mapInArrow(send, ONCE_SCHEMA)


def export_counts(results: DataFrame) -> DataFrame:
    """``(succeeded, failed)`` rows over all batches, never below zero."""
    failed = F.coalesce(F.sum(F.when(~F.col("ok"), F.col("rows"))), F.lit(0))
    total = F.coalesce(F.sum("rows"), F.lit(0))
    return results.agg(
        F.greatest(F.lit(0), total - failed).cast("bigint").alias("succeeded"),
        failed.cast("bigint").alias("failed"),
    )


def export_changes(
    points: DataFrame, delete_ids: DataFrame, upsert: Callable[[], Writer], delete: Callable[[], Writer],
    batch_size: int = 128, delete_batch_size: int = 512, max_retries: int = 2, retry_delay: float = 5.0,
) -> DataFrame:
    """Send a run's points and then its deletions to an outside store.

    One row: ``upserted, upsert_failed, deleted, delete_failed``. Both writers get
    row dicts; a failed batch is counted and does not stop the others.
    """
    sent = export_counts(export_batches(points, upsert, batch_size, max_retries, retry_delay)).first()
    gone = export_counts(export_batches(delete_ids, delete, delete_batch_size, max_retries, retry_delay)).first()
    counts = (sent.succeeded, sent.failed, gone.succeeded, gone.failed)
    return points.sparkSession.createDataFrame(
        [counts], "upserted bigint, upsert_failed bigint, deleted bigint, delete_failed bigint"
    )
