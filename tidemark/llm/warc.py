"""WARC archives: writing, normalising whole-file gzip to one member per record, reading by offset.

``write_archives`` turns rows into WARC records in whole-file gzip streams, as many crawlers do. Such
a stream can only be read from its start. ``normalise`` inflates each stream once, in pieces, rewrites
every record as a gzip member of its own, and writes beside the archive an offset index (one line a
record: offset, length, type, record id), which it also returns as a table. ``read_records`` then
fetches any records by offset, split over tasks like rows of any table.

A stream is one task's work by nature, so writers start a new archive after ``roll_bytes``. Pieces of
PIECE bytes are inflated and deflated at a time, so neither archives nor records need to fit memory on
the way through. Files carry the task attempt in their names, and only the names of successful
attempts reach the listing, so repeated tasks leave nothing a reader would see.

Equal payloads: of records with equal payloads of at least ``revisit_bytes``, the one with the largest
id is the response and the others are revisits, which carry digest and length but no payload. Ids are
the integer keys of the rows.

Defined cases: a null payload is empty; a null URL leaves the header out; a null id is written as
``null``, is never referred to unless all ids of a payload are null, in which case all are responses;
rows that repeat the largest id are responses each; an empty table gives no archive.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, open_fs, row_slices

#: Bytes handled at once, archive size before compression, and smallest payload that may be a revisit.
PIECE, ROLL_BYTES, REVISIT_BYTES = 1 << 20, 256 << 20, 1000
_ID = "urn:tidemark:page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def plan_records(pages: DataFrame, key: str, url: str, payload: str, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``id, url, payload (binary), digest, type, refers_to`` of each row."""
    rows = pages.select(
        F.col(key).cast("long").alias("id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    # Partial maxima per map task: a digest shared by many rows costs a row per task.
    keepers = (
        rows.where(F.octet_length("payload") >= revisit_bytes).groupBy("digest")
        .agg(F.max("id").alias("keeper"), F.count("*").alias("n")).where("n > 1").select("digest", "keeper")
    )
    # The payload is left out of repeats; AQE splits a digest that holds a large share of the rows.
    repeat = (F.octet_length("payload") >= revisit_bytes) & F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))
    return rows.join(keepers, "digest", "left").select(
        "id", "url", "digest", F.octet_length("payload").cast("long").alias("size"),
        F.when(repeat, F.lit(None).cast("binary")).otherwise(F.col("payload")).alias("payload"),
        F.when(repeat, "revisit").otherwise("response").alias("type"),
        F.when(repeat, F.col("keeper")).alias("refers_to"),
    )


def record_bytes(row: dict, date: str) -> bytes:
    """One WARC/1.1 record with an HTTP head; a revisit has no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n".encode()
    body = http + (row["payload"] or b"")
    head = ["WARC/1.1", f"WARC-Type: {row['type']}", f"WARC-Record-ID: <{_ID}{_text(row['id'])}>", f"WARC-Date: {date}"]
    if row["url"] is not None:
        target = "".join(c if c > " " else f"%{ord(c):02X}" for c in row["url"])
        head.append(f"WARC-Target-URI: {target}")
    head.append(f"WARC-Payload-Digest: sha1:{row['digest']}")
    if row["type"] == "revisit":
        head += [f"WARC-Refers-To: <{_ID}{_text(row['refers_to'])}>", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _text(value: int | None) -> str:
    return "null" if value is None else str(value)


def _number(uri: str | None) -> int | None:
    value = (uri or "").strip().strip("<>").removeprefix(_ID)
    return int(value) if value and value != "null" else None


class _Output:
    """A file of the running task attempt, opened at its first byte."""

    def __init__(self, folder: str, prefix: str, number: int, suffix: str):
        context = TaskContext.get()
        self.name = f"{prefix}-{context.partitionId():06d}-{context.taskAttemptId()}-{number:04d}{suffix}"
        fs, path = open_fs(folder)
        fs.create_dir(path, recursive=True)
        self.stream, self.size = fs.open_output_stream(f"{path}/{self.name}", compression=None), 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()


def write_archives(
    records: DataFrame, folder: str, date: str, roll_bytes: int = ROLL_BYTES, level: int = 6
) -> DataFrame:
    """Write rows of :func:`plan_records` as whole-file gzip archives; returns their listing (``file, records``)."""
    schema = pa.schema([("file", pa.string()), ("records", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        out, packer, held, records_in = None, None, 0, 0

        def close() -> None:
            nonlocal out
            if out is not None:
                out.write(packer.flush())
                out.close()
                done.append({"file": out.name, "records": records_in})
                out = None

        for batch in batches:
            for part in row_slices(batch, "payload"):
                for row in part.to_pylist():
                    if out is None:
                        out = _Output(folder, "crawl", len(done), ".warc.gz")
                        packer, held, records_in = zlib.compressobj(level, zlib.DEFLATED, 31), 0, 0
                    data = record_bytes(row, date)
                    out.write(packer.compress(data))
                    held += len(data)
                    records_in += 1
                    if held >= roll_bytes:
                        close()
        close()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)

    return materialise(records.mapInArrow(write, "file string, records long"), f"{folder}/listing")


def inflate(source, piece: int = PIECE) -> Iterator[bytes]:
    """The bytes of a gzip stream of any number of members, in pieces."""
    machine = zlib.decompressobj(31)
    data = source.read(piece)
    while data:
        yield machine.decompress(data, piece)
        data = machine.unconsumed_tail
        if machine.eof:
            data = machine.unused_data
            machine = zlib.decompressobj(31)
        data = data or source.read(piece)
    if not machine.eof and (rest := machine.flush()):
        yield rest


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
    """Header fields (lower case) and the raw bytes, header included, of each record; read them in order."""
    buffer = bytearray()

    def more() -> bool:
        for piece in pieces:
            if piece:
                buffer.extend(piece)
                return True
        return False

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not more():
                if buffer.strip():
                    raise ValueError("a record ends early")
                return
        head = bytes(buffer[: end + 4])
        lines = head.decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}
        total = end + 4 + int(fields["content-length"]) + 4

        def body(left: int = total) -> Iterator[bytes]:
            while left:
                if not buffer and not more():
                    raise ValueError("a record ends early")
                part = bytes(buffer[:left])
                del buffer[: len(part)]
                left -= len(part)
                yield part

        raw = body()
        yield fields, raw
        for _ in raw:  # what the caller has left
            pass


def normalise(listing: DataFrame, folder: str, target: str, level: int = 6) -> DataFrame:
    """Rewrite each archive of ``listing`` with a gzip member per record below ``target``.

    Returns the offset index as a table: ``file, offset, length, type, record``.
    """
    names = ("file", "offset", "length", "type", "record")
    schema = pa.schema([
        ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("type", pa.string()), ("record", pa.string()),
    ])
    tasks = max(1, listing.sparkSession.sparkContext.defaultParallelism * 4)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_fs(folder)
        number = 0
        for batch in batches:
            for name in batch.column("file").to_pylist():
                out = _Output(target, "records", number, ".warc.gz")
                side = _Output(target, "records", number, ".idx")
                number += 1
                rows: list[tuple] = []
                with fs.open_input_stream(f"{path}/{name}", compression=None) as source:
                    for fields, raw in split_records(inflate(source)):
                        offset, packer = out.size, zlib.compressobj(level, zlib.DEFLATED, 31)
                        for piece in raw:
                            out.write(packer.compress(piece))
                        out.write(packer.flush())
                        row = (out.name, offset, out.size - offset, fields.get("warc-type", ""), fields.get("warc-record-id", ""))
                        side.write(("\t".join(map(str, row[1:])) + "\n").encode())
                        rows.append(row)
                        if len(rows) >= 10_000:
                            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=schema)
                            rows = []
                out.close()
                side.close()
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=schema)

    spread = listing.repartition(tasks, "file")
    ddl = "file string, offset long, length long, type string, record string"
    return materialise(spread.mapInArrow(rewrite, ddl), f"{target}/index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """``id, url, payload_bytes, payload_digest, record_type, refers_to, payload`` of the records of ``index``.

    Digest and length of a response are taken from its payload, and must equal its header; those
    of a revisit from its headers.
    """
    schema = pa.schema([
        ("id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_fs(folder)
        opened, source = None, None
        rows: list[dict] = []
        held = 0
        for batch in batches:
            for entry in batch.to_pylist():
                if entry["file"] != opened:
                    opened, source = entry["file"], fs.open_input_file(f"{path}/{entry['file']}")
                raw = zlib.decompress(source.read_at(entry["length"], entry["offset"]), 31)
                fields, parts = next(split_records(iter([raw])))
                block = b"".join(parts)
                block = block[block.index(b"\r\n\r\n") + 4 : -4]
                http, _, payload = block.partition(b"\r\n\r\n")
                size = next(int(x[15:]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                kind = fields["warc-type"]
                if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                    raise ValueError(f"damaged record {fields['warc-record-id']}")
                rows.append({
                    "id": _number(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "payload_bytes": size,
                    "payload_digest": digest, "record_type": kind, "refers_to": _number(fields.get("warc-refers-to")),
                    "payload": payload if kind == "response" else None,
                })
                held += len(payload)
                if held >= 8 << 20 or len(rows) >= 10_000:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    ddl = "id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return index.select("file", "offset", "length").mapInArrow(read, ddl)
