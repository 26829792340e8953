"""Token ids as Simple-8b words in files that any task can read in part.

A word of 64 bits holds a selector (4 bits) and as many ids as fit at one width: 60 of 1 bit down
to 1 of 60. Selector 15 is an escape: its payload is a position in a list of raw 64-bit values, so
ids beyond 60 bits keep their place and a reader never has to look at the word before.

A file is a row of blocks. A block holds whole documents in order and can be decoded alone:

    header    6 x u64: magic, documents, ids, words, escapes, flags (1: the ids of the documents are there)
    documents i64 id of each (its null flags follow as u8), u64 count of each
    words     u64 each
    escapes   u64 each

The index of blocks (file, offset, bytes, documents, ids) is a table beside the files. A reader
splits it like any table; within a block the decoder works on all words of a selector at once.

Null texts are empty ones; a document without ids is one with the end id alone; repeated rows are documents of their own; an empty table gives no file. A document is one block, so a very long one is held as a whole by its task.

Files are written under a name of the task attempt, and only the index of successful attempts is
committed, so lost executors and repeated tasks leave nothing a reader would see.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, open_fs, row_slices, worker_state
from tidemark.llm.pretokens import SPACES, UnitEncoder

# Ids a word and bits an id, by selector; 15 is the escape.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 15
MAGIC = 0x3142385344494B54
#: Ids in a block, apart from a longer document, which has one of its own.
BLOCK_IDS = 1 << 18


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and escapes of ``ids`` (unsigned 64-bit)."""
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    # Bits of each id: the powers of two it reaches.
    if ids.max() < 1 << 53:  # a double is exact
        bits = np.frexp(ids.astype(np.float64))[1].astype(np.int8)
    else:
        bits = np.searchsorted(np.array([1 << w for w in range(64)], np.uint64), ids, side="right").astype(np.int8)
    # The largest width among the next ``count`` ids decides whether a selector fits there.
    selector = np.full(n, ESCAPE, np.int8)
    largest, reach = bits, 1  # of the next ``reach`` ids
    for s in range(len(COUNTS) - 1, -1, -1):
        count, width = COUNTS[s], WIDTHS[s]
        if count > n:
            break
        while reach < count:
            step = min(reach, count - reach)
            largest = np.maximum(largest[:-step], largest[step:])
            reach += step
        fits = largest <= width
        if not fits.any():
            break  # more ids have fewer bits each
        selector[: len(fits)][fits] = s
    step = np.array([*COUNTS, 0, 1], np.uint8)[selector].tobytes()
    heads, i = [], 0
    while i < n:
        heads.append(i)
        i += step[i]
    heads = np.array(heads)
    chosen = selector[heads]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen).tolist():
        at = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            words[at] |= np.arange(len(at), dtype=np.uint64)
            continue
        first = heads[at]
        filled = words[at]
        for j in range(COUNTS[s]):
            filled |= ids[first + j] << np.uint64(j * WIDTHS[s])
        words[at] = filled
    return words, ids[heads[chosen == ESCAPE]]


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ids of ``words`` and ``escapes``."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    stops = np.cumsum(np.array([*COUNTS, 0, 1])[chosen])
    out = np.zeros(stops[-1] if len(stops) else 0, np.uint64)
    payload = words & np.uint64((1 << 60) - 1)
    for s in np.unique(chosen).tolist():
        at = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            out[stops[at] - 1] = escapes[payload[at].astype(np.int64)]
            continue
        mask = np.uint64((1 << WIDTHS[s]) - 1)
        for j in range(COUNTS[s]):
            out[stops[at] - COUNTS[s] + j] = payload[at] >> np.uint64(j * WIDTHS[s]) & mask
    return out


def block_bytes(keys: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    """A block of documents given by id and number of token ids, and all their token ids."""
    words, escapes = pack(ids)
    counts = np.array(counts, "<u8")
    header = np.array([MAGIC, len(keys), int(counts.sum()), len(words), len(escapes), 1], "<u8")
    return b"".join([
        header.tobytes(), np.array([k or 0 for k in keys], "<i8").tobytes(),
        np.array([k is None for k in keys], "u1").tobytes(), counts.tobytes(),
        words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes(),
    ])


def read_block(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, counts, and all token ids of a block."""
    magic, docs, total, words, escapes, _ = np.frombuffer(data, "<u8", 6).tolist()
    if magic != MAGIC:
        raise ValueError("not a block")
    at = 48
    keys = np.frombuffer(data, "<i8", docs, at).tolist()
    null = np.frombuffer(data, "u1", docs, at + 8 * docs).tolist()
    at += 9 * docs
    counts = np.frombuffer(data, "<u8", docs, at).astype(np.int64)
    at += 8 * docs
    ids = unpack(np.frombuffer(data, "<u8", words, at), np.frombuffer(data, "<u8", escapes, at + 8 * words))
    if len(ids) != total:
        raise ValueError("damaged block")
    return [None if z else k for k, z in zip(keys, null)], counts, ids


class LibraryEncoder:
    """Texts to ids (bytes of little-endian unsigned 32-bit integers) as the ``tokenizers`` library gives them.

    Like the library, it takes special strings of the vocabulary out of a text first; what stands between them are texts of their own.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        added = Tokenizer.from_file(path).get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("special strings that depend on what stands beside them are not supported")
        self.special = {t.content: np.array([i], "<u4").tobytes() for i, t in added.items()}
        # The longest first, as the library has it.
        self.cut = re.compile("|".join(f"({re.escape(c)})" for c in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.units = UnitEncoder(library_encoder(path))

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        parts = [[p for p in self.cut.split(t) if p is not None] if t and any(c in t for c in self.special) else [t] for t in texts]
        ids = self.units.encode_many([None if p in self.special else p for some in parts for p in some])
        if len(ids) == len(texts):
            return ids
        found = iter(ids)
        return [b"".join([self.special.get(p, x) for p, x in zip(some, found)]) for some in parts]


def library_encoder(path: str):
    """Units without special strings to ids, with the ``tokenizers`` library.

    Units of a space and what follows are encoded as one text: where a token starts with a space, a unit starts.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    spaced = np.array([
        (tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(tokenizer.get_vocab_size())
    ])

    def ids_of(texts: list[str]) -> list[np.ndarray]:
        found = tokenizer.encode_batch_fast([t.encode("utf-8", "replace").decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def encode(units: list[str]) -> list[bytes]:
        out: dict[str, bytes] = {}
        plain = [u for u in units if len(u) < 2 or u[0] != " " or u[1] in SPACES]
        out.update((u, ids.tobytes()) for u, ids in zip(plain, ids_of(plain)))
        rest = [u for u in units if u not in out]
        for i in range(0, len(rest), 2000):
            some = rest[i : i + 2000]
            ids = ids_of(["".join(some)])[0]
            raw, starts = ids.tobytes(), (4 * np.flatnonzero(spaced[ids])).tolist()
            out.update(zip(some, [raw[a:b] for a, b in zip(starts, [*starts[1:], len(raw)])], strict=True))
        return [out[u] for u in units]

    return encode


_INDEX = "part int, file string, block int, offset long, bytes long, docs long, ids long"


def write_ids(
    docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text", end: int = 0,
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Encode the texts, add ``end`` to each, write them in ascending ``key`` order below ``folder``.

    Returns the index of blocks, stored as ``folder/index``. Rows with equal keys come in the order of a hash of their
    texts, null keys first, null texts as empty ones.
    """
    ordered = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # The hash and the place deal out rows with one key, and equal rows, over several tasks.
    ordered = ordered.withColumn("h", F.xxhash64("t")).withColumn("place", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange("k", "h", "place").sortWithinPartitions("k", "h", "t", "place").select("k", "t")
    names = ("part", "file", "block", "offset", "bytes", "docs", "ids")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker_state()
        if ("ids", tokenizer) not in state:
            state[("ids", tokenizer)] = LibraryEncoder(tokenizer)
        encoder = state[("ids", tokenizer)]
        context = TaskContext.get()
        part, name = context.partitionId(), f"part-{context.partitionId():06d}-{context.taskAttemptId()}.s8b"
        fs, path = open_fs(folder)
        rows, out, offset, last = [], None, 0, np.array([end], "<u4").tobytes()
        keys: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def flush() -> None:
            nonlocal out, offset, size
            if not keys:
                return
            if out is None:
                fs.create_dir(path, recursive=True)
                out = fs.open_output_stream(f"{path}/{name}", compression=None)
            ids = np.frombuffer(b"".join(held), "<u4").astype(np.uint64)
            data = block_bytes(keys, [len(x) // 4 for x in held], ids)
            out.write(data)
            rows.append((part, name, len(rows), offset, len(data), len(keys), size))
            offset += len(data)
            keys.clear()
            held.clear()
            size = 0

        for batch in batches:
            for few in row_slices(batch, "t"):
                for k, ids in zip(few.column("k").to_pylist(), encoder.encode_many(few.column("t").to_pylist())):
                    n = len(ids) // 4 + 1
                    if size and size + n > block_ids:
                        flush()
                    keys.append(k)
                    held.append(ids + last)
                    size += n
        flush()
        if out is not None:
            out.close()
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=schema)

    schema = pa.schema([
        ("part", pa.int32()), ("file", pa.string()), ("block", pa.int32()), ("offset", pa.int64()),
        ("bytes", pa.int64()), ("docs", pa.int64()), ("ids", pa.int64()),
    ])
    return materialise(ordered.mapInArrow(write, _INDEX), f"{folder}/index")


def read_ids(index: DataFrame, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens``, ``ids_crc32``, ``ids`` (u32 little-endian) per document."""
    files = index.groupBy("part").agg(F.sum("ids").alias("n"))
    # One row per file, not per document: the only place where an order over everything is needed.
    before = files.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = index.withColumn("ahead", F.coalesce(F.sum("ids").over(within), F.lit(0))).join(before, "part")
    tasks = max(1, index.sparkSession.sparkContext.defaultParallelism * 4)
    blocks = blocks.select("file", "offset", "bytes", (F.col("base") + F.col("ahead")).alias("start")).repartition(
        tasks, "file", "offset"
    )
    schema = pa.schema([
        ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_fs(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{path}/{row['file']}") as source:
                    keys, counts, ids = read_block(source.read_at(row["bytes"], row["offset"]))
                raw = ids.astype("<u4").tobytes()
                stops = np.cumsum(counts)
                starts = stops - counts
                texts = [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), stops.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys, pa.int64()), pa.array(starts + row["start"], pa.int64()), pa.array(counts, pa.int64()),
                    pa.array([zlib.crc32(t) for t in texts], pa.int64()), pa.array(texts, pa.binary()),
                ], schema=schema)

    return blocks.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
