"""Importance resampling towards a target: documents whose words are likelier there are drawn more often.

Features are the runs of one to three words; each counts in a bucket, the CRC-32 of its bytes modulo the number of
buckets. The CRC of a longer run follows from those of its parts (the checksum is linear), so a slice of texts is hashed
by table gathers, and a weight is the sum of gathered gains. A score adds to the weight noise that depends on the id
alone, so the highest scores are a draw without replacement.

Ranks come from sorting by regular sampling: every task sorts its own run; rows at regular places of the runs give the
splitters; rows go to the segment between two splitters, where the runs are merged; the counts of the segments
before give each row its rank. Segments in which nobody can be drawn any more are counted and not exchanged.
Rows are told apart by their place in their run too, so equal scores and ids fill no segment beyond the others.

Defined cases: a null or empty text has no words, no features and weight 0. A null id is hashed as ``null`` and ranks
before others of its score. Repeated rows are documents of their own, ranked by their place. Without target texts, or
without documents, counts are zero and the formula holds. A text is cut into pieces between words, so long ones
need no more memory; a single word of any length is one piece.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, materialise, row_slices, worker_state

BUCKETS = 10_000
#: Bytes of text cut into words at once.
PIECE = 1 << 20
#: Longest word whose run is hashed by tables.
TABLED = 64
#: Rows that a segment is meant to have, most segments, and regular samples for each.
SEGMENT_ROWS, MOST_SEGMENTS, SAMPLES = 4096, 4096, 16

#: Upper case to lower case; bytes that belong to no word to spaces.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Rows of a partition are numbered below this in ``monotonically_increasing_id``.
_PLACES = (1 << 33) - 1


def _shifts() -> tuple[np.ndarray, np.ndarray]:
    """By size of a word: tables that carry a checksum over a space and the word, and the space's own part."""
    state = worker_state()
    if "shifts" not in state:
        byte = np.arange(256, dtype=np.uint32)
        table = byte.copy()
        for _ in range(8):
            table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1)
        by_size = [np.stack([byte << np.uint32(8 * k) for k in range(4)])]
        for _ in range(TABLED + 1):
            x = by_size[-1]
            by_size.append(table[x & 0xFF] ^ (x >> 8))
        space = [np.uint32(zlib.crc32(b" "))]
        for _ in range(TABLED):
            space.append(table[space[-1] & 0xFF] ^ (space[-1] >> np.uint32(8)))
        state["shifts"] = np.stack(by_size).reshape(-1), np.array(space, np.uint32)
    return state["shifts"]


def _longer(before: np.ndarray, words: list[bytes], crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Checksums of runs that a space and a word make longer."""
    tables, space = _shifts()
    short = np.minimum(size, TABLED)
    at = (short + 1) * 1024
    out = crc ^ space[short]
    for k in range(4):
        out ^= tables[at + 256 * k + ((before >> np.uint32(8 * k)) & np.uint32(0xFF))]
    for i in np.flatnonzero(size > TABLED).tolist():
        out[i] = zlib.crc32(b" " + words[i], int(before[i]))
    return out


def _pieces(texts: list[str | None]) -> Iterator[tuple[list[bytes], np.ndarray, int]]:
    """Words of texts with the number of their text; the first so many words were in the piece before."""
    for number, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
        at, carried = 0, []
        while at < len(data):
            stop = data.find(b" ", at + PIECE)
            stop = len(data) if stop < 0 else stop
            words = carried + data[at:stop].split()
            yield words, np.full(len(words), number), len(carried)
            at, carried = stop, words[-2:]


def _gathered(texts: list[str | None]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Pieces of many texts put together: words, number of the text, whether the word is new."""
    words: list[bytes] = []
    numbers: list[np.ndarray] = []
    new: list[np.ndarray] = []
    for some, number, carried in _pieces(texts):
        if carried and words:
            # The words carried over are a run of their own.
            yield words, np.concatenate(numbers), np.concatenate(new)
            words, numbers, new = [], [], []
        words.extend(some)
        numbers.append(number)
        new.append(np.arange(len(some)) >= carried)
        if len(words) * 8 > PIECE:
            yield words, np.concatenate(numbers), np.concatenate(new)
            words, numbers, new = [], [], []
    if words:
        yield words, np.concatenate(numbers), np.concatenate(new)


def features(texts: list[str | None], buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Number of the text and bucket of each feature, and of each word its text, in pieces of bounded size."""
    for words, number, new in _gathered(texts):
        size = np.fromiter(map(len, words), np.int64, len(words))
        one = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        pair = number[1:] == number[:-1]
        two = _longer(one[:-1], words[1:], one[1:], size[1:])
        three = _longer(two[:-1], words[2:], one[2:], size[2:])
        keep = (new, pair & new[1:], pair[:-1] & pair[1:] & new[2:])
        yield (
            np.concatenate([number[len(number) - len(k):][k] for k in keep]),
            np.concatenate([x[k] for x, k in zip((one, two, three), keep)]) % np.uint32(buckets),
            number[new],
        )


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket; a task adds up its own before anything moves."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in row_slices(batch, "t"):
                for _, bucket, _ in features(part.column("t").to_pylist(), buckets):
                    total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    parts = df.select(F.col(text).alias("t")).mapInArrow(count, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket: a thousand times the log of how much likelier it is in the target, rounded down."""
    smooth = len(own)
    total, wanted = float(own.sum() + smooth), float(target.sum() + smooth)
    return np.array([
        math.floor(1000 * math.log(float(t + 1) * total / (float(s + 1) * wanted))) for s, t in zip(own.tolist(), target.tolist())
    ], np.int64)


def noise(id, seed: str) -> int:
    """A thousand times a Gumbel variable that depends on the id alone, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{'null' if id is None else id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(
    docs: DataFrame, gain: np.ndarray, id: str = "doc_id", text: str = "text", seed: str = "42", columns: tuple[str, ...] = (),
) -> DataFrame:
    """``id, n_words, n_features, weight, score`` of each row, and the named ``columns`` in the struct ``row``."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    rows = docs.select(
        F.col(id).alias("id"), F.struct(F.lit(0).alias("_"), *columns).alias("row"), F.col(text).alias("t")
    )
    kinds = [f"{rows.schema[c].name} {rows.schema[c].dataType.simpleString()}" for c in ("id", "row")]

    def score(part: pa.RecordBatch) -> list[tuple]:
        texts, ids = part.column("t").to_pylist(), part.column("id").to_pylist()
        n = len(texts)
        words, count, weight = (np.zeros(n, np.int64) for _ in range(3))
        for number, bucket, owner in features(texts, len(shared.value)):
            words += np.bincount(owner, minlength=n)
            count += np.bincount(number, minlength=n)
            np.add.at(weight, number, shared.value[bucket])
        return [
            (i, r, w, c, x, x + noise(i, seed))
            for i, r, w, c, x in zip(ids, part.column("row").to_pylist(), words.tolist(), count.tolist(), weight.tolist())
        ]

    return map_rows(rows, score, ", ".join([*kinds, "n_words long, n_features long, weight long, score long"]), "t")


def ranked(rows: DataFrame, scratch: str, eligible: str, share: int, of: int) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, 3 ... for the ``share / of`` eligible rows of highest ``score``, else null.

    Ties go to the smaller ``id``.
    """
    order = [F.desc("score"), F.asc("id")]
    # Eligible rows come first, so they are numbered from 0 in each run.
    runs = rows.withColumn("eligible", F.coalesce(F.expr(eligible), F.lit(False))).sortWithinPartitions(F.desc("eligible"), *order)
    runs = materialise(runs.withColumn("place", F.monotonically_increasing_id()), f"{scratch}/runs")
    total = runs.where("eligible").count()
    drawn = share * total // of
    segments = max(1, min(MOST_SEGMENTS, total // SEGMENT_ROWS))
    every = max(1, total // (SAMPLES * segments))
    # At most SAMPLES rows for each segment, and one for each run.
    sample = runs.where(F.col("eligible") & (F.col("place").bitwiseAND(F.lit(_PLACES)) % every == 0))
    keys = [_key(r.score, r.id, r.place) for r in sample.orderBy(*order, "place").select("score", "id", "place").collect()]
    splitters = [keys[i * len(keys) // segments] for i in range(1, segments)]

    @F.pandas_udf("int")
    def segment(score: pd.Series, id: pd.Series, place: pd.Series) -> pd.Series:
        own = zip(score.tolist(), id.astype(object).where(id.notna(), None).tolist(), place.tolist())
        return pd.Series([bisect_right(splitters, _key(*x)) for x in own], dtype="int32")

    cut = runs.where("eligible").withColumn("segment", segment("score", "id", "place"))
    cut = materialise(cut, f"{scratch}/segments")
    sizes = {r.segment: r["count"] for r in cut.groupBy("segment").count().collect()}
    before = [0, *accumulate(sizes.get(i, 0) for i in range(segments))]
    wanted = max(1, sum(b < drawn for b in before[:-1]))
    none = F.lit(None).cast("long")
    columns = rows.columns
    merged = cut.where(F.col("segment") < wanted).repartitionById(wanted, F.col("segment")).sortWithinPartitions(*order, "place")
    ahead = F.element_at(F.array(*[F.lit(b).cast("long") for b in before[:wanted]]), F.col("segment") + 1)
    rank = ahead + F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACES)) + 1
    merged = merged.withColumn("rank", rank).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return merged.select(*columns, "rank").unionByName(
        cut.where(F.col("segment") >= wanted).select(*columns, none.alias("rank"))
    ).unionByName(runs.where("NOT eligible").select(*columns, none.alias("rank")))


def _key(score: int, id, place: int) -> tuple:
    return -score, id is not None, id, place


def resample(
    docs: DataFrame, target: DataFrame, scratch: str, id: str = "doc_id", text: str = "text", target_text: str = "text",
    share: int = 5, of: int = 100, min_words: int = 20, seed: str = "42", buckets: int = BUCKETS, columns: tuple[str, ...] = (),
) -> DataFrame:
    """``id, row, n_words, n_features, weight, score, rank`` of each row of ``docs``; ``rank`` is null for what is not drawn.

    ``columns`` of ``docs`` travel along in ``row``: the text, say, when the drawn texts are wanted.
    """
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    return ranked(scored(docs, gain, id, text, seed, columns), scratch, f"n_words >= {min_words}", share, of)
