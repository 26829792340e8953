"""Benchmark decontamination: a broadcast set of normalised test n-grams, scanned over whole texts.

Words are runs of digits, lower-cased A-Z and everything outside ASCII. A window is ``n``
consecutive words of a test item; an item with fewer words (but some) is one window. A training
word inside any occurrence of a window is hit.

The scan maps words to numbers through the vocabulary of the items, so a stretch with a word that
no item has costs one dictionary probe per word. Where enough known words follow each other, a
rolling key proposes windows and the exact tuple of word numbers confirms them.

Only the items' windows are broadcast. Their words are counted first: beyond ``block_words`` the
items are dealt into blocks by hash and the texts are scanned once per block, so no broadcast
exceeds that bound, whatever the size of the item table.

Defined cases: a null or empty text has no words; an item without words has no window; a null
``item_id`` is reported as the string ``null``; repeated items count once per id; empty tables
give no hits. Texts are processed in segments, so very long ones need no more memory.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, worker_state

WINDOW = 10
#: Most words of items in one broadcast: about 200 bytes a word in a worker.
BLOCK_WORDS = 500_000
#: Bytes of a text cut into words at once.
SEGMENT = 4 << 20

#: Upper case to lower case; bytes that belong to no word to spaces.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_HIT = "n_words long, starts array<long>, stops array<long>, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _segments(text: str | None) -> Iterator[list[bytes]]:
    data = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    at = 0
    while at < len(data):
        stop = data.find(b" ", at + SEGMENT)
        stop = len(data) if stop < 0 else stop
        yield data[at:stop].split()
        at = stop


class WindowIndex:
    """The windows of some items: exact by word numbers, grouped by length."""

    def __init__(self, items: list[tuple[str, str | None]], n: int):
        self.n = n
        self.vocabulary: dict[bytes, int] = {}
        self.windows: dict[int, dict[tuple[int, ...], list[str]]] = {}
        for item, text in items:
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            size = min(n, len(numbers))
            if size:
                known = self.windows.setdefault(size, {})
                for i in range(len(numbers) - size + 1):
                    owners = known.setdefault(tuple(numbers[i : i + size]), [])
                    if item not in owners:
                        owners.append(item)
        self.keys = {
            size: np.unique(_rolling(np.array([w for ws in known for w in ws], np.uint64), size)[::size])
            for size, known in self.windows.items()
        }

    def scan(self, text: str | None) -> tuple[int, list[int], list[int], list[str]]:
        """Words, disjoint hit ranges (first word, word after the last), items found."""
        total, carried = 0, np.zeros(0, np.int64)
        found: list[tuple[int, int]] = []
        items: set[str] = set()
        for words in _segments(text):
            numbers = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))
            base = total - len(carried)
            total += len(words)
            numbers = np.concatenate([carried, numbers])
            found.extend((base + i, base + i + size) for i, size in self._hits(numbers, items))
            carried = numbers[-(self.n - 1) :] if self.n > 1 else carried
        starts: list[int] = []
        stops: list[int] = []
        for start, stop in sorted(set(found)):
            if stops and start <= stops[-1]:
                stops[-1] = max(stops[-1], stop)
            else:
                starts.append(start)
                stops.append(stop)
        return total, starts, stops, sorted(items)

    def _hits(self, numbers: np.ndarray, items: set[str]) -> Iterator[tuple[int, int]]:
        known = np.concatenate([[0], np.cumsum(numbers > 0)])
        for size, windows in self.windows.items():
            if len(numbers) < size:
                continue
            at = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(at):
                continue
            keys = np.zeros(len(at), np.uint64)
            for j in range(size):
                keys = keys * _FACTOR + numbers[at + j].astype(np.uint64)
            table = self.keys[size]
            place = np.minimum(np.searchsorted(table, keys), len(table) - 1)
            for i in at[table[place] == keys].tolist():
                owners = windows.get(tuple(numbers[i : i + size].tolist()))
                if owners:
                    items.update(owners)
                    yield i, size


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _rolling(numbers: np.ndarray, size: int) -> np.ndarray:
    keys = np.zeros(len(numbers) - size + 1, np.uint64)
    for j in range(size):
        keys = keys * _FACTOR + numbers[j : len(numbers) - size + 1 + j]
    return keys


def _index(broadcast) -> WindowIndex:
    """The index of broadcast ``(key, items, n)``, built once in a worker."""
    key, items, n = broadcast.value
    state = worker_state()
    if state.get("windows", (None,))[0] != key:
        state["windows"] = (key, WindowIndex(items, n))
    return state["windows"][1]


def _share(frame: DataFrame, n: int):
    """Broadcast of the rows ``(item, text)`` of ``frame``, whose size the caller has checked."""
    items = [(r.item, r.text) for r in frame.collect()]
    return frame.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, items, n))


def _scan_column(text: Column, broadcast) -> Column:
    @F.pandas_udf(_HIT)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = _index(broadcast)
        for texts in batches:
            yield pd.DataFrame(
                [index.scan(t) for t in texts], columns=["n_words", "starts", "stops", "items"]
            )

    return scan(text)


def _joined(hits: list[Column]) -> Column:
    """Number of hit words in the union of the ranges of several scans (ranges of one scan are disjoint)."""
    ranges = F.sort_array(F.flatten(F.array(*[F.arrays_zip(h["starts"].alias("a"), h["stops"].alias("b")) for h in hits])))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(
        ranges, zero,
        lambda s, r: F.struct(
            (s["n"] + F.greatest(F.lit(0), r["b"] - F.greatest(r["a"], s["end"]))).cast("long").alias("n"),
            F.greatest(s["end"], r["b"]).cast("long").alias("end"),
        ),
        lambda s: s["n"],
    )


def _scanned(
    docs: DataFrame, items: DataFrame, scratch: str, text: str, item_id: str, item_text: str, n: int, block_words: int
) -> tuple[DataFrame, list[Column]]:
    """``docs`` as the struct ``row``, and what each block of items hits in the whole texts."""
    items = items.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), F.col(item_text).alias("text")
    )
    # A word takes two bytes at least, with what ends it.
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (2 * block_words)))
    frame = docs.select(F.struct("*").alias("row"))
    hits = []
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        frame = frame.withColumn(f"hit{b}", _scan_column(F.col("row")[text], _share(part, n)))
        if blocks > 1:
            frame = materialise(frame, f"{scratch}/block{b}")
        hits.append(F.col(f"hit{b}"))
    return frame, hits


def contamination(
    docs: DataFrame, items: DataFrame, scratch: str, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", n: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """All columns of ``docs`` as the struct ``row``, and ``n_words``, ``n_hit``, ``items`` (sorted strings)."""
    frame, hits = _scanned(docs, items, scratch, text, item_id, item_text, n, block_words)
    return frame.select(
        "row", hits[0]["n_words"].alias("n_words"), _joined(hits).alias("n_hit"),
        F.sort_array(F.array_distinct(F.flatten(F.array(*[h["items"] for h in hits])))).alias("items"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, scratch: str, **options) -> DataFrame:
    """``docs`` without the rows that hold a window of an item."""
    return contamination(docs, items, scratch, **options).where("n_hit = 0").select("row.*")


def cut_spans(text: str | None, starts: list[int], stops: list[int]) -> str | None:
    """``text`` without its hit words and what stands between them."""
    if text is None or not len(starts):
        return text
    data = text.encode("utf-8", "surrogatepass")
    folded, places, at = data.translate(_FOLD), [], 0
    for word in folded.split():
        at = folded.index(word, at)
        places.append((at, at + len(word)))
        at += len(word)
    kept, last = [], 0
    for a, b in zip(starts, stops):
        kept.append(data[last : places[a][0]])
        last = places[b - 1][1]
    return b"".join([*kept, data[last:]]).decode("utf-8", "surrogatepass")


def _union(starts: list[int], stops: list[int]) -> tuple[list[int], list[int]]:
    """The maximal runs of words that the ranges cover."""
    runs: list[list[int]] = []
    for a, b in sorted(zip(starts, stops)):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    return [a for a, _ in runs], [b for _, b in runs]


def remove_spans(
    docs: DataFrame, items: DataFrame, scratch: str, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", n: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with the hit words of all items cut from their texts, in blocks of items like ``contamination``."""
    frame, hits = _scanned(docs, items, scratch, text, item_id, item_text, n, block_words)

    @F.pandas_udf("string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, starts, stops in batches:
            yield pd.Series([cut_spans(t, *_union(list(a), list(b))) for t, a, b in zip(texts, starts, stops)], dtype=object)

    starts, stops = (F.flatten(F.array(*[h[x] for h in hits])) for x in ("starts", "stops"))
    return frame.withColumn("cut", cut(F.col("row")[text], starts, stops)).select(
        *[F.col("cut").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns]
    )
