"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Encoding a pre-token merges, again and again, the leftmost adjacent pair with the lowest merge
rank. The symbols stand in a doubly linked list. The queue has one bucket of list positions per
rank and a bitmap over the buckets in words of 64 bits, with a bitmap over the words and one over
those; find-first-set from the top gives the lowest rank in use in three steps. A merge pushes the
two new pairs and leaves the old ones behind: a position whose pair no longer has the bucket's rank
is stale and skipped when popped. A pre-token of n bytes costs O(n log n) in all, with no scan of
the list per merge, so a very long one is no worse per byte than a short one.

Many pre-tokens share one list and queue: each ends in a position without successor, and their
merges don't touch. A bucket is worked off in ascending position, and left at once for a lower rank
that a merge brings up.

Ranks are read from a file in the ``tiktoken`` form, sent to the executors as one broadcast (its
size is that of the vocabulary). Defined cases: a null or empty text has no ids and decodes to
nothing; lone surrogates are encoded as ``?``.
"""

from __future__ import annotations

import base64
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.common import add_columns, worker_state
from tidemark.llm.pretokens import UnitEncoder

#: Pairs whose rank a worker remembers.
PAIRS = 400_000


def read_ranks(path: str) -> list[bytes]:
    """The token of each id; ids must run from 0 without gap."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranks[i] for i in range(len(ranks))]


class RankQueue:
    """Buckets of positions by rank under a three-level bitmap (up to 64 ** 3 ranks)."""

    def __init__(self, ranks: int):
        if ranks > 1 << 18:
            raise ValueError("more than 262144 ranks")
        self.buckets: list[list[int] | None] = [None] * ranks
        self.top = 0
        self.middle = [0] * 64
        self.low = [0] * (64 * 64)

    def open(self, rank: int) -> list[int]:
        """A new empty bucket for ``rank``, which has none; the caller fills it."""
        bucket = self.buckets[rank] = []
        word = rank >> 6
        self.low[word] |= 1 << (rank & 63)
        self.middle[word >> 6] |= 1 << (word & 63)
        self.top |= 1 << (word >> 6)
        return bucket

    def first(self) -> int:
        """The lowest rank with a bucket, or -1."""
        if not self.top:
            return -1
        high = (self.top & -self.top).bit_length() - 1
        bits = self.middle[high]
        word = high << 6 | (bits & -bits).bit_length() - 1
        bits = self.low[word]
        return word << 6 | (bits & -bits).bit_length() - 1

    def clear(self, rank: int) -> None:
        self.buckets[rank] = None
        word = rank >> 6
        self.low[word] &= ~(1 << (rank & 63))
        if not self.low[word]:
            self.middle[word >> 6] &= ~(1 << (word & 63))
            if not self.middle[word >> 6]:
                self.top &= ~(1 << (word >> 6))


class BytePairEncoder:
    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.ids = {token: i for i, token in enumerate(tokens)}
        self.single = np.array([self.ids[bytes([b])] for b in range(256)])
        self.byte_pairs = np.array([[self.ids.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)])
        self.split = regex.compile(pattern).findall
        self.pairs: dict[int, int] = {}
        self.units = UnitEncoder(self.encode_units)
        self.encode, self.encode_many = self.units.encode, self.units.encode_many

    def encode_units(self, units: list[str]) -> list[bytes]:
        split, ids = self.split, self.ids
        parts: list = []  # of a unit: its pre-token, or the list of them
        pieces: set[bytes] = set()
        for unit in units:
            # A word with the space before it is one match of the pattern.
            if unit[:1] == " " and unit[1:].isalpha() or unit.isalpha():
                piece = unit.encode("utf-8", "replace")
                pieces.add(piece)
                parts.append(piece)
            else:
                found = [p.encode("utf-8", "replace") for p in split(unit)]
                pieces.update(found)
                parts.append(found)
        todo = [p for p in pieces if p not in ids]
        done = dict(zip(todo, self.merge(todo))) if todo else {}
        done.update((p, ids[p].to_bytes(4, "little")) for p in pieces if p in ids)
        return [done[p] if p.__class__ is bytes else b"".join([done[x] for x in p]) for p in parts]

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each pre-token, as little-endian unsigned 32-bit integers."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(data)
        ends = np.cumsum([len(p) for p in pieces])
        begins = np.concatenate([[0], ends[:-1]])
        first = np.full(n, -1, np.int64)
        first[:-1] = self.byte_pairs[data[:-1], data[1:]]
        first[ends - 1] = -1
        after = np.arange(1, n + 1)
        after[ends - 1] = -1
        before = np.arange(-1, n - 1)
        before[begins] = -1
        symbol, after, before, rank = self.single[data].tolist(), after.tolist(), before.tolist(), first.tolist()
        queue = RankQueue(len(self.tokens))
        buckets, pairs, find = queue.buckets, self.pairs.get, self._rank
        waiting = np.flatnonzero(first >= 0)
        waiting = waiting[np.argsort(first[waiting], kind="stable")]
        used, counts = np.unique(first[waiting], return_counts=True)
        waiting, at = waiting.tolist(), 0
        for r, count in zip(used.tolist(), counts.tolist()):
            queue.open(r).extend(waiting[at : at + count])
            at += count
        while (r := queue.first()) >= 0:
            bucket = buckets[r]
            bucket.sort()
            left = r << 20
            done = 0
            lower = False
            for i in bucket:
                done += 1
                if rank[i] != r:
                    continue  # stale
                j = after[i]
                symbol[i], symbol[j], rank[i], rank[j] = r, -1, -1, -1
                k = after[i] = after[j]
                if k >= 0:
                    before[k] = i
                    key = left | symbol[k]
                    new = pairs(key)
                    if new is None:
                        new = find(key)
                    if new >= 0:
                        rank[i] = new
                        known = buckets[new]
                        if known:
                            known.append(i)
                        else:
                            queue.open(new).append(i)
                        lower = new < r
                h = before[i]
                if h >= 0:
                    key = symbol[h] << 20 | r
                    new = pairs(key)
                    if new is None:
                        new = find(key)
                    rank[h] = new
                    if new >= 0:
                        known = buckets[new]
                        if known:
                            known.append(h)
                        else:
                            queue.open(new).append(h)
                        lower = lower or new < r
                if lower:
                    break
            if done < len(bucket):
                del bucket[:done]
            else:
                queue.clear(r)
        alive = np.array(symbol)
        counts = np.add.reduceat(alive >= 0, begins, dtype=np.int64)
        raw = alive[alive >= 0].astype("<u4").tobytes()
        stops = (4 * np.cumsum(counts)).tolist()
        return [raw[a:b] for a, b in zip([0, *stops[:-1]], stops)]

    def _rank(self, key: int) -> int:
        """The id that a pair merges to, which is its rank, or -1."""
        rank = self.ids.get(self.tokens[key >> 20] + self.tokens[key & 0xFFFFF], -1)
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        self.pairs[key] = rank
        return rank

    def decode(self, ids: bytes) -> bytes:
        """The bytes of ids given as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.tokens.__getitem__, array("I", ids)))


def encoder(broadcast) -> BytePairEncoder:
    """The worker's encoder for broadcast ``(key, tokens, pattern)``; it keeps what it has learned."""
    key, tokens, pattern = broadcast.value
    state = worker_state()
    if ("bpe", key) not in state:
        state[("bpe", key)] = BytePairEncoder(tokens, pattern)
    return state[("bpe", key)]


def vocabulary(spark, path: str, pattern: str):
    """Broadcast of a vocabulary file read on the driver."""
    tokens = read_ranks(path)
    return spark.sparkContext.broadcast((f"{path}:{len(tokens)}:{pattern}", tokens, pattern))


def with_ids(docs: DataFrame, broadcast, text: str = "text", decode: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (binary: little-endian unsigned 32-bit) and, on request, the ``decoded`` bytes of these."""

    def run(part: pa.RecordBatch) -> list[pa.Array]:
        bpe = encoder(broadcast)
        ids = bpe.encode_many(part.column(text).to_pylist())
        out = [pa.array(ids, pa.binary())]
        return [*out, pa.array(map(bpe.decode, ids), pa.binary())] if decode else out

    return add_columns(docs, run, "ids binary, decoded binary" if decode else "ids binary", text)


def ids_array(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u4")
