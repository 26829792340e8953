"""Removal of repeated byte strings by a distributed merge sort of suffixes.

A byte is removed if a string of ``length`` bytes (LENGTH, 400, unless the caller says otherwise) that covers it also starts anywhere
else in the corpus. Strings are judged on the input, and never cross texts.

1. Sampling. In each window of that length the core, a string of a third of it, with the least hash is the window's anchor.
   It depends on the window's bytes alone, so equal windows have equal anchors at the same offset, and
   about one position in 140 (for 400 bytes) becomes an anchor, which serves a range of windows around it. Anchors whose
   core occurs once cannot lie in a repeated window and are left out (the hash only ever lets too many through).
2. Runs. A task cuts the suffix at each remaining anchor (as long as any of its windows needs) and the bytes
   before it, sorts them, and front-codes the run: length of the prefix shared with the suffix before,
   then the rest. Runs are exchanged by the hash of the core, so suffixes with equal cores meet.
3. Merge. A loser tree merges the runs. Each head carries the length of its common prefix with the last
   output; the longer one wins unread, and equal ones are compared from there on, so no known prefix
   is compared again. The merge yields the sorted suffixes with their common prefixes.
4. Windows. Neighbours that share a core form a group. Within it, texts agree to the left of the anchor as a
   trie of the reversed bytes before it; at each node, the best common prefix among the node's suffixes in
   sorted order says which windows that start there are repeated. This decides all windows of an
   anchor at once, by the bytes themselves.

Copies of a whole text are found first, by its SHA-256: they repeat from end to end and take part in the
sort as one text. A core at HOT places or more, in however many texts, is not gathered in one place: the whole ranges that its
anchors serve, and where these are unique their windows, are sorted as strings of their own, spread by
their own hash, one per run and string, and only verdicts travel back to where they occur.

Defined cases: null and empty texts, and texts shorter than ``length``, lose nothing; a null id is no special
id; repeated rows are copies of each other; long texts are sampled in pieces of PIECE windows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, release, row_slices

LENGTH = 400
#: Windows sampled at once, places from which a core counts as hot (a group of so many takes some 20 MB), suffixes aimed at per
#: exchange bucket, and bytes of suffixes in a run.
PIECE, HOT, PER_BUCKET, RUN_BYTES = 1 << 20, 16_384, 10_000, 24 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BYTES = ((np.arange(1, 257, dtype=np.uint64) * _MIX) ^ (np.arange(1, 257, dtype=np.uint64) << np.uint64(17))) * np.uint64(0xBF58476D1CE4E5B9)
_PLACE = np.uint64((1 << 24) - 1)


def hashes(data: np.ndarray, size: int, other: int = 0) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes from each position on; ``other`` (0 to 255) picks another function."""
    h, have, out, covered = _BYTES[data ^ np.uint8(other)], 1, None, 0
    while True:
        if size & have:  # put together from the powers of two that make up size
            if out is None:
                out, covered = h, have
            else:
                n = len(data) - covered - have + 1
                out = _join(out[:n], h[covered : covered + n], covered)
                covered += have
        if 2 * have > size:
            return out
        h = _join(h[:-have], h[have:], have)
        have *= 2


def _join(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    out = (left ^ (left >> np.uint64(31))) * (_MIX + np.uint64(2 * size))
    out += right
    return out


def core_size(length: int) -> int:
    """Bytes of the strings that anchors are chosen by."""
    return max(1, length * 8 // 25)


def anchors(data: np.ndarray, stops: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Anchors of texts that lie one after the other in ``data`` and end at ``stops``.

    Returns text number, position in ``data``, least and largest distance back to a window it serves, core hash.
    """
    n = len(data) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    core = hashes(data, core_size(length))
    least = ((core ^ (core >> np.uint64(29))) * _MIX) & ~_PLACE
    least |= np.arange(len(least), dtype=np.uint64)
    have, width = 1, length - core_size(length) + 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    least = np.minimum(least[:n], least[width - have : width - have + n])
    at = (least & _PLACE).astype(np.int64)
    begins = np.concatenate([[0], stops[:-1]])
    counts = np.maximum(0, stops - begins - length + 1)
    text = np.repeat(np.arange(len(stops)), counts)
    window = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + begins[text]
    at = at[window]
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])])) if len(at) else np.zeros(0, np.int64)
    last = np.concatenate([first[1:], [len(at)]])[: len(first)] - 1
    place = at[first]
    return text[first], place, place - window[last], place - window[first], core[place]


def sample_text(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Anchors of one text of any length: position, least and largest distance, core hash."""
    whole, parts = np.frombuffer(data, np.uint8), []
    for start in range(0, max(1, len(whole) - length + 1), PIECE):
        piece = whole[start : start + PIECE + length - 1]
        _, place, lo, hi, core = anchors(piece, np.array([len(piece)]), length)
        place = place + start
        if parts and len(place) and len(parts[-1][0]) and parts[-1][0][-1] == place[0]:
            before = parts[-1]  # an anchor that serves windows of both pieces
            hi[0] = before[2][-1]
            parts[-1] = tuple(x[:-1] for x in before)
        parts.append((place, lo, hi, core))
    return tuple(np.concatenate(x) for x in zip(*parts))


def place(at: int, lo: int, hi: int) -> int:
    """An anchor's position and distances in one integer."""
    return at << 20 | lo << 10 | hi


def unplace(value: int) -> tuple[int, int, int]:
    return value >> 20, value >> 10 & 1023, value & 1023


def sampled(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``key, core, places`` (of :func:`place`) of each core of each row ``key, data`` with ``length`` bytes or more.

    A text that repeats itself names a core many times; that is still one row.
    """
    schema = pa.schema([("key", pa.binary()), ("core", pa.int64()), ("places", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "data", PIECE):
                data = part.column("data").to_pylist()
                if len(data) == 1:
                    at, lo, hi, core = sample_text(data[0], length)
                    text = np.zeros(len(at), np.int64)
                else:
                    stops = np.cumsum([len(x) for x in data])
                    text, at, lo, hi, core = anchors(np.frombuffer(b"".join(data), np.uint8), stops, length)
                    at = at - np.concatenate([[0], stops[:-1]])[text]
                order = np.lexsort((core, text))  # stable: positions stay in order
                text, core = text[order], core[order]
                first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (core[1:] != core[:-1])]))
                places = (at << 20 | lo << 10 | hi)[order]
                offsets = pa.array(np.append(first, len(text)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    part.column("key").take(pa.array(text[first])), pa.array(core[first].view(np.int64)),
                    pa.ListArray.from_arrays(offsets, pa.array(places)),
                ], schema=schema)

    return texts.mapInArrow(run, "key binary, core long, places array<long>")


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be ``start`` at least."""
    n, step = min(len(a), len(b)), 16
    while start < n and a[start : start + step] == b[start : start + step] and start + step <= n:
        start += step
        step *= 2
    while step:
        if start + step <= n and a[start : start + step] == b[start : start + step]:
            start += step
        step //= 2
    return start


def front_code(entries: list[tuple]) -> tuple[list[int], list[bytes], list]:
    """Shared prefix lengths, tails and payloads of sorted ``(string, payload)``."""
    shared, tails, before = [], [], b""
    for string, _ in entries:
        n = common(before, string)
        shared.append(n)
        tails.append(string[n:])
        before = string
    return shared, tails, [payload for _, payload in entries]


def front_decode(run: tuple) -> Iterator[tuple[int, bytes, object]]:
    before = b""
    for n, tail, payload in zip(*run):
        before = before[:n] + tail
        yield n, before, payload


def merge(runs: list[Iterator[tuple[int, bytes, object]]]) -> Iterator[tuple[int, bytes, object]]:
    """Merge sorted front-decoded runs; yields common prefix with the last output, string, payload."""
    k = 1
    while k < len(runs):
        k *= 2
    runs = [*runs, *[iter(()) for _ in range(k - len(runs))]]
    ended = (-1, b"", None)
    heads = [next(r, ended) for r in runs]
    shared, strings = [h[0] for h in heads], [h[1] for h in heads]  # prefix shared with the last output
    loser = [0] * k

    def contest(i: int, j: int) -> tuple[int, int]:
        p, q = shared[i], shared[j]
        if p != q:
            return (i, j) if p > q else (j, i)
        if p < 0:
            return i, j
        s, t = strings[i], strings[j]
        n = common(s, t, p)
        if n == len(s) or n < len(t) and s[n] < t[n]:
            shared[j] = n
            return i, j
        shared[i] = n
        return j, i

    def play(node: int) -> int:
        if node >= k:
            return node - k
        winner, loser[node] = contest(play(2 * node), play(2 * node + 1))
        return winner

    winner = play(1)
    while shared[winner] >= 0:
        yield shared[winner], strings[winner], heads[winner][2]
        heads[winner] = head = next(runs[winner], ended)
        shared[winner], strings[winner] = head[0], head[1]
        node = (winner + k) // 2
        while node:
            winner, loser[node] = contest(winner, loser[node])
            node //= 2


def repeated_windows(group: list[tuple[bytes, bytes, int, int]], shared: list[int], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each distinct member the ranges of distances (windows start so far before the anchor) that are repeated.

    ``group``: suffix, reversed bytes before the anchor, sorted by suffix; ``shared[i]``: common prefix
    of suffixes i - 1 and i.
    """
    found: list[list[tuple[int, int]]] = [[] for _ in group]
    todo = [(list(range(len(group))), shared, 0)]
    while todo:
        members, shared, depth = todo.pop()
        lefts = [group[i][1] for i in members]
        reach = max(map(len, lefts))
        if max(shared[1:]) + reach < length:
            continue
        deep = common(min(lefts), max(lefts), depth)  # all agree so far to the left
        for t, i in enumerate(members):
            best = max(shared[t] if t else 0, shared[t + 1] if t + 1 < len(members) else 0)
            start = max(depth, length - best)
            if start <= deep:
                found[i].append((start, deep))
        classes: dict[int, tuple[list[int], list[int], list[int]]] = {}
        low = [length] * 256
        for t, i in enumerate(members):
            if t:
                for key in classes:
                    if shared[t] < low[key]:
                        low[key] = shared[t]
            if len(lefts[t]) > deep:
                key = lefts[t][deep]
                into, between, _ = classes.setdefault(key, ([], [], []))
                between.append(low[key] if into else 0)
                into.append(i)
                low[key] = length
        todo.extend((into, between, deep + 1) for into, between, _ in classes.values() if len(into) > 1)
    return found


_ZSTD = "zstd"


def _pack(run: tuple) -> tuple[int, bytes]:
    raw = pickle.dumps(run, protocol=5)
    return len(raw), pa.Codec(_ZSTD).compress(raw, asbytes=True)


def _unpack(size: int, data: bytes) -> tuple:
    return pickle.loads(pa.Codec(_ZSTD).decompress(data, decompressed_size=size, asbytes=True))


_RUN = "bucket long, size long, run binary"
_RUN_SCHEMA = pa.schema([("bucket", pa.int64()), ("size", pa.int64()), ("run", pa.binary())])


def _emit(held: dict[int, dict]) -> Iterator[pa.RecordBatch]:
    """One front-coded run per bucket; ``held``: bucket to string and payload."""
    rows = [(bucket, *_pack(front_code(sorted(entries.items())))) for bucket, entries in held.items()]
    for i in range(0, len(rows), 64):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i : i + 64]), _RUN_SCHEMA)], schema=_RUN_SCHEMA)


def _texts(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows, a few at a time: the lists that belong to a text are longer than the text."""
    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            yield from zip(*(batch.column(n).slice(i, 64).to_pylist() for n in names))


def suffix_runs(work: DataFrame, buckets: int, length: int = LENGTH) -> DataFrame:
    """Sorted front-coded runs of the suffixes of ``work`` (``key, data, found``: cores with their places).

    A run holds each suffix once, with what stands before it and where: ``{(before, lo, hi): [(key, at), ...]}``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict] = {}
        size = 0
        for key, data, found in _texts(batches, "key", "data", "found"):
            for x in found:
                bucket = held.setdefault(x["core"] % buckets, {})
                for at, lo, hi in map(unplace, x["places"]):
                    suffix, before = data[at : at - lo + length], data[at - hi : at][::-1]
                    where = bucket.setdefault(suffix, {}).setdefault((before, lo, hi), [])
                    size += 60 if where else len(suffix) + len(before) + 300
                    where.append((key, at))
                if size > RUN_BYTES:
                    yield from _emit(held)
                    held, size = {}, 0
                    bucket = held.setdefault(x["core"] % buckets, {})
        yield from _emit(held)

    return work.select("key", "data", "found").mapInArrow(run, _RUN)


def merged_ranges(runs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``key, start, stop``: repeated byte ranges, from merging the runs of each bucket."""
    schema = pa.schema([("key", pa.binary()), ("start", pa.int32()), ("stop", pa.int32())])

    def ranges(group: list[tuple], shared: list[int]) -> Iterator[tuple[bytes, int, int]]:
        # Entries: (suffix, before, lo, hi, places); equal ones of several runs come together.
        once: dict[tuple, int] = {}
        members, between, places = [], [], []
        least = length
        for (suffix, before, lo, hi, where), n in zip(group, shared):
            least = min(least, n)
            known = once.get((suffix, before, lo, hi))
            if known is None:
                once[suffix, before, lo, hi] = len(members)
                members.append((suffix, before, lo, hi))
                between.append(least)
                places.append(list(where))
                least = length
            else:
                places[known].extend(where)
        found = repeated_windows(members, [0, *between[1:]], length) if len(members) > 1 else [[]]
        for (_, _, lo, hi), where, spans in zip(members, places, found):
            if len(where) > 1:
                spans = [(lo, hi)]
            for near, far in spans:
                for key, at in where:
                    yield key, at - far, at - near + length

    def run(table: pa.Table) -> pa.Table:
        runs = [front_decode(_unpack(n, d)) for n, d in zip(table.column("size").to_pylist(), table.column("run").to_pylist())]
        out, group, shared = [], [], []
        for n, suffix, entries in merge(runs):
            if n < core_size(length) and group:
                out.extend(ranges(group, shared))
                group, shared = [], []
            for (before, lo, hi), where in entries.items():
                group.append((suffix, before, lo, hi, where))
                shared.append(n)
                n = len(suffix)
        if group:
            out.extend(ranges(group, shared))
        columns = zip(*out) if out else ([], [], [])
        return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

    return runs.groupBy("bucket").applyInArrow(run, "key binary, start int, stop int")


def repeated_strings(units: DataFrame, data: DataFrame, buckets: int, scratch: str) -> tuple[DataFrame, DataFrame]:
    """Which byte ranges ``key, start, stop, h, g`` (``h, g``: hashes of the bytes) occur again as strings.

    Candidates by hash are cut out of ``data`` (``key, data``), each string once per run with its count up to
    two, and the merge counts the strings. Returns the repeated units and the others.
    """
    place = F.xxhash64("key", "start")
    more = units.groupBy("h", "g").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a < b").select("h", "g")
    more = materialise(more, f"{scratch}/twice")
    wanted = units.join(more, ["h", "g"]).groupBy("key").agg(F.collect_list(F.struct("start", "stop", "h", "g")).alias("found"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict] = {}
        size = 0
        for data, found in _texts(batches, "data", "found"):
            for x in found:
                entries = held.setdefault(x["h"] % buckets, {})
                string = data[x["start"] : x["stop"]]
                known = entries.get(string)
                if known is None:
                    size += len(string) + 300
                entries[string] = (x["h"], x["g"], 1 if known is None else 2)
            if size > RUN_BYTES:
                yield from _emit(held)
                held, size = {}, 0
        yield from _emit(held)

    runs = materialise(data.join(wanted, "key").select("data", "found").mapInArrow(cut, _RUN), f"{scratch}/runs")

    def verdict(table: pa.Table) -> pa.Table:
        runs = [front_decode(_unpack(n, d)) for n, d in zip(table.column("size").to_pylist(), table.column("run").to_pylist())]
        # 128 bits of hash name a string from here on; the strings themselves are counted.
        names, counts, last = [], [], None
        for n, string, (h, g, count) in merge(runs):
            if last is None or n < len(string) or len(string) != last:
                names.append((h, g))
                counts.append(0)
                last = len(string)
            counts[-1] += count
        rows = [name for name, count in zip(names, counts) if count > 1]
        return pa.table({"h": pa.array([h for h, _ in rows], pa.int64()), "g": pa.array([g for _, g in rows], pa.int64())})

    sure = materialise(runs.groupBy("bucket").applyInArrow(verdict, "h long, g long"), f"{scratch}/sure")
    return units.join(sure, ["h", "g"]), units.join(sure, ["h", "g"], "left_anti")


_UNIT = "key binary, start int, stop int, h long, g long, at int, lo int, hi int"


def hot_ranges(hot: DataFrame, buckets: int, scratch: str, length: int = LENGTH) -> DataFrame:
    """``key, start, stop`` of the repeated ranges that anchors with hot cores serve.

    ``hot``: ``key, data, found`` like :func:`suffix_runs`. First the whole range that an anchor serves
    is taken as one string: where it occurs again, all of it is repeated. The windows of the other anchors,
    and of one anchor for each repeated string, are then strings of their own.
    """
    names = [x.split()[0] for x in _UNIT.split(", ")]
    schema = pa.schema([(n, pa.binary() if n == "key" else pa.int64() if n in "hg" else pa.int32()) for n in names])

    def of_anchors(key: bytes, data: np.ndarray, at: int, lo: int, hi: int) -> list[list]:
        start, stop = at - hi, at - lo + length
        h, g = (int(hashes(data[start:stop], stop - start, other).view(np.int64)[0]) for other in (0, 0x5A))
        return [[x] for x in (key, start, stop, h, g, at, lo, hi)]

    def of_windows(key: bytes, data: np.ndarray, at: int, lo: int, hi: int) -> list:
        start, stop = at - hi, at - lo + length
        h, g = (hashes(data[start:stop], length, other).view(np.int64) for other in (0, 0x5A))
        starts = np.arange(start, start + len(h), dtype=np.int32)
        n = len(h)
        return [[key] * n, starts, starts + length, h, g, [at] * n, [lo] * n, [hi] * n]

    def listed(frame: DataFrame, unit) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            columns: list[list] = [[] for _ in names]
            for key, data, places in _texts(batches, "key", "data", "places"):
                whole = np.frombuffer(data, np.uint8)
                for value in places:
                    for column, values in zip(columns, unit(key, whole, *unplace(value))):
                        column.extend(values)
                    if len(columns[0]) > 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
                        columns = [[] for _ in names]
            if columns[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        return frame.mapInArrow(run, _UNIT)

    texts = hot.select("key", "data")
    places = hot.select("key", "data", F.flatten(F.transform("found", lambda x: x["places"])).alias("places"))
    whole = materialise(listed(places, of_anchors), f"{scratch}/anchors")
    again, single = repeated_strings(whole, texts, buckets, f"{scratch}/whole")
    again = materialise(again, f"{scratch}/again")
    one = again.groupBy("h", "g").agg(F.min(F.struct("key", "at", "lo", "hi")).alias("x")).select("x.*")
    left = single.select("key", "at", "lo", "hi").unionByName(one)
    left = left.groupBy("key").agg(F.collect_list(
        F.shiftleft(F.col("at").cast("long"), 20).bitwiseOR(F.shiftleft(F.col("lo").cast("long"), 10)).bitwiseOR(F.col("hi").cast("long"))
    ).alias("places"))
    windows = materialise(listed(texts.join(left, "key").select("key", "data", "places"), of_windows), f"{scratch}/windows")
    more, _ = repeated_strings(windows, texts, buckets, f"{scratch}/each")
    return again.select("key", "start", "stop").unionByName(more.select("key", "start", "stop"))


def text_key(data: Column) -> Column:
    """Half of the SHA-256 of a text: what stands for it in exchanges."""
    return F.unhex(F.substring(F.sha2(data, 256), 1, 32))


def repeated_spans(texts: DataFrame, scratch: str, hot: int = HOT, *, length: int = LENGTH) -> DataFrame:
    """``key, data, spans`` of the distinct texts with repeated ranges other than by copies of the whole text.

    ``texts``: ``key`` (:func:`text_key`), ``data`` (binary), any number of rows per text. ``spans``:
    disjoint ``start, stop`` in order.
    """
    spark = texts.sparkSession
    long = texts.where(F.octet_length("data") >= length)
    flat = materialise(sampled(long, length), f"{scratch}/samples")
    ends = [F.xxhash64("key", F.shiftright(F.col("places")[0], 20)), F.xxhash64("key", F.shiftright(F.element_at("places", -1), 20))]
    # Written before the join, so that both its sides come from exchanges and a hot core is split.
    shared = materialise(
        flat.select("core", "places", F.least(*ends).alias("p"), F.greatest(*ends).alias("q")).groupBy("core")
        .agg(F.min("p").alias("a"), F.max("q").alias("b"), F.sum(F.size("places")).alias("n")).where("a < b")
        .select("core", (F.col("n") >= hot).alias("hot")),
        f"{scratch}/shared",
    )
    # Copies of a text name the same anchors: the set holds each once.
    found = materialise(
        flat.join(shared, "core").groupBy("key").agg(F.collect_set(F.struct("core", "places", "hot")).alias("x")),
        f"{scratch}/found",
    )
    release(spark)
    once = long.groupBy("key").agg(F.first("data").alias("data"))
    work = materialise(once.join(found, "key"), f"{scratch}/work")
    release(spark)
    cold = work.withColumn("found", F.filter("x", lambda x: ~x["hot"])).where("size(found) > 0")
    many = work.withColumn("found", F.filter("x", lambda x: x["hot"])).where("size(found) > 0")
    suffixes, hot_texts = work.select(
        F.sum(F.aggregate("x", F.lit(0).cast("long"), lambda n, x: n + F.size(x["places"]))), F.sum(F.exists("x", lambda x: x["hot"]).cast("int"))
    ).first()
    buckets = max(1, -(-(suffixes or 0) // PER_BUCKET))
    runs = materialise(suffix_runs(cold, buckets, length), f"{scratch}/runs")
    ranges = merged_ranges(runs, length)
    if hot_texts:
        ranges = ranges.unionByName(hot_ranges(many.select("key", "data", "found"), buckets, scratch, length))
    ranges = materialise(ranges, f"{scratch}/ranges")
    release(spark)
    spans = ranges.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("r"))
    joined = F.aggregate(
        "r", F.array().cast("array<struct<start:int,stop:int>>"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["stop"] >= x["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(
                    F.element_at(done, -1)["start"].alias("start"),
                    F.greatest(F.element_at(done, -1)["stop"], x["stop"]).alias("stop"),
                )),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    return work.select("key", "data").join(spans, "key").select("key", "data", joined.alias("spans"))


def cut(data: Column, spans: Column) -> Column:
    """``data`` without ``spans``."""

    @F.pandas_udf("binary")
    def apply(data: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for whole, gone in zip(data, spans):
            parts, at = [], 0
            for x in gone:
                parts.append(whole[at : x["start"]])
                at = x["stop"]
            out.append(b"".join([*parts, whole[at:]]))
        return pd.Series(out, dtype=object)

    return apply(data, spans)


def readable(data: Column) -> Column:
    """Text of bytes that were cut at any place: what is left of a split character is dropped."""

    @F.pandas_udf("string")
    def decode(values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else bytes(v).decode("utf-8", "ignore") for v in values], dtype=object)

    return decode(data)


def removals(docs: DataFrame, scratch: str, text: str = "text", length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """The columns of ``docs`` as struct ``row`` with ``key`` and ``data``, and per key what goes.

    The second frame has ``key, whole`` (the text is a copy: all goes), ``n_removed, n_spans, kept``.
    """
    rows = docs.select(F.struct("*").alias("row")).withColumn(
        "data", F.coalesce(F.col("row")[text].cast("binary"), F.lit(b""))
    ).withColumn("key", text_key(F.col("data")))
    copies = materialise(
        rows.where(F.octet_length("data") >= length).groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.lit(True).alias("whole")),
        f"{scratch}/copies",
    )
    spans = repeated_spans(rows.select("key", "data"), scratch, length=length)
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + (x["stop"] - x["start"]))
    partial = materialise(
        spans.select("key", size.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), cut(F.col("data"), F.col("spans")).alias("kept")),
        f"{scratch}/partial",
    )
    release(docs.sparkSession)
    return rows, partial.join(copies, "key", "full")
