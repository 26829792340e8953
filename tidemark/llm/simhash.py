"""SimHash near-duplicates by pigeonhole blocks.

The fingerprint of a text has 64 bits: each is set if more than half of its word shingles
(repeats included) hash to a value with that bit. Fingerprints link if at most ``distance`` bits
differ.

Equal fingerprints are one node, so a group of copies costs one row. The 64 bits are cut into
``distance + extra`` blocks; two linked fingerprints differ in at most ``distance`` of them, so
they agree on some choice of ``extra`` blocks. Nodes are joined on each such choice, the Hamming
distance verifies every pair, and links become components by alternating large and small stars.

A block key shared by more than ``bucket`` nodes is not paired up. Its nodes are joined through
the values within one bit of them (65 keys a node): two fingerprints are within two bits exactly
if they share such a value, and at most 65 distinct fingerprints surround one value. This finds
every link of such a bucket with rows in proportion to its nodes.

Defined cases: null and empty texts have fingerprint zero and link like any other; fewer words
than a shingle form one shingle; a null id is ignored by the smallest id of a component, which
is null only if all its ids are; repeated rows stay rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialise, release, row_slices

SEED = 42
#: Largest number of nodes that are paired up within one block key.
BUCKET = 24
#: Bytes of a text cut into words at once.
SEGMENT = 4 << 20


def fingerprint(text: str | None, words: int = 3) -> int:
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    ones, total, carried, at = np.zeros(64, np.int64), 0, [], 0
    digest = xxhash.xxh64_intdigest
    while at < len(data):
        stop = min(len(data), at + SEGMENT)
        while stop < len(data) and data[stop] not in b" \t\n\r\x0b\x0c":
            stop += 1
        part = carried + data[at:stop].split()
        at = stop
        if len(part) < words and at < len(data):
            carried = part
            continue
        if not part:
            break
        joined = b" ".join(part)
        ends = list(accumulate(map(len, part), lambda a, n: a + 1 + n))
        starts = [0, *[e + 1 for e in ends[:-1]]]
        if len(part) >= words:
            hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :])]
        elif total == 0:
            hashes = [digest(joined, SEED)]
        else:
            break  # only the words that earlier shingles already cover are left
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8)).reshape(-1, 64)
        for k in range(0, len(bits), 255):
            ones += bits[k : k + 255].sum(axis=0, dtype=np.uint8)
        total += len(hashes)
        carried = part[len(part) - words + 1 :] if words > 1 else []
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big") if total else 0


def fingerprint_column(text: Column, words: int = 3) -> Column:
    """The fingerprint as a signed long."""

    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = np.fromiter((fingerprint(t, words) for t in texts), np.uint64, len(texts))
            yield pd.Series(values.view(np.int64))

    return prints(text)


def hex_column(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def block_masks(distance: int, extra: int) -> list[int]:
    """One mask for each choice of ``extra`` blocks out of ``distance + extra``."""
    n = distance + extra
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(blocks, extra)]


def links(nodes: DataFrame, scratch: str, distance: int = 2, extra: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints that connect all within ``distance`` bits; ``nodes``: ``fp``."""
    if not 0 < distance <= 2:
        raise ValueError("distance must be 1 or 2")
    keys = F.array(*[
        F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for i, m in enumerate(block_masks(distance, extra))
    ])
    keyed = materialise(
        nodes.select("fp", F.explode(keys).alias("k")).select("fp", "k.choice", "k.key"), f"{scratch}/keyed"
    )
    sizes = materialise(keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1"), f"{scratch}/sizes")
    small = keyed.join(sizes.where(F.col("n") <= bucket), ["choice", "key"], "left_semi")
    pairs = (
        small.select("choice", "key", F.col("fp").alias("a"))
        .join(small.select("choice", "key", F.col("fp").alias("b")), ["choice", "key"])
        .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
        .select("a", "b")
    )
    crowded = keyed.join(sizes.where(F.col("n") > bucket), ["choice", "key"], "left_semi").select("fp").distinct()
    near = [F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)]]
    around = crowded.select("fp", F.explode(F.array(*near)).alias("value"))
    hubs = around.groupBy("value").agg(F.min("fp").alias("a"), F.max("fp").alias("top")).where("a < top").drop("top")
    through = (
        around.join(hubs, "value").where("a < fp").select("a", F.col("fp").alias("b"))
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    )
    return materialise(pairs.unionByName(through).distinct(), f"{scratch}/links")


def _tally(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, scratch: str) -> DataFrame:
    """``node``, ``root`` (smallest node reachable) of every node in ``edges`` (``a < b``), by alternating stars."""
    state, seen, i = edges.select("a", "b"), None, 0
    while True:
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        large = materialise(large, f"{scratch}/large{i}")
        # Each larger node keeps one smallest neighbour; its others are linked to that one.
        lower = large.groupBy("b").agg(F.min("a").alias("m"))
        moved = large.join(lower, "b").select(F.col("m").alias("a"), F.col("a").alias("b")).where("a < b")
        state = materialise(
            moved.unionByName(lower.select(F.col("m").alias("a"), "b")).distinct(), f"{scratch}/small{i}"
        )
        tally = _tally(state)
        if tally == seen:
            return state.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                state.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        seen, i = tally, i + 1


def near_duplicates(
    prints: DataFrame, scratch: str, doc_id: str = "doc_id", fp: str = "fp", distance: int = 2,
    bucket: int = BUCKET,
) -> DataFrame:
    """``fp``, ``component_id`` (smallest id) and ``n`` rows of it, per distinct fingerprint of ``prints``."""
    nodes = materialise(
        prints.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("id"), F.count("*").alias("n")),
        f"{scratch}/nodes",
    )
    edges = links(nodes.select("fp"), scratch, distance, bucket=bucket)
    roots = components(edges, scratch).select(F.col("node").alias("fp"), "root")
    rooted = materialise(
        nodes.join(roots, "fp", "left").select("fp", "id", "n", F.coalesce("root", "fp").alias("root")),
        f"{scratch}/rooted",
    )
    smallest = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    found = materialise(rooted.join(smallest, "root").select("fp", "root", "component_id", "n"), f"{scratch}/found")
    release(prints.sparkSession)
    return found


# Near-duplicates by similarity of word shingles. Candidates come from prefixes: with the shingles of all texts in
# one order, two texts of that similarity share one of the first n - ceil(similarity * n) + 1 of either, n being the
# number of its distinct shingles. This holds in any order, so what is estimated below (which shingles
# are common and come last) bears on the number of candidates only. No pair is left out: groups are exact.

#: One text in so many tells which shingles are common: those in more than FREQUENT of these texts, COMMON at most.
SAMPLE, FREQUENT, COMMON = 4, 8, 1 << 20
#: Rounds in which the members of a crowded key meet one of them; those still in different groups are paired up then.
ROUNDS = 3
#: Allowance for rounding of bounds, on the side of more candidates.
EPSILON = 1e-6


def shingles(text: str | None, words: int = 5) -> set[int]:
    """Hashes of the distinct word shingles; fewer words are one shingle, none are none."""
    part = (text or "").encode("utf-8", "surrogatepass").lower().split()
    joined = b" ".join(part)
    ends = list(accumulate(map(len, part), lambda a, n: a + 1 + n))
    starts = [0, *[e + 1 for e in ends[:-1]]]
    if len(part) < words:
        return {xxhash.xxh64_intdigest(joined)} if part else set()
    return {xxhash.xxh64_intdigest(joined[a:b]) for a, b in zip(starts, ends[words - 1 :])}


def similarity_column(a: Column, b: Column, words: int = 5) -> Column:
    """Jaccard similarity of the shingles of two texts; two texts without words are equal."""

    @F.pandas_udf("double")
    def compare(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            out, last, known = [], None, set()
            for x, y in zip(left, right):
                if x != last:
                    last, known = x, shingles(x, words)
                other = shingles(y, words)
                either = len(known | other)
                out.append(len(known & other) / either if either else 1.0)
            yield pd.Series(out, dtype="float64")

    return compare(a, b)


def _hashes(text: str | None, words: int) -> np.ndarray:
    """Shingles as signed longs; texts without words share one."""
    found = shingles(text, words) or {0}
    return np.fromiter(found, np.uint64, len(found)).view(np.int64)


def common_shingles(rows: DataFrame, scratch: str, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of common shingles in order, and in how many texts of the sample each is."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "text"):
                found = [_hashes(t, words) for t in part.column("text").to_pylist()]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], names=["h"])

    some = rows.where(F.pmod(F.xxhash64("key"), F.lit(SAMPLE)) == 0).select("text")
    counts = materialise(
        some.mapInArrow(listed, "h long").groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > FREQUENT), f"{scratch}/common"
    )
    least, held = FREQUENT + 1, 0
    for r in sorted(counts.groupBy("n").agg(F.count("*").alias("m")).collect(), key=lambda r: -r.n):
        held += r.m
        if held > COMMON:
            least = r.n + 1
            break
    table = counts.where(F.col("n") >= least).orderBy("h").toArrow()
    return table.column("h").to_numpy(), table.column("n").to_numpy()


def prefix_column(text: Column, common, similarity: float, words: int) -> Column:
    """``n`` (distinct shingles) and ``keys`` (the prefix): rare shingles by hash, then common ones by count."""

    @F.pandas_udf("n int, keys array<long>")
    def prefixes(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known, counts = common.value
        for texts in batches:
            sizes, keys = [], []
            for t in texts:
                h = _hashes(t, words)
                often = np.zeros(len(h), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    often = np.where(known[at] == h, counts[at], 0)
                sizes.append(len(h))
                keys.append(h[np.lexsort((h, often))][: prefix_length(len(h), similarity)])
            yield pd.DataFrame({"n": np.array(sizes, np.int32), "keys": pd.Series(keys, dtype=object)})

    return prefixes(text)


def prefix_length(n: int, similarity: float) -> int:
    return n - max(1, math.ceil(similarity * n - EPSILON)) + 1


def _may_be_similar(a: str, b: str, similarity: float, shared: Column) -> Column:
    """Whether two sets of ``{a}n`` and ``{b}n`` shingles can be similar, if their prefixes share at most ``shared``.

    The set whose prefix ends first in the order can only match its other shingles beyond that.
    """
    rest = F.greatest(*[F.greatest(F.lit(1), F.ceil(F.col(f"{x}n") * similarity - EPSILON)) - 1 for x in (a, b)])
    sizes = F.col(f"{a}n") + F.col(f"{b}n")
    return (
        (F.least(f"{a}n", f"{b}n") >= F.greatest(f"{a}n", f"{b}n") * similarity - EPSILON)
        & (shared + rest >= sizes * (similarity / (1 + similarity)) - EPSILON)
    )


def similar_groups(
    rows: DataFrame, scratch: str, similarity: float = 0.8, words: int = 5, bucket: int = BUCKET
) -> DataFrame:
    """``key, id``: one row of each group of near-duplicates is to stay, that with this key and smallest id.

    ``rows``: ``key`` (equal for equal texts only), ``id``, ``text``. Groups are the components of links
    between texts with at least that similarity of their shingles.

    Texts of a key that more than ``bucket`` texts share meet one of them in each of ROUNDS rounds, which brings large groups together.
    Texts that share smaller keys are paired up where they are in different groups. What is left of the
    crowded keys is paired up last, which takes rows with the square of their number only where many texts share
    a rare part and yet are not similar.
    """
    spark = rows.sparkSession
    common = spark.sparkContext.broadcast(common_shingles(rows, scratch, words))
    prints = materialise(
        rows.select("key", "id", prefix_column(F.col("text"), common, similarity, words).alias("p")).select("key", "id", "p.*"),
        f"{scratch}/prints",
    )
    nodes = materialise(
        prints.groupBy("key").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("keys").alias("keys"))
        .withColumn("node", F.monotonically_increasing_id()),
        f"{scratch}/nodes",
    )
    discard(spark, f"{scratch}/prints")
    keyed = nodes.select("node", "n", F.explode("keys").alias("h"))
    sizes = materialise(keyed.groupBy("h").agg(F.count("*").alias("many")).where("many > 1"), f"{scratch}/sizes")
    met = materialise(keyed.join(sizes, "h"), f"{scratch}/met")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """Those pairs ``a, b`` whose shingles are similar enough; only the texts in question are exchanged."""
        pairs = materialise(pairs.select("a", "b").distinct(), f"{scratch}/{name}_pairs")
        asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "key"), "node")
        texts = rows.select("key", "text").join(asked, "key").groupBy("node").agg(F.first("text").alias("text"))
        texts = materialise(texts, f"{scratch}/{name}_texts")
        left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        both = pairs.join(left, "a").join(right, "b")
        close = similarity_column(F.col("text_a"), F.col("text_b"), words) >= similarity
        return materialise(both.where(close).select("a", "b"), f"{scratch}/{name}")

    def rooted(links: DataFrame, name: str) -> DataFrame:
        roots = components(links, f"{scratch}/{name}")
        return nodes.select("node").join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))

    shared = met.groupBy("node").agg(F.count("*").alias("shared"))
    crowded = materialise(met.where(F.col("many") > bucket).join(shared, "node").select("h", "node", "n", "shared"), f"{scratch}/crowded")
    may = _may_be_similar("a_", "b_", similarity, F.least("a_shared", "b_shared"))
    found = materialise(spark.createDataFrame([], "a long, b long"), f"{scratch}/none")

    def small_pairs(roots: DataFrame) -> DataFrame:
        # All keys that a pair shares are small here, or else its crowded ones bring it together.
        few = met.where(F.col("many") <= bucket)
        sides = [few.select("h", F.col("node").alias(s), F.col("n").alias(f"{s}_n")) for s in "ab"]
        pairs = sides[0].join(sides[1], "h").where("a < b").groupBy("a", "b").agg(
            F.first("a_n").alias("a_n"), F.first("b_n").alias("b_n"), F.count("*").alias("shared")
        ).where(_may_be_similar("a_", "b_", similarity, F.col("shared")))
        for s in "ab":
            pairs = pairs.join(roots.select(F.col("node").alias(s), F.col("root").alias(f"{s}_root")), s)
        return pairs.where("a_root <> b_root").select("a", "b")

    done = False  # no crowded key has members of different groups any more
    for i in range(ROUNDS + 1):
        last = i == ROUNDS
        if last:
            more = verified(small_pairs(rooted(found, "c")), "small")
            found = materialise(found.unionByName(more), f"{scratch}/linked")
        if done:
            continue
        members = crowded.join(rooted(found, f"c{i}"), "node")
        open_keys = members.groupBy("h").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("h")
        crowded = members = materialise(members.join(open_keys, "h", "left_semi"), f"{scratch}/open{i}")
        done = members.isEmpty()
        if done:
            continue
        sides = [members.select("h", *[F.col(c).alias(f"{s}_{c}") for c in ("node", "n", "shared", "root")]) for s in "ab"]
        if not last:  # by a hash of the round, so that the same text tends to stand for all keys of its group
            hub = F.min_by(F.struct(*[c for c in sides[0].columns if c != "h"]), F.xxhash64("a_node", F.lit(i)))
            sides[0] = sides[0].groupBy("h").agg(hub.alias("x")).select("h", "x.*")
        apart = sides[0].join(sides[1], "h").where((F.col("a_root") != F.col("b_root")) & may)
        pairs = apart.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b"))
        found = materialise(found.unionByName(verified(pairs, f"more{i}")).distinct(), f"{scratch}/similar{i}")
        crowded = crowded.drop("root")
    common.unpersist()
    grouped = nodes.select("node", "key", "id").join(rooted(found, "groups"), "node")
    smallest = grouped.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("kept")
    ).select(F.col("kept.node").alias("node"))
    return materialise(grouped.join(smallest, "node", "left_semi").select("key", "id"), f"{scratch}/kept")
