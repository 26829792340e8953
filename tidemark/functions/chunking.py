"""Splitting answers into overlapping chunks."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import is_blank, strip, text_slices
from tidemark.options import check_chunking

# Separators from coarse to fine; the empty one is every character.
SEPARATORS = ("\n\n", "\n", " ", "")


def _windows(text: str, size: int, overlap: int, lo: int, hi: int, level: int):
    """Yield ``(start, end)`` of the chunks of ``text[lo:hi]``.

    Pieces are contiguous and keep their separator at the head, so a chunk is
    always one slice of the text and only positions need to be tracked.
    """
    while level < len(SEPARATORS) - 1 and text.find(SEPARATORS[level], lo, hi) < 0:
        level += 1
    separator = SEPARATORS[level]
    if not separator:
        start = lo
        while hi - start > size:
            yield start, start + size
            start += size - overlap
        yield start, hi
        return

    cuts, at = [lo], text.find(separator, lo, hi)
    while at >= 0:
        if at > cuts[-1]:
            cuts.append(at)
        at = text.find(separator, at + len(separator), hi)
    cuts.append(hi)

    run = 0  # first cut of the current run of pieces that are short enough
    for i in range(len(cuts) - 1):
        if cuts[i + 1] - cuts[i] >= size:
            yield from _pack(cuts, run, i, size, overlap)
            yield from _windows(text, size, overlap, cuts[i], cuts[i + 1], level + 1)
            run = i + 1
    yield from _pack(cuts, run, len(cuts) - 1, size, overlap)


def _pack(cuts: list[int], first: int, last: int, size: int, overlap: int):
    """Greedily join the pieces between ``cuts[first]`` and ``cuts[last]``."""
    start = first
    while start < last:
        end = bisect_right(cuts, cuts[start] + size, start + 1, last + 1) - 1
        yield cuts[start], cuts[end]
        if end == last:
            return
        # Carry over as much of the tail as the overlap allows while the next piece still fits.
        floor = max(cuts[end] - overlap, cuts[end + 1] - size)
        start = bisect_left(cuts, floor, start, end)


def split_text(text: str | None, size: int, overlap: int) -> list[str]:
    """Chunks of at most ``size`` code points, stripped, without blank ones."""
    if not text:
        return []
    slices = (text[a:b].strip() for a, b in _windows(text, size, overlap, 0, len(text), 0))
    return [chunk for chunk in slices if chunk]


def chunk_column(text: Column, size: int = 1000, overlap: int = 150) -> Column:
    """Array of chunks per text; blank or null text gives an empty array.

    Text that already fits never leaves the JVM: the Python splitter sees null
    for it, because a conditional alone would not keep rows away from a UDF.
    """
    check_chunking(size, overlap)

    list_type = pa.list_(pa.field("element", pa.string()))

    @F.arrow_udf("array<string>")
    def split_long(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # By slices of a batch, as its texts and their chunks would all be held at once.
        for batch in batches:
            for texts in text_slices(batch):
                yield pa.array([None if t is None else split_text(t, size, overlap) for t in texts.to_pylist()], list_type)

    long_text = F.when(F.length(text) > size, text)
    short = F.when(text.isNull() | is_blank(text), F.array().cast("array<string>")).otherwise(
        F.array(strip(text))
    )
    return F.when(F.length(text) > size, split_long(long_text)).otherwise(short)


def chunk(df: DataFrame, col: str, size: int = 1000, overlap: int = 150, out: str = "chunks") -> DataFrame:
    """Add the chunk array of ``col`` as ``out``."""
    return df.withColumn(out, chunk_column(F.col(col), size, overlap))


def fixed_windows(text: Column, size: int, overlap: int) -> Column:
    """Sliding windows of ``size`` code points, ``size - overlap`` apart.

    The text is cut once into blocks of one step, and each window is put
    together from the few blocks it covers, so the cost stays linear in the
    length of the text.
    """
    check_chunking(size, overlap)
    step = size - overlap
    span = -(-size // step)
    count = F.greatest(F.lit(1), F.ceil((F.length(text) - overlap) / F.lit(step))).cast("int")

    def windows(blocks: Column) -> Column:
        return F.transform(
            F.slice(blocks, 1, count),
            lambda _, i: F.substring(F.array_join(F.slice(blocks, i + 1, span), ""), 1, size),
        )

    # Bound by a one-element transform: named twice in a lambda, the regular
    # expression would run again for every window.
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    return F.element_at(F.transform(F.array(blocks), windows), 1)


def explode_chunks(df: DataFrame, chunks: str = "chunks", number: str = "chunk_no", out: str = "chunk") -> DataFrame:
    """One row per chunk with its zero-based position.

    The plain explode would make Spark infer a filter on the array and push it
    below, which runs the splitter twice; the outer one does not.
    """
    others = [c for c in df.columns if c != chunks]
    return df.select(*others, F.posexplode_outer(chunks).alias(number, out)).where(F.col(number).isNotNull())
