"""Text to vector, through a model the caller supplies."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import text_slices
from tidemark.options import check_positive

Encoder = Callable[[list[str]], Any]

# Characters of an error that are kept.
ERROR_CHARS = 500


def hashing_encoder(dim: int) -> Callable[[], Encoder]:
    """Factory of a deterministic bag-of-words encoder, the stand-in for a model.

    Every token (white-space separated) adds +1 or -1 to one of ``dim`` buckets,
    both taken from the MD5 of the token; the sums are scaled to unit length.
    """
    check_positive("dim", dim)

    def bucket_and_sign(token: str) -> tuple[int, int]:
        digest = hashlib.md5(token.encode("utf-8"), usedforsecurity=False).hexdigest()
        return int(digest[:8], 16) % dim, 1 if int(digest[8], 16) % 2 == 0 else -1

    def build() -> Encoder:
        # Tokens repeat a lot; the cache lives as long as the task.
        lookup = lru_cache(maxsize=1 << 16)(bucket_and_sign)
        return lambda texts: _sum_buckets(texts, lookup, dim)

    return build


def _sum_buckets(texts: list[str], lookup: Callable[[str], tuple[int, int]], dim: int) -> np.ndarray:
    words = pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))
    counts = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    coded = words.flatten().dictionary_encode()
    known = [lookup(t) if t else (0, 0) for t in coded.dictionary.to_pylist()]
    table = np.array(known, dtype=np.int64).reshape(-1, 2)[coded.indices.to_numpy(zero_copy_only=False)]
    rows = np.repeat(np.arange(len(texts)), counts)
    sums = np.bincount(
        rows * dim + table[:, 0], weights=table[:, 1], minlength=len(texts) * dim
    ).reshape(len(texts), dim)
    norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
    return np.divide(sums, norm, out=np.zeros_like(sums), where=norm > 0).astype(np.float32)


def batches_by_length(texts: list[str], batch_size: int, batch_chars: int | None = None) -> Iterator[list[int]]:
    """Positions of ``texts`` in batches of like length, since a model pads a batch to its longest text.

    A batch has at most ``batch_size`` texts and, all as long as its longest, ``batch_chars`` characters; a longer
    text is a batch of its own.
    """
    batch: list[int] = []
    for i in sorted(range(len(texts)), key=lambda i: len(texts[i])):
        full = batch_chars is not None and (len(batch) + 1) * len(texts[i]) > batch_chars
        if batch and (full or len(batch) == batch_size):
            yield batch
            batch = []
        batch.append(i)
    if batch:
        yield batch


def _matrix(encoder: Encoder, part: list[str], dim: int) -> np.ndarray:
    matrix = np.asarray(encoder(part), dtype=np.float32)
    if matrix.shape != (len(part), dim):
        raise ValueError(f"encoder returned shape {matrix.shape} for {len(part)} texts of dimension {dim}")
    return matrix


def _isolated(encoder: Encoder, part: list[str], dim: int) -> Iterator[tuple[np.ndarray | None, str | None]]:
    """Vector or error of each text: a batch that fails is halved down to the texts that fail alone."""
    try:
        yield from ((v, None) for v in _matrix(encoder, part, dim))
    except Exception as failure:
        if len(part) == 1:
            yield None, f"{type(failure).__name__}: {failure}"[:ERROR_CHARS]
            return
        half = len(part) // 2
        yield from _isolated(encoder, part[:half], dim)
        yield from _isolated(encoder, part[half:], dim)


def encode_column(
    text: Column, factory: Callable[[], Encoder], dim: int, batch_size: int = 64, batch_chars: int | None = None,
    isolate: bool = False,
) -> Column:
    """``array<float>`` of length ``dim`` per text; any mismatch fails the job.

    With ``isolate`` a struct of ``vector`` and ``error`` instead: a text that the encoder fails on has
    an error and no vector, and the others of its batch keep theirs.
    """
    check_positive("dim", dim)
    check_positive("batch_size", batch_size)

    vector_type = pa.list_(pa.field("element", pa.float32()))

    def run(encoder: Encoder, texts: list[str | None]) -> list[tuple[np.ndarray | None, str | None]]:
        # A null text has no vector; the encoder doesn't see it.
        places = [i for i, t in enumerate(texts) if t is not None]
        values = [texts[i] for i in places]
        found: list[tuple[np.ndarray | None, str | None]] = [(None, None)] * len(texts)
        for batch in batches_by_length(values, batch_size, batch_chars):
            part = [values[i] for i in batch]
            rows = _isolated(encoder, part, dim) if isolate else ((v, None) for v in _matrix(encoder, part, dim))
            for i, row in zip(batch, rows):
                found[places[i]] = row
        return found

    # Slices of a batch: 10,000 rows of long texts, as Python strings and with what is made of them, are too much at once.
    if isolate:

        @F.arrow_udf("vector array<float>, error string")
        def encode_apart(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder = factory()
            for batch in batches:
                for texts in text_slices(batch):
                    found = run(encoder, texts.to_pylist())
                    yield pa.StructArray.from_arrays(
                        [pa.array([v for v, _ in found], vector_type, from_pandas=True), pa.array([e for _, e in found], pa.string())],
                        names=["vector", "error"],
                    )

        return encode_apart(text)

    @F.arrow_udf("array<float>")
    def encode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = factory()
        for batch in batches:
            for texts in text_slices(batch):
                yield pa.array([v for v, _ in run(encoder, texts.to_pylist())], vector_type, from_pandas=True)

    return encode_batches(text)


def encode(
    df: DataFrame, col: str, factory: Callable[[], Encoder] | None = None, dim: int = 384,
    batch_size: int = 64, out: str = "vector", batch_chars: int | None = None,
) -> DataFrame:
    """Add the vector of ``col`` as ``out``. Filter first: every row of ``df`` is encoded."""
    return df.withColumn(out, encode_column(F.col(col), factory or hashing_encoder(dim), dim, batch_size, batch_chars))


def encode_apart(
    df: DataFrame, col: str, factory: Callable[[], Encoder] | None = None, dim: int = 384,
    batch_size: int = 64, out: str = "vector", error: str = "error", batch_chars: int | None = None,
) -> DataFrame:
    """:func:`encode` that goes on after failures: rows the encoder fails on have no vector and an ``error``."""
    found = encode_column(F.col(col), factory or hashing_encoder(dim), dim, batch_size, batch_chars, isolate=True)
    # One column, so that Spark does not run the encoder once for each of the two below.
    both = df.withColumn("_encoded", found)
    return both.select(*df.columns, F.col("_encoded.vector").alias(out), F.col("_encoded.error").alias(error))


def vector_fault(v: Column, dim: int) -> Column:
    """Whether a vector is missing, has the wrong length or holds a null."""
    wrong = F.coalesce(F.size(v) != dim, F.lit(True)) | F.coalesce(F.exists(v, lambda x: x.isNull()), F.lit(True))
    return v.isNull() | wrong


def vector_faults(df: DataFrame, vector: str, dim: int) -> DataFrame:
    """Rows whose vector is missing, has the wrong length or holds a null."""
    return df.where(vector_fault(F.col(vector), dim))
