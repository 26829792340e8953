"""String predicates that treat whitespace the way the item rules do."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of text that a Python function handles at once; a longer text is handled alone.
SLICE_BYTES = 2 << 20

# Unicode white space plus the four ASCII separators U+001C..U+001F.
_SPACE = r"[\s\x1c-\x1f]"


def is_blank(col: Column) -> Column:
    """True for text made only of Unicode white space (``trim`` knows only U+0020)."""
    return ~col.rlike(r"(?s)(?U)[^\s\x1c-\x1f]")


def strip(col: Column) -> Column:
    """Drop Unicode white space from both ends."""
    return F.regexp_replace(col, rf"(?U)\A{_SPACE}+|(?<!{_SPACE}){_SPACE}+\z", "")


def text_slices(texts: pa.Array, limit: int | None = None) -> Iterator[pa.Array]:
    """Zero-copy slices of ``texts`` with at most ``limit`` (``SLICE_BYTES``) bytes each, at least one text; an empty array is one slice."""
    limit = SLICE_BYTES if limit is None else limit
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts) or not len(texts):
        held = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, held + limit, side="right")))
        yield texts.slice(start, stop - start)
        if stop >= len(texts):
            return
        start = stop
