"""Cutting one JSON text of any size in several tasks.

A text is taken in pieces of bounded size. Whether a byte stands inside a string and how deep it is
nested depends on all bytes before, but a piece can be read without knowing them: for each of the four ways
in which it may begin (inside a string or not, behind a backslash or not) its effect is noted. Putting the effects together
in order, a few numbers per piece, gives the state that each piece begins in. With it every piece finds the
elements of the containers at a given depth by itself; elements that cross pieces are joined by their number.

For text that is no JSON the cuts mean nothing, and need not: it is accepted only if the frame that remains around the
elements and each element are strict JSON, and then the whole is.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import materialise

#: Bytes of a piece.
PIECE = 16 << 20

# What bytes are, by value: quotation mark, opening and closing bracket, comma.
_QUOTE, _OPEN, _CLOSE, _COMMA = 1, 2, 3, 4
_KIND = np.zeros(256, np.uint8)
_KIND[list(b'"')], _KIND[list(b"[{")], _KIND[list(b"]}")], _KIND[list(b",")] = _QUOTE, _OPEN, _CLOSE, _COMMA

PIECES = "source string, offset bigint, size bigint, data binary"
PARTS = "source string, container bigint, element bigint, offset bigint, whole boolean, data binary"


class State(NamedTuple):
    """Where a piece begins: inside a string, behind a backslash, how deep; containers and commas before it."""

    quoted: bool = False
    escaped: bool = False
    depth: int = 0
    opened: int = 0
    commas: int = 0


def _events(data: np.ndarray, escaped: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Places and kinds of brackets and commas, the parity of quotation marks before each and over all, and whether a backslash
    at the end escapes what follows."""
    at = np.flatnonzero(_KIND[data])
    kind = _KIND[data[at]]
    slash = np.flatnonzero(data == 0x5C)
    ends = False
    real = kind == _QUOTE
    if len(slash):
        first = np.concatenate([[True], np.diff(slash) != 1])
        start = slash[np.flatnonzero(first)][np.cumsum(first) - 1]
        odd = (slash - start + 1 + (escaped & (start == 0))) % 2 == 1
        behind = np.zeros(len(data) + 1, bool)
        behind[slash[odd] + 1] = True
        real &= ~behind[at]
        ends = bool(behind[len(data)])
    if escaped and len(at) and at[0] == 0:
        real[0] = False
    elif escaped and not len(data):
        ends = True
    before = np.cumsum(real) % 2
    other = kind != _QUOTE
    return at[other], kind[other], np.append(before[other], before[-1] if len(before) else 0), ends


def effect(data: np.ndarray) -> bytes:
    """What a piece does to each state it may begin in."""
    out = {}
    for escaped in (False, True):
        _, kind, parity, ends = _events(data, escaped)
        step = np.where(kind == _OPEN, 1, np.where(kind == _CLOSE, -1, 0))
        for quoted in (False, True):
            outside = parity[:-1] == int(quoted)
            level = np.cumsum(step[outside])
            own = kind[outside]
            tally = [dict(zip(*map(np.ndarray.tolist, np.unique(level[own == k], return_counts=True)))) for k in (_OPEN, _COMMA)]
            out[quoted, escaped] = (quoted ^ bool(parity[-1]), ends, int(level[-1]) if len(level) else 0, *tally)
    return pickle.dumps(out)


def after(state: State, effects: bytes, depth: int) -> State:
    """The state behind a piece; containers and commas are counted at ``depth``."""
    quoted, escaped, delta, opened, commas = pickle.loads(effects)[state.quoted, state.escaped]
    level = depth - state.depth
    return State(quoted, escaped, state.depth + delta, state.opened + opened.get(level, 0), state.commas + commas.get(level, 0))


def cut(data: np.ndarray, state: State, depth: int) -> Iterator[tuple[int, int, int, int, bool]]:
    """Parts of a piece: container, element, begin, end, whether the element is whole.

    Elements are numbered over all containers: a container's bracket and a comma at ``depth`` each begin one.
    The frame is container -1, its element the container that opens behind the part, or -1.
    """
    at, kind, parity, _ = _events(data, state.escaped)
    outside = parity[:-1] == int(state.quoted)
    at, kind = at[outside], kind[outside]
    level = state.depth + np.cumsum(np.where(kind == _OPEN, 1, np.where(kind == _CLOSE, -1, 0)))
    edges = ((kind != _CLOSE) & (level == depth)) | ((kind == _CLOSE) & (level == depth - 1))
    container, element = state.opened - 1, state.opened + state.commas - 1
    inside, begin, begun = state.depth >= depth, 0, False
    for place, what in zip(at[edges].tolist(), kind[edges].tolist()):
        if inside:
            yield container, element, begin, place, begun
            begin = place + (what == _COMMA)
        elif what == _OPEN:
            yield -1, container + 1, begin, place + 1, False
            begin = place + 1
        if what == _CLOSE:
            inside, begun = False, False
        else:
            container += what == _OPEN
            element += 1
            inside = begun = True
    yield (container, element, begin, len(data), False) if inside else (-1, -1, begin, len(data), False)


def _scan(group: pd.DataFrame, depth: int) -> pd.DataFrame:
    """The state that each piece of one text begins in."""
    state, rows = State(), []
    for row in group.sort_values("offset").itertuples():
        rows.append((row.source, row.offset, row.size, *state))
        state = after(state, row.effects, depth)
    return pd.DataFrame(rows, columns=["source", "offset", "size", *State._fields])


def parts_of(pieces: Callable[[DataFrame | None], DataFrame], scratch: str, depth: int) -> DataFrame:
    """Parts (PARTS) of texts given in pieces, written below ``scratch``.

    ``pieces(None)`` gives the PIECES; ``pieces(states)`` the same with the columns of ``states``, which are keyed by source and
    offset. ``element`` numbers the elements of the containers at ``depth``; what is not ``whole`` goes on in
    the next piece, and the frame is container -1.
    """
    effects_schema = "source string, offset bigint, size bigint, effects binary"

    def note(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [effect(np.frombuffer(x.as_buffer(), np.uint8)) for x in batch.column("data")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("source"), batch.column("offset"), batch.column("size"), pa.array(found, pa.binary())],
                names=["source", "offset", "size", "effects"],
            )

    effects = materialise(pieces(None).mapInArrow(note, effects_schema), f"{scratch}/effects")
    # A row per piece, without its bytes: a text of a terabyte has 65 thousand.
    kinds = "quoted boolean, escaped boolean, depth bigint, opened bigint, commas bigint"
    states = effects.groupBy("source").applyInPandas(
        lambda group: _scan(group, depth), f"source string, offset bigint, size bigint, {kinds}"
    )
    states = materialise(states, f"{scratch}/states")
    names = [part.split()[0] for part in PARTS.split(", ")]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = np.frombuffer(row["data"], np.uint8)
                state = State(*(row[f] for f in State._fields))
                found = [
                    (row["source"], c, e, row["offset"] + a, whole, row["data"][a:b]) for c, e, a, b, whole in cut(data, state, depth)
                ]
                arrays = [pa.array(list(c), t) for c, t in zip(zip(*found), types)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
    return materialise(pieces(states).mapInArrow(split, PARTS), f"{scratch}/parts")


def elements_of(parts: DataFrame) -> DataFrame:
    """``source, container, element, data``: the elements, those in several pieces put together."""
    rows = parts.where("container >= 0")
    crossing = rows.where("NOT whole").groupBy("source", "container", "element").agg(
        F.sort_array(F.collect_list(F.struct("offset", F.lit(-1).cast("bigint").alias("opens"), "data"))).alias("parts")
    )
    return rows.where("whole").select("source", "container", "element", "data").unionByName(_joined(crossing))


def frames_of(parts: DataFrame) -> DataFrame:
    """``source, data``: what stands around the elements, a container's number between its brackets as ``"#":n`` or ``n``."""
    none = F.lit(-1).cast("bigint")
    frame = parts.where("container < 0").groupBy("source").agg(
        F.sort_array(F.collect_list(F.struct("offset", F.col("element").alias("opens"), "data"))).alias("parts")
    )
    return _joined(frame.select("source", none.alias("container"), none.alias("element"), "parts")).select("source", "data")


def _joined(groups: DataFrame) -> DataFrame:
    """The parts of each row joined in order; an element is as large as a value in Spark may be, 2 GB."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                data = []
                for part in row["parts"]:
                    data.append(part["data"])
                    if part["opens"] >= 0:
                        data.append(f'"#":{part["opens"]}'.encode() if part["data"].endswith(b"{") else str(part["opens"]).encode())
                yield pa.RecordBatch.from_pylist(
                    [{"source": row["source"], "container": row["container"], "element": row["element"], "data": b"".join(data)}], schema=schema
                )

    schema = pa.schema([("source", pa.string()), ("container", pa.int64()), ("element", pa.int64()), ("data", pa.binary())])
    return groups.select("source", "container", "element", "parts").mapInArrow(join, "source string, container bigint, element bigint, data binary")
