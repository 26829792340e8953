"""Whole texts to token ids, one unit at a time.

A unit is a run of non-space characters with the one space before it, cut before ASCII marks that follow
an ASCII letter, or white space between units. The usual byte-level pattern never matches across units: its only look-ahead concerns white
space, which the units below cut in the same way. So the ids of a text are those of its units in
order. The units of a segment are cut by operations on all its bytes and coded by Arrow, so
only the distinct ones become Python strings: one dictionary probe each, not one an occurrence.
"""

from __future__ import annotations

import string
from collections.abc import Callable

import numpy as np
import pyarrow as pa

# The white space of Unicode.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE_BYTE = np.zeros(256, bool)
_SPACE_BYTE[[ord(c) for c in SPACES if c < "\x80"]] = True
_LETTER_BYTE = np.zeros(256, bool)
_LETTER_BYTE[list(string.ascii_letters.encode())] = True
_MARK_BYTE = np.zeros(256, bool)
_MARK_BYTE[list(string.punctuation.replace("'", "").encode())] = True  # an apostrophe may go with what follows
_LONG_SPACES = [np.frombuffer(c.encode(), np.uint8) for c in SPACES if c >= "\x80"]

_MARKS = ".,;:!?"

#: Units remembered by a worker in each of two generations, about 220 bytes each, and the longest one remembered.
REMEMBERED, LONGEST = 400_000, 64
#: Characters of a text cut into units at once.
SEGMENT = 2 << 20


def unit_starts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the units begin in UTF-8 texts that lie one after the other in ``data``; ``begins`` has where each text does."""
    if not len(data):
        return np.zeros(0, np.int64)
    space = _SPACE_BYTE[data]
    for lead in {int(c[0]) for c in _LONG_SPACES}:
        at = np.flatnonzero(data == lead)
        for char in (c for c in _LONG_SPACES if c[0] == lead):
            here = at[at + len(char) <= len(data)]
            for k in range(1, len(char)):
                here = here[data[here + k] == char[k]]
            for k in range(len(char)):
                space[here + k] = True
    first = np.zeros(len(data), bool)  # of a text
    first[begins[begins < len(data)]] = True
    change = first.copy()
    change[1:] |= space[1:] != space[:-1]
    words = np.flatnonzero(change & ~space)
    marks = change & space  # white space begins a unit
    alone = first[words]
    marks[words[alone]] = True
    words = words[~alone]
    last = words - 1  # the white space character right before a word
    for _ in range(2):
        last = last - ((data[last] & 0xC0) == 0x80)
    marks[last] = True
    marks[words[data[last] != 0x20]] = True  # others than the space are units of their own
    # A mark after a letter begins a match, and so a unit: words with and without marks are then the same few units.
    marks[1:] |= _MARK_BYTE[data[1:]] & _LETTER_BYTE[data[:-1]]
    return np.flatnonzero(marks)


class UnitEncoder:
    """``encode_units`` turns units into ids as little-endian unsigned 32-bit integers.

    What it gave is remembered. Two generations bound the memory: when the young one is full it
    becomes the old one, and units of the old one that occur again move to the young one.
    """

    def __init__(self, encode_units: Callable[[list[str]], list[bytes]]):
        self.encode_units = encode_units
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; units not met before are encoded together."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, str]] = []
        size = 0
        for i, text in enumerate(texts):
            at = 0
            while text and at < len(text):
                stop = self._cut(text, at)
                held.append((i, text[at:stop]))
                size += stop - at
                at = stop
                if size >= SEGMENT:
                    self._flush(held, out)
                    held, size = [], 0
        self._flush(held, out)
        return [b"".join(parts) for parts in out]

    def encode(self, text: str | None) -> bytes:
        return self.encode_many([text])[0]

    @staticmethod
    def _cut(text: str, at: int) -> int:
        """Where a unit ends for certain: before a space between two other characters."""
        stop = at + SEGMENT
        while stop < len(text):
            stop = text.find(" ", stop)
            if stop < 0:
                return len(text)
            if text[stop - 1] not in SPACES and stop + 1 < len(text) and text[stop + 1] not in SPACES:
                return stop
            stop += 1
        return len(text)

    def _flush(self, held: list[tuple[int, str]], out: list[list[bytes]]) -> None:
        if not held:
            return
        # Half of a pair of surrogates is no character.
        pieces = [text.encode("utf-8", "replace") for _, text in held]
        data = b"".join(pieces)
        stops = np.cumsum([len(p) for p in pieces])
        starts = unit_starts(np.frombuffer(data, np.uint8), np.concatenate([[0], stops[:-1]]))
        bounds = pa.py_buffer(np.append(starts, len(data)))
        coded = pa.LargeStringArray.from_buffers(len(starts), bounds, pa.py_buffer(data)).dictionary_encode()
        ids = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        codes, table = coded.indices.to_numpy(), np.frombuffer(b"".join(ids), "<u4")
        n = counts[codes]
        ends = np.cumsum(n)
        source = np.repeat((np.cumsum(counts) - counts)[codes] - (ends - n), n)
        source += np.arange(len(source))
        raw, ends = table[source].tobytes(), np.concatenate([[0], 4 * ends])
        at = ends[np.searchsorted(starts, np.concatenate([[0], stops]))].tolist()
        for (i, _), a, b in zip(held, at, at[1:]):
            out[i].append(raw[a:b])

    def _ids(self, units: list[str]) -> list[bytes]:
        """The ids of distinct units."""
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        ids = list(map(young.get, units))
        missing = [u for u, known in zip(units, ids) if known is None]
        if not missing:
            return ids
        fresh = []
        for unit in missing:
            known = old.get(unit)
            if known is None:
                fresh.append(unit)
            else:
                young[unit] = known
        # A mark after a letter is a match of its own, so a known word lends its ids.
        marked = [u for u in fresh if u[-1] in _MARKS and u[-2:-1].isalpha() and u[:-1] in young]
        if marked:
            fresh = list(set(fresh).difference(marked).union([u[-1] for u in marked if u[-1] not in young]))
        young.update(zip(fresh, self.encode_units(fresh)))
        young.update([(u, young[u[:-1]] + young[u[-1]]) for u in marked])
        found = map(young.get, missing)
        ids = [next(found) if known is None else known for known in ids]
        for unit in missing:
            if len(unit) > LONGEST:
                del young[unit]
        return ids
