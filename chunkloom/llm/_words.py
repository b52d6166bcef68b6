"""Words and word-sequence hashes of whole Arrow text columns, vectorised over the UTF-8 bytes.

A word is a longest run of bytes other than space and ``\\t\\n\\v\\f\\r``.  No Python string is made
per word: boundaries come from a byte table, and hashes from polynomial prefix sums modulo 2**64,
so that the hash of any span costs two look-ups.  Texts are handled in slices of about
``SLICE_BYTES`` (a longer single text is one slice), which bounds memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 17
_U = np.uint64
_MASK = (1 << 64) - 1
WHITESPACE = np.zeros(256, bool)
WHITESPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, _U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, b in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, b, _U)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_BYTES, _SEQ, _SEQ2 = _Powers(0xD6E8FEB86659FD93), _Powers(0xA0761D6478BD642F), _Powers(0xE7037ED1A0B428DB)


@dataclass
class Words:
    """Words of one slice. ``doc`` is the row within the slice, ``first[d]`` the first word of row d."""

    start_row: int
    n_docs: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def position(self) -> np.ndarray:
        """Index of each word within its own document."""
        return np.arange(len(self.starts)) - self.first[self.doc]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        up, down = _BYTES.get(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, _U)
        np.cumsum(_BYTE[self.data] * up[:-1], out=sums[1:])
        h = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        return mix(h ^ ((self.ends - self.starts).astype(_U) << _U(56)))

    def windows(self, hashes: np.ndarray, k: int, second: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """``(i, h)``: first word and hash of every run of k words that lies in one document."""
        n = len(hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, _U)
        up, down = (_SEQ2 if second else _SEQ).get(len(hashes) + 1)
        sums = np.zeros(len(hashes) + 1, _U)
        np.cumsum(hashes * up[:-1], out=sums[1:])
        h = mix((sums[k:] - sums[:-k]) * down[:n])
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        return at, h[at]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, data)`` of a text column without its nulls, offsets from 0."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, off, data = column.buffers()
    if len(column) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(off, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw


def slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``SLICE_BYTES``, one row at least."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1)
        yield row, end
        row = end


def words(column: pa.Array, lower: bool = False) -> Iterator[Words]:
    """The words of a text column, slice by slice; nulls have none."""
    offsets, raw = buffers(column)
    for row, end in slices(offsets):
        data = raw[offsets[row] : offsets[end]]
        off = offsets[row : end + 1] - offsets[row]
        if lower:
            data = LOWER[data]
        inside = ~WHITESPACE[data]
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        cut = off[:-1]
        before[cut[cut < len(data)]] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        cut = off[1:] - 1
        after[cut[cut >= 0]] = False
        ends = np.flatnonzero(inside & ~after) + 1
        first = np.searchsorted(starts, off, "left")
        doc = np.repeat(np.arange(end - row), np.diff(first))
        yield Words(row, end - row, data, starts, ends, doc, first)
