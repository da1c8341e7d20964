"""Columnar text kernels shared by the corpus operators.

An Arrow string column is one UTF-8 buffer plus offsets.  Everything here works on that buffer
with numpy, a bounded slice of rows at a time, so no Python object is made per word.

Words are ``[^\\x20\\x09-\\x0D]+``.  All separators are ASCII, so splitting bytes equals splitting
code points.  A word's identity is a 64-bit polynomial hash of its bytes, mixed; distinct words
collide with a probability of about 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_TABLE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_SEP = np.zeros(256, bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: list[np.ndarray] = []


def _power_tables() -> list[np.ndarray]:
    if not _powers:
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(_TABLE, base, np.uint64)
            p[0] = 1
            _powers.append(np.multiply.accumulate(p))
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


class Hasher:
    """64-bit hashes of byte ranges of ``data``, independent of their position."""

    def __init__(self, data: np.ndarray):
        self.data, n = data, len(data)
        power, self.inverse = _power_tables()
        scale = power[:n] if n <= _TABLE else power[np.arange(n) & (_TABLE - 1)]
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * scale, out=self.prefix[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if not len(start):
            return np.zeros(0, np.uint64)
        h = (self.prefix[end] - self.prefix[start]) * self.inverse[start & (_TABLE - 1)]
        if len(self.data) > _TABLE:  # ranges over a wrap of the power table are hashed byte by byte
            for i in np.flatnonzero(start // _TABLE != (end - 1) // _TABLE):
                v, p = 0, 1
                for b in self.data[start[i] : end[i]].tolist():
                    v, p = (v + (b + 1) * p) & _MASK, (p * _BASE) & _MASK
                h[i] = v
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


@dataclass
class Slice:
    """Rows ``first`` to ``first + rows`` of a batch, as bytes and row offsets."""

    first: int
    rows: int
    data: np.ndarray
    offsets: np.ndarray

    def lower(self) -> Slice:
        """A-Z to a-z; other characters stay."""
        return Slice(self.first, self.rows, _LOWER[self.data], self.offsets)

    def text(self, i: int) -> str:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().decode("utf-8", "replace")


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """A string column in row order, cut into slices of about ``max_bytes``; one long text is one slice. Null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, off, buf = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1)
        to = min(to, len(column))
        yield Slice(at, to - at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


@dataclass
class Words:
    """Words of a slice in order: byte range, row and hash."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray  # of each row's words

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def runs(s: Slice, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal ranges of ``inside`` bytes that do not cross rows: start, end, row."""
    n = len(s.data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    edge = np.zeros(n + 1, bool)
    edge[s.offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = True, ~inside[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, ~inside[1:]
    start = np.flatnonzero(inside & (before | edge[:-1]))
    end = np.flatnonzero(inside & (after | edge[1:])) + 1
    return start, end, np.searchsorted(s.offsets, start, side="right") - 1


def words(s: Slice, inside: np.ndarray | None = None) -> Words:
    """Words of a slice; with ``inside``, maximal runs of those bytes instead."""
    start, end, row = runs(s, ~_SEP[s.data] if inside is None else inside)
    return Words(start, end, row, Hasher(s.data)(start, end), np.searchsorted(row, np.arange(s.rows + 1)))


def ngrams(w: Words, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and first word of each n-word window. With ``short``, a row of 1 to n-1 words gives its whole sequence as one window."""
    m = max(len(w) - n + 1, 0)
    at = np.flatnonzero(w.row[:m] == w.row[n - 1 :]) if m else np.zeros(0, np.int64)
    h = np.zeros(len(at), np.uint64)
    for k in range(n):
        h += w.hash[at + k] * np.uint64(pow(_BASE, 2 * k + 1, 1 << 64))
    h, row = mix(h), w.row[at]
    if short:
        counts = w.counts()
        few = np.flatnonzero((counts > 0) & (counts < n))
        if len(few):
            extra = np.zeros(len(few), np.uint64)
            for j, r in enumerate(few):
                v = int(counts[r]) * 0x632BE59BD9B4E019
                for k, x in enumerate(w.hash[w.bounds[r] : w.bounds[r + 1]].tolist()):
                    v += x * pow(_BASE, 2 * k + 1, 1 << 64)
                extra[j] = v & _MASK
            h, row, at = np.concatenate([h, mix(extra)]), np.concatenate([row, few]), np.concatenate([at, w.bounds[few]])
            order = np.argsort(row, kind="stable")
            h, row, at = h[order], row[order], at[order]
    return h, row, at


def sums(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Sum of values by row."""
    return np.bincount(row, weights=values, minlength=rows)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
