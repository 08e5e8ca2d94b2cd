"""Vectorised text primitives shared by the operators: byte buffers, words, rolling hashes.

All functions work on one Arrow batch at a time inside a Spark task. A text batch is a flat
``uint8`` buffer plus document offsets, so that no Python object exists per word or byte.

Words are ``[^\\x20\\x09-\\x0D]+``; the delimiters are ASCII, so splitting the UTF-8 bytes equals
splitting the code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_WORD = np.ones(256, dtype=bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_INVERSE = pow(_BASE, -1, 1 << 64)
_cache = {"power": np.ones(1, U64), "inverse": np.ones(1, U64)}


def _powers(name: str, base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2**64; kept for the next call."""
    if len(_cache[name]) < n:
        out = np.full(max(n, 1 << 16), base, dtype=U64)
        out[0] = 1
        _cache[name] = np.cumprod(out, dtype=U64)
    return _cache[name][:n]


class Hashes:
    """Hashes of any stretch of a sequence from its prefix sums: a polynomial modulo 2**64, then mixed."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.prefix = np.zeros(n + 1, U64)
        weighted = values.astype(U64) + U64(1)
        weighted *= _powers("power", _BASE, n)
        np.cumsum(weighted, out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * _powers("inverse", _INVERSE, len(self.prefix))[start] + (end - start).astype(U64))

    def windows(self, start: np.ndarray, width: int) -> np.ndarray:
        return self.of(start, start + width)


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    off = np.frombuffer(offs, dtype=np.int64, count=n + 1, offset=8 * column.offset)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def slices(off: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Runs of whole documents of about ``size`` bytes each, as (first, last + 1)."""
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


class Words:
    """Words of a run of documents: ``start``/``end`` in the buffer, ``hash``, ``first`` (per document)."""

    __slots__ = ("buf", "off", "start", "end", "first", "hash")

    def __init__(self, buf: np.ndarray, off: np.ndarray, lower: bool = False, hashed: bool = True):
        if lower:
            up = (buf >= 65) & (buf <= 90)
            buf = np.where(up, buf + np.uint8(32), buf)
        self.buf, self.off = buf, off
        n = len(buf)
        if n == 0:
            self.start = self.end = np.zeros(0, np.int64)
            self.first = np.zeros(len(off), np.int64)
            self.hash = np.zeros(0, U64)
            return
        isw = _WORD[buf]
        edge = np.zeros(n + 1, dtype=bool)
        edge[off] = True
        begins = isw.copy()
        begins[1:] &= ~isw[:-1] | edge[1:n]
        stops = isw.copy()
        stops[:-1] &= ~isw[1:] | edge[1:n]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.start, off)
        self.hash = Hashes(buf).of(self.start, self.end) if hashed else np.zeros(0, U64)

    def doc(self) -> np.ndarray:
        """Index of the document of each word."""
        return np.repeat(np.arange(len(self.off) - 1), np.diff(self.first))

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """(document, hash) of each line (split at newline bytes) that has a word, in order."""
        if not len(self.start):
            return np.zeros(0, np.int64), np.zeros(0, U64)
        n = len(self.buf)
        newline = np.flatnonzero(self.buf == 10)
        begin = np.sort(np.concatenate([self.off[:-1][self.off[:-1] < n], newline[newline + 1 < n] + 1]))
        begin = begin[heads(begin)]
        line = np.searchsorted(begin, self.start, side="right") - 1
        used = line[heads(line)]
        lo = begin[used]
        doc = np.searchsorted(self.off, lo, side="right") - 1
        nxt = np.append(begin[1:], n)[used]
        # a line's bytes run to the newline, or to the end of its document
        hi = np.minimum(nxt, self.off[doc + 1])
        hi = hi - ((hi > lo) & (self.buf[hi - 1] == 10))
        return doc, Hashes(self.buf).of(lo, hi)


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive hashes; empty when there are fewer."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = h[:n].copy()
    for k in range(1, width):
        out *= U64(_BASE)
        out += h[k : k + n]
    return mix(out)


def window_starts(count: np.ndarray, width: int) -> np.ndarray:
    """Boolean per element of the concatenation: a window of ``width`` starts here and stays in its document."""
    total = int(count.sum())
    stop = np.repeat(np.cumsum(count), count)
    return np.arange(total) + width <= stop


def expand(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All integers of the half-open ranges, in order."""
    size = end - start
    total = int(size.sum())
    return np.arange(total) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)


def merged(start: np.ndarray, end: np.ndarray, piece: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The union of ranges sorted by start (and end); ranges of different ``piece`` are kept apart."""
    if not len(start):
        return start, end
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    if piece is not None:
        new[1:] |= piece[1:] != piece[:-1]
    first = np.flatnonzero(new)
    return start[first], end[np.append(first[1:], len(start)) - 1]


class Members:
    """Membership in a sorted set of mixed hashes: a bitmap turns most away, a binary search settles the rest."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = max(10, min(24, int(len(keys) * 16).bit_length()))
        self.map = np.zeros(1 << self.bits, bool)
        self.map[self._slot(keys)] = True

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys & U64((1 << self.bits) - 1)).astype(np.int64)

    def test(self, keys: np.ndarray) -> np.ndarray:
        out = self.map[self._slot(keys)]
        at = np.flatnonzero(out)
        if len(at):
            want = keys[at]
            spot = np.searchsorted(self.keys, want)
            spot[spot == len(self.keys)] = 0
            out[at] = self.keys[spot] == want
        return out


def sorted_distinct(keys: np.ndarray) -> np.ndarray:
    """As ``np.unique``, by sorting."""
    keys = np.sort(keys)
    return keys[heads(keys)]


def heads(keys: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins in sorted ``keys``."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return new
