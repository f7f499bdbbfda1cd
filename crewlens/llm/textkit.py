"""Words of whole texts as numpy arrays, straight from Arrow buffers.

A word is a maximal run of bytes other than ASCII white space (`[^\\x20\\x09-\\x0D]+`). Every word gets a
64-bit hash of its bytes; n-grams combine the hashes of their words. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E6C63D0876A9A47)
INVERSE = np.uint64(pow(0x9E6C63D0876A9A47, -1, 1 << 64))
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_PIECE = 1 << 18

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Everything in ASCII but letters and digits.
NOT_ALNUM = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    def table(factor: np.uint64) -> np.ndarray:
        x = np.full(_PIECE + 1, factor, np.uint64)
        x[0] = 1
        return np.cumprod(x, dtype=np.uint64)

    return table(BASE), table(INVERSE)


def runs(solid: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of marked bytes; no run crosses a text's edge."""
    edge = np.zeros(len(solid) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(solid) + 1, bool)
    before[1:] = solid
    after = np.zeros(len(solid) + 1, bool)
    after[:-1] = solid
    return np.flatnonzero(after & (~before | edge)), np.flatnonzero(before & (~after | edge))


class Words:
    """The words of some texts: byte starts and ends in `data`, hashes, and `first`, the place of each
    text's first word (one more entry closes the last text)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool, breaks: np.ndarray = SPACE):
        self.data, self.offsets = data, offsets
        self.size = len(offsets) - 1
        self.solid = ~breaks[data]
        self.start, self.end = runs(self.solid, offsets)
        self.first = np.searchsorted(self.start, offsets)
        self.hash = self._hashes(_LOWER[data] if lower else data)

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.start), np.uint64)
        length = (self.end - self.start).astype(np.uint64)
        power, inverse = _powers()
        k = 0
        while k < len(out):
            at = int(self.start[k])
            stop = max(k + 1, int(np.searchsorted(self.end, at + _PIECE, "right")))
            to = int(self.end[stop - 1])
            if to - at <= _PIECE:
                sums = np.zeros(to - at + 1, np.uint64)
                np.cumsum((data[at:to].astype(np.uint64) + np.uint64(1)) * power[: to - at], out=sums[1:])
                start, end = self.start[k:stop] - at, self.end[k:stop] - at
                out[k:stop] = (sums[end] - sums[start]) * inverse[start]
            else:  # one word longer than a piece: the sum of its pieces, each with its own power
                total, place = 0, 1
                for i in range(at, to, _PIECE):
                    part = data[i : min(i + _PIECE, to)].astype(np.uint64) + np.uint64(1)
                    total += int(np.sum(part * power[: len(part)], dtype=np.uint64)) * place
                    place = place * pow(int(BASE), len(part), 1 << 64) % (1 << 64)
                out[k] = np.uint64(total % (1 << 64))
            k = stop
        return mix(out ^ (length * _ODD[0]))

    def heads(self, size: int, lower: bool) -> np.ndarray:
        """Hashes of the first `size` bytes of each word (of the whole word, if shorter)."""
        data = _LOWER[self.data] if lower else self.data
        out = np.full(len(self.start), np.uint64(size))
        for k in range(size):
            at = self.start + k
            inside = at < self.end
            out[inside] = mix(out[inside] ^ (data[at[inside]].astype(np.uint64) + np.uint64(256)))
        return out

    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(self.size), self.counts())

    def text(self, i: int) -> str:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().decode("utf-8", "replace")


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of letters, digits and bytes beyond ASCII, A-Z lower-cased: their bytes without what lies between them, the
    places where each starts there (one more entry closes the last), and the first term of each text (likewise)."""
    solid = ~NOT_ALNUM[data]
    start, end = runs(solid, offsets)
    places = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=places[1:])
    return _LOWER[data[solid]], places, np.searchsorted(start, offsets)


def binaries(data: np.ndarray, places: np.ndarray) -> pa.LargeBinaryArray:
    """Bytes between places as an Arrow column."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(np.ascontiguousarray(places)), pa.py_buffer(np.ascontiguousarray(data))])


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams that start at each place; the last n-1 places have none."""
    size = max(0, len(words) - n + 1)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out = mix(out * _ODD[0] + words[k : k + size] + _ODD[1])
    return out


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values between offsets."""
    sums = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "bui" else np.float64)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its offsets into them; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows [a, b) with about `limit` bytes of text (a longer text is one piece), their bytes and offsets."""
    data, offsets = _buffers(column)
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def slices(column: pa.Array, lower: bool, limit: int = 2 << 20, breaks: np.ndarray = SPACE) -> Iterator[tuple[int, int, Words]]:
    """The words of rows [a, b), piece by piece."""
    for a, b, data, offsets in pieces(column, limit):
        yield a, b, Words(data, offsets, lower, breaks)


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers in the narrowest width that holds them, after one byte for the width."""
    kind = np.min_scalar_type(int(values.max())) if len(values) else np.dtype(np.uint8)
    return bytes([kind.itemsize]) + values.astype(kind).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)
