"""Numpy views over Arrow text batches: byte buffers, words, hashes.

All helpers work on a *slice*: the UTF-8 bytes of consecutive rows in one
``uint8`` array with row offsets.  Slices hold a bounded number of bytes (or
one long row), so memory in a task does not follow the batch or the table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_M1 = np.uint64(0xFF51AFD7ED558CCD)  # fixed values: 64-bit finaliser of MurmurHash3
_M2 = np.uint64(0xC4CEB9FE1A85EC53)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_S33 = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing (every bit of the result depends on every bit of x)."""
    x = x ^ (x >> _S33)
    x = x * _M1
    x = x ^ (x >> _S33)
    x = x * _M2
    return x ^ (x >> _S33)


def byte_codes(seed: int = 0) -> np.ndarray:
    """256 pseudo-random 64-bit codes, one per byte value; depends on the seed only."""
    return mix(np.arange(1, 257, dtype=np.uint64) * _BASE + np.uint64(seed))


def text_slices(column, limit: int = SLICE_BYTES):
    """Yield (first_row, data uint8, offsets int64) over a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n, buffers = len(column), column.buffers()
    if n == 0:
        return
    offs = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)
    offs = offs[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        stop = int(np.searchsorted(offs, offs[row] + limit, side="right")) - 1
        stop = min(n, max(stop, row + 1))
        yield row, data[offs[row] : offs[stop]], offs[row : stop + 1] - offs[row]
        row = stop


def powers(n: int, base: np.uint64 = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    out = []
    for b in (base, inverse):
        p = np.full(max(n, 1), b, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Roller:
    """Hashes of any byte ranges of a slice from one cumulative sum."""

    def __init__(self, seed: int = 0):
        self.codes = byte_codes(seed)
        self.up = self.down = np.zeros(0, np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self.up):
            self.up, self.down = powers(n)

    def load(self, data: np.ndarray) -> None:
        n = len(data)
        self._grow(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.codes[data] * self.up[:n], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hash of bytes [start, end) of the loaded slice, position-independent."""
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def lower_table() -> np.ndarray:
    """Byte map that lower-cases A-Z and leaves the rest."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def class_table(ranges) -> np.ndarray:
    t = np.zeros(256, bool)
    for a, b in ranges:
        t[a : b + 1] = True
    return t


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
    """Runs of bytes of class ``inside``, split at row borders: (start, end, row)."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    m = inside[data]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    first = m.copy()
    first[1:] &= ~m[:-1] | border[1:n]
    last = m.copy()
    last[:-1] &= ~m[1:] | border[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return start, end, row
