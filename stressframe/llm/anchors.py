"""Content-defined spans: runs of windows that share their smallest inner hash."""

from __future__ import annotations

import numpy as np

from stressframe.llm.textvec import Roller, mix

PLACE_BITS = 24


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours (len(x) - width + 1 values)."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


class Anchors:
    """Cuts texts into spans so that equal windows lie in spans with equal keys.

    A window's anchor is the smallest hash of its ``inner``-byte substrings (the
    first of equals), a function of the window's bytes alone.  A span is a
    longest run of windows with one anchor; inside a span no window repeats."""

    def __init__(self, window: int, inner: int):
        self.window, self.inner = window, inner
        self.one, self.two = Roller(1), Roller(2)

    def spans(self, data: np.ndarray, offsets: np.ndarray):
        """(key, signature, row, start in row, windows, anchor - start) of every span of a
        slice of fewer than 2**24 bytes.  The signature stands for the span's bytes."""
        none = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 4)
        n, k, m = len(data), self.window, self.inner
        if n < k:
            return none
        assert n < 1 << PLACE_BITS
        self.one.load(data)
        place = np.arange(n - m + 1)
        h = self.one.ranges(place, place + m)
        low = np.uint64((1 << PLACE_BITS) - 1)
        best = sliding_min((h & ~low) | place.astype(np.uint64), k - m + 1)
        anchor = (best & low).astype(np.int64)
        valid = np.ones(len(anchor), bool)
        for back in range(1, k):  # windows that would cross a border of rows
            at = offsets[1:-1] - back
            valid[at[(at >= 0) & (at < len(valid))]] = False
        head = valid.copy()
        head[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
        start = np.flatnonzero(head)
        if not len(start):
            return none
        stop = np.flatnonzero(valid & np.append(head[1:] | ~valid[1:], True)) + 1
        self.two.load(data)
        end = stop - 1 + k
        sign = mix(self.two.ranges(start, end) + (end - start).astype(np.uint64))
        row = np.searchsorted(offsets, start, side="right") - 1
        return h[anchor[start]], sign, row, start - offsets[row], stop - start, anchor[start] - start
