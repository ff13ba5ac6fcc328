"""Positional Burrows-Wheeler transforms of shards and their merge.

All strings are aligned by their anchor, so only suffixes that begin in the same
column can share a window.  A shard's transform holds, per column from right to
left, the bytes that stand before the shard's sorted suffixes.  Shards are
merged by refining an interleave: ``z`` names the shard of every suffix in merged
order; each column's bytes are drawn from the shards in that order, and a stable
bucket step by those bytes gives the interleave one column further left.  No
suffix is compared or sorted again.  The column where a suffix first differs from
the one before it (its common prefix) follows from range minima of the last
column's.  After a window's width of columns, suffixes with common prefixes of
that width are the repeated intervals.
"""

from __future__ import annotations

import numpy as np


class Strings:
    """Byte strings with an anchor: ``data[start : start + size]``, anchor at ``start + mid``."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, mid: np.ndarray):
        self.data, self.start, self.size, self.mid = data, start, size, mid
        self.first, self.last = -mid, size - mid  # columns [first, last) around the anchor


class ShardTransform:
    """Per column: bytes in the order of the suffixes to the right, how many strings
    end there, and which of the sorted suffixes begin there and leave."""

    def __init__(self, strings: Strings, members: np.ndarray):
        s = strings
        self.members = members
        first, last = s.first[members], s.last[members]
        by_last = np.argsort(-last, kind="stable")
        self.low, self.high = int(first.min()), int(last.max())
        self.columns: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        order = np.zeros(0, np.int64)
        seen = 0
        for c in range(self.high - 1, self.low - 1, -1):
            stay = first[order] <= c
            order = order[stay]
            upto = seen
            while upto < len(by_last) and last[by_last[upto]] == c + 1:
                upto += 1
            new = by_last[seen:upto]
            seen = upto
            order = np.concatenate([new, order])
            byte = s.data[s.start[members[order]] + s.mid[members[order]] + c]
            self.columns[c] = (byte, stay, members[new])
            order = order[np.argsort(byte, kind="stable")]


def _range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low : high + 1]) for many ranges."""
    levels = [values]
    width = 1
    longest = int((high - low).max()) + 1 if len(low) else 1
    while 2 * width <= longest:
        x = levels[-1]
        levels.append(np.minimum(x[: len(x) - width], x[width:]))
        width *= 2
    k = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    out = np.empty(len(low), values.dtype)
    for j in range(len(levels)):
        at = np.flatnonzero(k == j)
        if len(at):
            x = levels[j]
            out[at] = np.minimum(x[low[at]], x[high[at] - (1 << j) + 1])
    return out


def repeated_windows(strings: Strings, rank: np.ndarray, window: int, shard_size: int = 16_384) -> tuple[np.ndarray, int]:
    """(flags strings x columns, first column): windows of which a string of smaller
    ``rank`` holds an equal one in the same column."""
    n = len(rank)
    shards = [ShardTransform(strings, np.arange(at, min(n, at + shard_size))) for at in range(0, n, shard_size)]
    low, high = min(s.low for s in shards), max(s.high for s in shards)
    flags = np.zeros((n, high - low), bool)
    z = np.zeros(0, np.int32)  # shard of each suffix, in merged order
    who = np.zeros(0, np.int64)  # its string
    differ = np.zeros(0, np.int32)  # column where it first differs from the suffix before it
    for c in range(high - 1, low - 1, -1):
        stay = np.ones(len(z), bool)
        for k, s in enumerate(shards):
            if c in s.columns:
                stay[z == k] = s.columns[c][1]
            elif c + 1 in s.columns:
                stay[z == k] = False
        if not stay.all():
            kept = np.flatnonzero(stay)
            if len(kept):
                previous = np.concatenate([[-1], kept[:-1]])
                differ = _range_min(differ, previous + 1, kept)
            else:
                differ = differ[:0]
            z, who = z[kept], who[kept]
        new = [s.columns[c][2] if c in s.columns else np.zeros(0, np.int64) for s in shards]
        entering = np.concatenate(new)
        if len(entering):
            if len(differ):
                differ = differ.copy()
                differ[0] = c + 1
            z = np.concatenate([np.repeat(np.arange(len(shards), dtype=np.int32), [len(x) for x in new]), z])
            who = np.concatenate([entering, who])
            differ = np.concatenate([np.full(len(entering), c + 1, np.int32), differ])
        if not len(z):
            continue
        byte = np.empty(len(z), np.uint8)
        for k, s in enumerate(shards):
            if c in s.columns:
                byte[z == k] = s.columns[c][0]
        step = np.argsort(byte, kind="stable")
        z, who, byte = z[step], who[step], byte[step]
        fresh = np.full(len(z), c, np.int32)
        same = np.flatnonzero(byte[1:] == byte[:-1]) + 1
        if len(same):
            fresh[same] = _range_min(differ, step[same - 1] + 1, step[same])
        differ = fresh
        whole = differ >= c + window  # shares a window with the suffix before it
        if whole.any():
            group = np.cumsum(~whole) - 1
            at = np.flatnonzero(~whole)
            least = np.minimum.reduceat(rank[who], at)
            later = rank[who] != least[group]
            flags[who[later], c - low] = True
    return flags, low
