"""Benchmark decontamination by q-gram counting in diagonal bands (operator 3).

Texts are UTF-8 bytes with A-Z lower-cased.  An item of n bytes may differ from
a document's passage by ``budget = floor(rate * n)`` edits.  By the q-gram lemma
such a passage shares at least n - q + 1 - q * budget q-grams with the item, and
all of them lie within budget + 1 neighbouring diagonals.  Each item takes the largest
q up to ``q`` that leaves this bound at 1 or more, so short items keep their budget;
items with one q share an index.  Hits are counted in
overlapping bands of twice that width; bands that reach the bound are verified
by banded alignment (item whole, passage anywhere in the band).

The item index is sent to the tasks in blocks of at most ``block_bytes`` of item
text, so its size is bounded whatever the benchmark's; documents are scanned in
place, once for each block, with no shuffle.  Special cases: null or empty items and
texts hold nothing; items with equal texts
each report; very long texts are read in overlapping windows; empty tables give
an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stressframe.llm.textvec import SLICE_BYTES, Roller, lower_table, text_slices

BITMAP_BITS = 20
ALIGN_CELLS = 4_000_000


def budgets(n: np.ndarray, rate: float) -> np.ndarray:
    """Edits that items of ``n`` bytes may have."""
    return np.floor(rate * n).astype(np.int64)


def gram_lengths(n: np.ndarray, q: int, rate: float) -> np.ndarray:
    """Largest gram length up to ``q`` for which n - q + 1 - q * budget is 1 or more."""
    return np.minimum(q, n // (1 + budgets(n, rate)))


class ItemIndex:
    """q-gram postings of distinct items that take grams of one length, as sorted arrays."""

    def __init__(self, texts: list[bytes], q: int, rate: float):
        lower = lower_table()
        self.q = q
        self.items = [lower[np.frombuffer(t, np.uint8)] for t in texts]
        self.n = np.array([len(t) for t in texts], np.int64)
        self.budget = budgets(self.n, rate)
        self.bound = self.n - q + 1 - q * self.budget
        self.width = self.budget + 1
        roller = Roller()
        grams, item, place = [], [], []
        for k, t in enumerate(self.items):
            roller.load(t)
            at = np.arange(len(t) - q + 1)
            grams.append(roller.ranges(at, at + q))
            item.append(np.full(len(at), k))
            place.append(at)
        g = np.concatenate(grams)
        order = np.argsort(g, kind="stable")
        self.grams, first = np.unique(g[order], return_index=True)
        self.first = np.append(first, len(g))
        self.item, self.place = np.concatenate(item)[order], np.concatenate(place)[order]
        self.seen = np.zeros(1 << BITMAP_BITS, bool)
        self.seen[self.grams >> np.uint64(64 - BITMAP_BITS)] = True

    def candidates(self, data: np.ndarray, offsets: np.ndarray, roller: Roller):
        """(row, item, first diagonal of the double band, hits) where the count reaches the bound."""
        none = (np.zeros(0, np.int64),) * 4
        if len(data) < self.q:
            return none
        roller.load(data)
        at = np.arange(len(data) - self.q + 1)
        h = roller.ranges(at, at + self.q)
        at = np.flatnonzero(self.seen[h >> np.uint64(64 - BITMAP_BITS)])
        h = h[at]
        g = np.minimum(np.searchsorted(self.grams, h), len(self.grams) - 1)
        row = np.searchsorted(offsets, at, side="right") - 1
        real = (self.grams[g] == h) & (at + self.q <= offsets[row + 1])
        at, g, row = at[real], g[real], row[real]
        n = self.first[g + 1] - self.first[g]
        total = int(n.sum())
        if not total:
            return none
        post = np.repeat(self.first[g] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(total)
        item = self.item[post]
        diagonal = np.repeat(at, n) - self.place[post] + int(self.n.max())
        band = diagonal // self.width[item]
        key = (np.repeat(row, n).astype(np.uint64) << np.uint64(44)) | (item.astype(np.uint64) << np.uint64(24)) | band.astype(np.uint64)
        key, count = np.unique(key, return_counts=True)
        after = np.zeros(len(key), np.int64)
        after[:-1] = np.where(key[1:] == key[:-1] + np.uint64(1), count[1:], 0)
        only_next = np.ones(len(key), bool)  # double bands that begin one band before a key
        only_next[1:] = key[1:] != key[:-1] + np.uint64(1)
        keys = np.concatenate([key, key[only_next] - np.uint64(1)])
        hits = np.concatenate([count + after, count[only_next]])
        item = ((keys >> np.uint64(24)) & np.uint64((1 << 20) - 1)).astype(np.int64)
        good = hits >= self.bound[np.minimum(item, len(self.n) - 1)]
        keys, hits, item = keys[good], hits[good], item[good]
        band = (keys & np.uint64((1 << 24) - 1)).astype(np.int64)
        return (keys >> np.uint64(44)).astype(np.int64), item, band * self.width[item] - int(self.n.max()), hits

    def align(self, data: np.ndarray, offsets: np.ndarray, row, item, low):
        """(edits, end of the passage in the row) of the best alignment in each double band."""
        edits, stop = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
        if not len(row):
            return edits, stop
        span = 2 * self.width + 2 * self.budget
        most = int(self.n[item].max())
        step = max(1, ALIGN_CELLS // int(span[item].max()))
        for s in range(0, len(row), step):
            r, m, lo = row[s : s + step], item[s : s + step], low[s : s + step] - self.budget[item[s : s + step]]
            c, width = len(r), int(span[m].max())
            text = np.zeros((c, most), np.uint8)
            for k in range(c):
                text[k, : self.n[m[k]]] = self.items[m[k]]
            drift = np.arange(width)
            start, end = offsets[r][:, None], offsets[r + 1][:, None]
            cost = np.zeros((c, width), np.int32)
            out = (drift[None, :] >= span[m][:, None])
            far = np.int32(1 << 20)
            cost[out] = far
            # a passage begins inside its row
            cost[(lo[:, None] + drift < start) | (lo[:, None] + drift > end)] = far
            best, where = np.full(c, far), np.zeros(c, np.int64)
            for j in range(int(self.n[m].max())):
                place = lo[:, None] + drift + j
                inside = (place >= start) & (place < end)
                same = inside & (data[np.clip(place, 0, len(data) - 1)] == text[:, j][:, None])
                step_diag = np.where(inside, cost + (~same), far)
                skip_item = np.full_like(cost, far)
                skip_item[:, :-1] = cost[:, 1:] + 1
                # the band moves by one byte: a skipped item byte stays at the same place
                new = np.minimum(step_diag, skip_item)
                new = np.minimum.accumulate(new - drift, axis=1) + drift
                new[out] = far
                new[place + 1 > end] = far
                cost = np.minimum(new, far).astype(np.int32)
                done = np.flatnonzero(self.n[m] == j + 1)
                if len(done):
                    at = cost[done].argmin(axis=1)
                    best[done] = cost[done, at]
                    where[done] = lo[done] + at + j + 1 - offsets[r[done]]
            edits[s : s + step], stop[s : s + step] = best, where
        return edits, stop


def _windows(data: np.ndarray, offsets: np.ndarray, overlap: int):
    """The slice itself, or overlapping windows of its one very long text: (data, offsets, shift)."""
    if len(data) <= 2 * SLICE_BYTES:
        yield data, offsets, 0
        return
    for at in range(0, len(data), SLICE_BYTES):
        part = data[at : at + SLICE_BYTES + overlap]
        yield part, np.array([0, len(part)]), at


def _search(texts: list[bytes], q: int, rate: float):
    """Function of a text column: {(row, item): (edits, end, hits)} of the passages found."""
    length = gram_lengths(np.array([len(t) for t in texts], np.int64), q, rate)
    parts = [(ItemIndex([texts[k] for k in np.flatnonzero(length == g)], int(g), rate), np.flatnonzero(length == g)) for g in np.unique(length)]
    roller, lower = Roller(), lower_table()
    overlap = 3 * max(len(t) for t in texts)

    def find(column) -> dict[tuple[int, int], tuple[int, int, int]]:
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for first_row, data, offsets in text_slices(column):
            for part, offs, shift in _windows(lower[data], offsets, overlap):
                for index, number in parts:
                    row, item, low, hits = index.candidates(part, offs, roller)
                    edits, stop = index.align(part, offs, row, item, low)
                    for k in np.flatnonzero(edits <= index.budget[item]):
                        key = (first_row + int(row[k]), int(number[item[k]]))
                        new = (int(edits[k]), int(stop[k]) + shift, int(hits[k]))
                        best[key] = min(best.get(key, new), new)
        return best

    return find


def _scan_block(docs: DataFrame, texts: list[bytes], ids: list[list[int]], id_col: str, text_col: str, q: int, rate: float) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast((texts, ids))

    def run(batches):
        texts_, item_ids = sent.value
        find = _search(texts_, q, rate)
        for batch in batches:
            best = find(batch.column(1))
            keys = [(r, m, i) for r, m in sorted(best) for i in item_ids[m]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array([r for r, _, _ in keys], pa.int64())),
                    pa.array([i for _, _, i in keys], pa.int64()),
                    pa.array([best[r, m][0] for r, m, _ in keys], pa.int64()),
                    pa.array([best[r, m][1] for r, m, _ in keys], pa.int64()),
                    pa.array([len(texts_[m]) for _, m, _ in keys], pa.int64()),
                ],
                names=[id_col, "item_id", "edits", "stop_byte", "item_bytes"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, item_id long, edits long, stop_byte long, item_bytes long"
    )


def item_blocks(benchmark: DataFrame, item_col: str, item_text_col: str, block_bytes: int):
    """Yield {item text: ids}, about ``block_bytes`` of distinct texts at a time."""
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.encode(F.col(item_text_col), "UTF-8").alias("t"))
    items = items.where(F.octet_length("t") > 0)
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = -(-total // block_bytes)
    for b in range(blocks):
        of: dict[bytes, list[int]] = {}
        for r in items.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == b).collect():
            of.setdefault(bytes(r["t"]), []).append(r["i"])
        if of:
            yield of


def drop_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    q: int = 10,
    rate: float = 0.08,
    block_bytes: int = 2 << 20,
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns, unshuffled."""
    at = docs.columns.index(text_col)
    for of in item_blocks(benchmark, item_col, item_text_col, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(sorted(of))

        def run(batches, sent=sent):
            find = _search(sent.value, q, rate)
            for batch in batches:
                clean = np.ones(len(batch), bool)
                clean[[r for r, _ in find(batch.column(at))]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    q: int = 10,
    rate: float = 0.08,
    block_bytes: int = 2 << 20,
) -> DataFrame:
    """One row per document and benchmark item found in it: fewest edits, where that
    passage ends (bytes from the start of the text) and the item's length."""
    empty = docs.select(id_col).where(F.lit(False)).selectExpr(
        f"`{id_col}`", "0L AS item_id", "0L AS edits", "0L AS stop_byte", "0L AS item_bytes"
    )
    found = []
    for of in item_blocks(benchmark, item_col, item_text_col, block_bytes):
        texts = sorted(of)
        ids = [sorted(of[t], key=lambda i: (i is None, i)) for t in texts]
        found.append(_scan_block(docs, texts, ids, id_col, text_col, q, rate))
    return functools.reduce(DataFrame.unionAll, found) if found else empty
