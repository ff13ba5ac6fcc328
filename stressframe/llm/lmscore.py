"""Cross-entropy difference scores from two matched n-gram models (operator 4).

Both models are bigram models over one vocabulary, the words of all documents (A-Z
lower-cased), told apart by 64-bit hashes; so the models grow with the corpus. The
target model counts the documents labelled good, the background model counts *all*
documents; background counts are scaled to the target's total, so both models
smooth with the same weight of evidence. A document's score is the mean over its
words of (target loss - background loss), in nats: the lower, the more it is like
the target.

The texts are joined with the target ids once and written as slices of some MB. A
slice sends each distinct word and pair once, with its counts, to the bucket of its
key (63-bit hashes, cut into ranges), so a word or pair of any frequency is one entry
a slice. The buckets add the slices' entries and send the sums back to each of them
in the same order; a slice then scores its own texts. Blocks of keys and counts
travel compressed.

With ``word_bits`` and ``pair_bits`` the models are tables of fixed size instead,
over ``2**word_bits`` classes of words and ``2**pair_bits`` cells of bigrams.

Special cases: null or empty text has 0 words and losses and score 0.0; without
target documents the target model is the background model (score 0.0); rows with
equal ids are scored each by its text, equal texts score the same; a null id is never
a target; an empty table gives an empty result; texts are read whole, a very long one
as a slice of its own; other columns of the documents, whatever their names, are unused.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stressframe.llm.textvec import Roller, class_table, lower_table, mix, text_slices, word_spans
from stressframe.llm.vectors import stored

PIECE = 4096
SLICE_TEXT = 6 << 20  # bytes of text a slice is closed at
SLICE_ROWS = 1 << 16
BUCKET_TEXT = 8 << 20  # bytes of text whose keys make a bucket, on average
NOT_SPACE = ~class_table([(0x20, 0x20), (0x09, 0x0D)])


def classes(data, offsets, roller: Roller, lower, word_bits: int, pair_bits: int):
    """(row, word class, class before it, pair cell) of every word; the class before
    a document's first word is ``2**word_bits``."""
    data = lower[data]
    start, end, row = word_spans(data, offsets, NOT_SPACE)
    if not len(start):
        z = np.zeros(0, np.int64)
        return z, z, z, z
    roller.load(data)
    word = (roller.ranges(start, end) >> np.uint64(64 - word_bits)).astype(np.int64)
    before = np.empty_like(word)
    before[1:] = word[:-1]
    first = np.ones(len(row), bool)
    first[1:] = row[1:] != row[:-1]
    before[first] = 1 << word_bits
    cell = mix((before.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)) >> np.uint64(64 - pair_bits)
    return row, word, before, cell.astype(np.int64)


def count_tables(docs: DataFrame, text_col: str, target_col: str, word_bits: int, pair_bits: int) -> np.ndarray:
    """Summed counts, one array: words then pairs then document starts, of all documents, then of the target ones."""
    words, cells = 1 << word_bits, 1 << pair_bits
    length = words + cells + 1

    def count(batches):
        roller, lower = Roller(), lower_table()
        both = np.zeros((2, length), np.int64)
        for batch in batches:
            wanted = np.array([bool(x) for x in batch.column(1).to_pylist()])
            for first_row, data, offsets in text_slices(batch.column(0)):
                row, word, before, cell = classes(data, offsets, roller, lower, word_bits, pair_bits)
                good = wanted[first_row + row]
                for k, pick in ((0, slice(None)), (1, good)):
                    w, c = word[pick], cell[pick]
                    both[k, :words] += np.bincount(w, minlength=words)
                    both[k, words : words + cells] += np.bincount(c, minlength=cells)
                    both[k, -1] += np.count_nonzero(before[pick] == words)
        flat = both.ravel()
        for at in range(0, len(flat), PIECE):
            piece = flat[at : at + PIECE]
            if piece.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at // PIECE], pa.int32()), pa.array([piece.astype("<i8").tobytes()], pa.binary())], names=["piece", "counts"]
                )

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(raw, "<i8")
                sums[k] = sums[k] + part if k in sums else part
        for k, part in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["piece", "counts"]
            )

    parts = docs.select(text_col, target_col).mapInArrow(count, "piece int, counts binary")
    total = np.zeros(2 * length, np.int64)
    for r in parts.repartition("piece").mapInArrow(add, "piece int, counts binary").collect():  # fixed size
        part = np.frombuffer(r["counts"], "<i8")
        total[r["piece"] * PIECE : r["piece"] * PIECE + len(part)] += part
    return total.reshape(2, length)


class PairModel:
    """Bigram model with Dirichlet smoothing towards add-``alpha`` word frequencies."""

    def __init__(self, counts: np.ndarray, scale: float, word_bits: int, alpha: float, weight: float):
        words = 1 << word_bits
        c = counts.astype(np.float64) * scale
        self.context = np.append(c[:words], c[-1]) + weight
        self.word = (c[:words] + alpha) / (c[:words].sum() + alpha * words)
        self.pair, self.weight = c[words:-1], weight

    def loss(self, word, before, cell) -> np.ndarray:
        p = (self.pair[cell] + self.weight * self.word[word]) / self.context[before]
        return -np.log(np.minimum(p, 1.0))


def word_hashes(data, offsets, roller: Roller, lower):
    """(row, word hash, hash of the word before it or 0 at a document's start)."""
    data = lower[data]
    start, end, row = word_spans(data, offsets, NOT_SPACE)
    if not len(start):
        z = np.zeros(0, np.int64)
        return z, z, z
    roller.load(data)
    word = roller.ranges(start, end).view(np.int64)
    before = np.zeros_like(word)
    before[1:] = np.where(row[1:] == row[:-1], word[:-1], 0)
    return row, word, before


def document_slices(docs: DataFrame, kind: str, slice_text: int) -> DataFrame:
    """(ids, good, sizes, texts) of documents (id, target, text): neighbours as one row, texts joined and compressed."""

    def run(batches):
        held, size, rows = [], 0, 0

        def finish():
            ids, good, sizes, texts = zip(*held)
            sizes = np.concatenate(sizes)
            ends = [0, len(sizes)]
            lists = (pa.concat_arrays(ids), pa.concat_arrays(good), pa.array(sizes))
            columns = [pa.ListArray.from_arrays(ends, x) for x in lists]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array([pa.compress(b"".join(texts), codec="zstd", asbytes=True)], pa.binary())],
                names=["ids", "good", "sizes", "texts"],
            )

        for batch in batches:
            for first, data, offsets in text_slices(batch.column(2), min(slice_text, 1 << 20)):
                k = len(offsets) - 1
                held.append((batch.column(0).slice(first, k), batch.column(1).slice(first, k), np.diff(offsets), data.tobytes()))
                size, rows = size + len(data), rows + k
                if size >= slice_text or rows >= SLICE_ROWS:
                    yield finish()
                    held, size, rows = [], 0, 0
        if held:
            yield finish()

    return docs.mapInArrow(run, f"ids array<{kind}>, good array<boolean>, sizes array<long>, texts binary")


class SliceWords:
    """Words of a slice's texts: ``row``, key of the ``word``, of its context ``before`` and of the ``pair``.

    Word keys are even, pair keys odd; 0 is the start of a document."""

    def __init__(self, sizes: np.ndarray, texts: bytes, roller: Roller, lower):
        raw = pa.decompress(texts, int(sizes.sum()), codec="zstd", asbytes=True)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        column = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(raw))
        parts = []
        for first, data, offs in text_slices(column):
            row, word, before = word_hashes(data, offs, roller, lower)
            parts.append((first + row, word.view(np.uint64), before.view(np.uint64)))
        self.row, word, before = (np.concatenate(x) for x in zip(*parts))
        self.pair = mix(mix(before) + word) | np.uint64(1)
        self.word, self.before = word & ~np.uint64(1), before & ~np.uint64(1)

    def counts(self, good: np.ndarray):
        """Sorted distinct keys, their occurrences in all and in target documents."""
        every = np.concatenate([self.word, self.pair, self.before[self.before == 0]])
        mark = good[self.row]
        key, place, n = np.unique(every, return_inverse=True, return_counts=True)
        return key, n, np.bincount(place, np.concatenate([mark, mark, mark[self.before == 0]]), len(key)).astype(np.int64)


def to_block(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit numbers as one compressed block, byte by byte of their places."""
    flat = np.stack(columns).view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1)
    raw = np.ascontiguousarray(flat).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def from_block(block: bytes, columns: int) -> np.ndarray:
    raw = pa.decompress(block[8:], int.from_bytes(block[:8], "little"), codec="zstd", asbytes=True)
    flat = np.frombuffer(raw, np.uint8).reshape(columns, 8, -1).transpose(0, 2, 1)
    return np.ascontiguousarray(flat).view(np.int64)[..., 0]


def slice_counts(slices: DataFrame, buckets: int) -> DataFrame:
    """(bucket, slice, block): the keys of every slice in key ranges, with their counts."""

    def run(batches):
        roller, lower = Roller(), lower_table()
        for batch in batches:
            for at in range(len(batch)):
                good, sizes = (batch.column(k)[at].values.to_numpy(zero_copy_only=False) for k in (1, 2))
                key, n, marked = SliceWords(sizes, batch.column(3)[at].as_py(), roller, lower).counts(good)
                bucket = ((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                found, start = np.unique(bucket, return_index=True)
                blocks = []
                for a, z in zip(start, [*start[1:], len(key)]):
                    gaps = np.diff(key[a:z], prepend=np.uint64(0)).view(np.int64)
                    blocks.append(to_block(gaps, n[a:z].astype(np.int64), marked[a:z]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.astype(np.int64)), pa.array([batch.column(0)[at].as_py()] * len(found), pa.int64()), pa.array(blocks, pa.binary())],
                    names=["bucket", "slice", "block"],
                )

    return slices.select("slice", "good", "sizes", "texts").mapInArrow(run, "bucket long, slice long, block binary")


TOTALS = ("words", "all", "good", "starts", "good_starts")


def corpus_sums(counted: DataFrame) -> DataFrame:
    """(slice, bucket, block, totals): the corpus-wide counts of each slice's keys, in the slice's order;
    a bucket's totals stand in one of its rows."""

    def add(table):
        parts = [from_block(b.as_py(), 3) for b in table.column("block")]
        key = np.concatenate([np.cumsum(p[0].view(np.uint64)) for p in parts])
        key, place = np.unique(key, return_inverse=True)
        n, good = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        at, blocks = 0, []
        for p in parts:  # keys of one slice are distinct
            own = place[at : at + p.shape[1]]
            n[own] += p[1]
            good[own] += p[2]
            at += len(own)
        at = 0
        for p in parts:
            own = place[at : at + p.shape[1]]
            blocks.append(to_block(n[own], good[own]))
            at += len(own)
        start, word = key == 0, (key & np.uint64(1) == 0) & (key != 0)
        totals = [word.sum(), n[word].sum(), good[word].sum(), n[start].sum(), good[start].sum()]
        columns = {"slice": table.column("slice"), "bucket": table.column("bucket"), "block": pa.array(blocks, pa.binary())}
        columns |= {c: pa.array([int(x)] + [0] * (len(parts) - 1), pa.int64()) for c, x in zip(TOTALS, totals)}
        return pa.table(columns)

    shape = ", ".join(f"`{c}` long" for c in TOTALS)
    return counted.groupBy("bucket").applyInArrow(add, f"slice long, bucket long, block binary, {shape}")


def exact_scores(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, alpha: float, weight: float, slice_text: int) -> DataFrame:
    """``cross_entropy_difference`` over real words; ``ids``: one column ``_good``."""
    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # one plan at every size: a small id table would be broadcast, a large one shuffled
    marked = own.join(ids.hint("merge"), F.col("id") == F.col("_good"), "left").select("id", F.col("_good").isNotNull().alias("good"), "text")
    slices = document_slices(marked, kind, slice_text).withColumn("slice", F.monotonically_increasing_id())
    slices = stored(slices, "lmscore")  # the numbers of slices are those written
    size = slices.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    summed = stored(corpus_sums(slice_counts(slices, 1 + size // BUCKET_TEXT)), "lmscore-sums")
    total = summed.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TOTALS)).first().asDict()
    matched = total["good"] / total["all"] if total["good"] else 1.0

    def losses(count, k: int, scale: float, words: int, at_pair, at_word, at_before):
        own = count[k] * scale
        first = (own[at_word] + alpha) / (words * scale + alpha * max(1, total["words"]))
        return np.log(own[at_before] + weight) - np.log(own[at_pair] + weight * first)

    def score(key, found, rows):
        if not len(rows):
            return None
        docs_ids = rows.column("ids")[0].values
        good, sizes = (rows.column(c)[0].values.to_numpy(zero_copy_only=False) for c in ("good", "sizes"))
        text = SliceWords(sizes, rows.column("texts")[0].as_py(), Roller(), lower_table())
        keys, _, _ = text.counts(good)
        blocks = sorted(zip(found.column("bucket").to_pylist(), found.column("block")), key=lambda x: x[0])
        count = np.concatenate([np.zeros((2, 0), np.int64), *(from_block(b.as_py(), 2) for _, b in blocks)], axis=1)
        pair, at, place = np.unique(text.pair, return_index=True, return_inverse=True)
        places = [np.searchsorted(keys, x) for x in (pair, text.word[at], text.before[at])]
        n_words = np.bincount(text.row, minlength=len(sizes))
        target = (1, 1.0, total["good"]) if total["good"] else (0, 1.0, total["all"])
        means = []
        for model in (target, (0, matched, total["all"])):
            loss = losses(count, *model, *places)
            means.append(np.bincount(text.row, loss[place], len(sizes)) / np.maximum(n_words, 1))
        columns = [docs_ids, *(pa.array(x) for x in (n_words, means[0], means[1], means[0] - means[1]))]
        return pa.table(dict(zip(SCORE_COLUMNS, columns)))

    shape = f"id {kind}, n_words long, target_loss double, background_loss double, score double"
    scored = summed.groupBy("slice").cogroup(slices.groupBy("slice")).applyInArrow(score, shape)
    return scored.withColumnRenamed("id", id_col)


SCORE_COLUMNS = ("id", "n_words", "target_loss", "background_loss", "score")


def cross_entropy_difference(
    docs: DataFrame,
    target_ids: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    word_bits: int | None = None,
    pair_bits: int | None = None,
    alpha: float = 0.5,
    weight: float = 64.0,
    slice_text: int = SLICE_TEXT,
) -> DataFrame:
    """One row per document: n_words, target_loss, background_loss, score.

    ``target_ids``: ids (first column) of the documents the target model learns from."""
    ids = target_ids.select(F.col(target_ids.columns[0]).alias("_good")).where("_good IS NOT NULL").distinct()
    if word_bits is None or pair_bits is None:
        return exact_scores(docs, ids, id_col, text_col, alpha, weight, slice_text)
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # one plan at every size: a small id table would be broadcast, a large one shuffled
    marked = own.join(ids.hint("merge"), F.col("_id") == F.col("_good"), "left").select("_text", F.col("_good").isNotNull().alias("_target"))
    counts = count_tables(marked, "_text", "_target", word_bits, pair_bits)
    total_all, total_good = counts[0, : 1 << word_bits].sum(), counts[1, : 1 << word_bits].sum()
    matched = total_good / total_all if total_good else 1.0
    shipped = docs.sparkSession.sparkContext.broadcast((counts[1] if total_good else counts[0], counts[0]))

    def run(batches):
        good, everything = shipped.value
        target = PairModel(good, 1.0, word_bits, alpha, weight)
        background = PairModel(everything, float(matched), word_bits, alpha, weight)
        roller, lower = Roller(), lower_table()
        for batch in batches:
            n = len(batch)
            sums, words = np.zeros((2, n)), np.zeros(n, np.int64)
            for first_row, data, offsets in text_slices(batch.column(1)):
                row, word, before, cell = classes(data, offsets, roller, lower, word_bits, pair_bits)
                k = len(offsets) - 1
                words[first_row : first_row + k] = np.bincount(row, minlength=k)
                for j, model in enumerate((target, background)):
                    sums[j, first_row : first_row + k] = np.bincount(row, model.loss(word, before, cell), k)
            mean = sums / np.maximum(words, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), *(pa.array(x) for x in (mean[0], mean[1], mean[0] - mean[1]))],
                names=[id_col, "n_words", "target_loss", "background_loss", "score"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_words long, target_loss double, background_loss double, score double"
    )
