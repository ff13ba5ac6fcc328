"""Alignment of two tokenizers' tokens with corpus-wide pair counts (operator 13).

Both token sequences of a text cover the same bytes; the byte offsets where tokens of
both end cut them into groups, and every occurrence pair inside a group is a link.
Per slice of documents the links become an inverted index: for each pair of ids its
*multiplicity planes*, compressed bitmaps over the slice's documents (plane k holds the
documents whose number of links of the pair has bit k; only 64-bit words that are not
zero are stored).  The planes OR-merged are the documents that hold the pair; their
population counts, summed over slices, are the pair's corpus-wide count.  The counts
meet the slices' postings again, which return to each document the sum over its links
and the number of links that are best for their first id.

Tokens come by pieces: a text is cut where one space stands between two characters that
are not white space.  Neither tokenizer joins tokens across such a place (byte-level
pieces start there, and no piece of the other vocabulary has a space after another
character, which is checked), so a piece's tokens do not depend on its neighbours and
pieces met before come from a bounded memo.

The heavy pass runs once and writes one row per slice; texts are not shuffled, ids meet
as (slice, pair, count) rows and the postings move once to meet them.

Results in special cases: a null or empty text, or one whose joined token bytes differ
from space + text on either side, has no tokens (zeros and an empty digest); every row
is a document of its own, rows with equal or null ids too; texts of any length are read
piece by piece; of best ids with equal counts all are best; an empty table gives an
empty result.  Only the named columns are read, so others may clash; ids of any type.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stressframe.llm.bpe import byte_alphabet
from stressframe.llm.vectors import stored

MEMO_PIECES = 300_000  # pieces remembered in one task
PIECES_AT_ONCE = 100_000  # pieces held at once
SLICE_DOCS = 16_384  # documents of a slice
SLICE_ENTRIES = 3_000_000  # (document, pair) entries of a slice, unless one document has more
_CUT = re.compile(r"(?<=\S) (?=\S)")
_NEAR_SPACE = re.compile(r" \s|\s ")


def pieces(text: str):
    """Lists of pieces of a text, at most ``PIECES_AT_ONCE`` at a time."""
    if len(text) <= 4 * PIECES_AT_ONCE:
        plain = not text[0].isspace() and not text[-1].isspace() and not _NEAR_SPACE.search(text)
        yield text.split(" ") if plain else _CUT.split(text)
        return

    def cut():
        at = 0
        for m in _CUT.finditer(text):
            yield text[at : m.start()]
            at = m.end()
        yield text[at:]

    found = cut()
    while run := list(islice(found, PIECES_AT_ONCE)):
        yield run


class PairAligner:
    """Tokens, groups and links of pieces under both tokenizers."""

    def __init__(self, byte_json: str, piece_model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        back = {c: bytes([i]) for i, c in enumerate(byte_alphabet())}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = b"".join(back.get(c, c.encode()) for c in token)
        self.b_bytes = [self._piece_bytes(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())):
            raise ValueError("the vocabulary has pieces that reach over a space")
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        self.a_text = [np.array([f"{i}{mark}" for i in range(len(self.a_bytes))], object) for mark in ",|"]
        self.b_text = [np.array([f"{i}{mark}" for i in range(len(self.b_bytes))], object) for mark in ",;"]
        self.ranked = self._ranked(byte_json, back)
        self.width = len(self.b_bytes)
        self._forget()

    @staticmethod
    def _ranked(byte_json: str, back: dict):
        """An encoder by ranks for the same vocabulary, if its merges are in the order of its ids."""
        import public_tokenizers
        import tiktoken

        with open(byte_json, encoding="utf-8") as f:
            described = json.load(f)
        model, cut = described["model"], described["pre_tokenizer"]
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        plain = described["normalizer"] is None and cut.get("use_regex") and not cut.get("add_prefix_space")
        if not plain or cut["type"] != "ByteLevel" or merged != list(range(256, 256 + len(merged))):
            return None
        special = {t["content"] for t in described["added_tokens"]}
        ranks = {b"".join(back[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _piece_bytes(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        return b"" if self.b.is_control(i) or self.b.is_unknown(i) else self.b.id_to_piece(i).replace("▁", " ").encode()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.digests: list[str] = []
        self.numbers = np.zeros((0, 4), np.int64)  # tokens a, tokens b, groups, links; -1: bytes differ
        self.first = np.zeros(1, np.int64)  # of each piece in pairs
        self.pairs = np.zeros(0, np.int64)  # a * width + b

    def lookup(self, run: list[str]) -> np.ndarray:
        """Numbers of the pieces in the memo's tables."""
        if len(self.memo) > MEMO_PIECES:
            self._forget()
        if miss := list(set(run).difference(self.memo)):
            self._learn(miss)
        return np.fromiter(map(self.memo.__getitem__, run), np.int64, len(run))

    def _ids_a(self, new: list[str]) -> list[list[int]]:
        """Byte-level ids of space + piece.  ASCII pieces take the faster library, when the
        vocabulary's merges are in the order of its ids; both read ASCII classes alike."""
        if self.ranked is None:
            return [e.ids for e in self.a.encode_batch_fast([" " + p for p in new], add_special_tokens=False)]
        out = [self.ranked(" " + p) if p.isascii() else None for p in new]
        rest = [k for k, x in enumerate(out) if x is None]
        for k, e in zip(rest, self.a.encode_batch_fast([" " + new[k] for k in rest], add_special_tokens=False)):
            out[k] = e.ids
        return out

    def _learn(self, new: list[str]) -> None:
        ids_a, ids_b = self._ids_a(new), self.b.encode(new, num_threads=1)
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(new)) for ids in (ids_a, ids_b))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())) for ids, n in ((ids_a, n_a), (ids_b, n_b)))
        raw = [b" " + p.encode() for p in new]
        sizes = np.fromiter(map(len, raw), np.int64, len(new))
        piece_a, piece_b = np.repeat(np.arange(len(new)), n_a), np.repeat(np.arange(len(new)), n_b)
        fine = (_sums(piece_a, self.a_len[a], len(new)) == sizes) & (_sums(piece_b, self.b_len[b], len(new)) == sizes)
        joined = b"".join(raw)
        if not (fine.all() and joined == self._join(self.a_bytes, a) == self._join(self.b_bytes, b)):
            for k, (x, y) in enumerate(zip(ids_a, ids_b)):
                fine[k] = self._join(self.a_bytes, x) == self._join(self.b_bytes, y) == raw[k]
            a, b = a[fine[piece_a]], b[fine[piece_b]]
            piece_a = piece_a[fine[piece_a]]
            n_a, n_b = n_a * fine, n_b * fine
        end_a, end_b = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        at = np.searchsorted(end_b, end_a)
        ends = end_a[end_b[np.minimum(at, len(end_b) - 1)] == end_a] if len(end_b) else end_a
        group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
        size_a, size_b = np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends))
        first_b = np.cumsum(size_b) - size_b
        times = size_b[group_a]  # links of each token of a
        k = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        pair = np.repeat(a, times) * self.width + b[np.repeat(first_b[group_a], times) + k]
        last_a, last_b = np.cumsum(size_a) - 1, np.cumsum(size_b) - 1
        piece_of = piece_a[last_a]  # piece of each group
        n_groups = np.bincount(piece_of, minlength=len(new))
        n_links = _sums(piece_of, size_a * size_b, len(new))
        table = np.stack([n_a, n_b, n_groups, n_links], 1)
        table[~fine] = -1
        base = len(self.digests)
        self.memo.update(zip(new, range(base, base + len(new))))
        self.numbers = np.concatenate([self.numbers, table])
        self.first = np.r_[self.first, self.first[-1] + np.cumsum(n_links)]
        self.pairs = np.concatenate([self.pairs, pair])
        # digests: every id with the mark behind it, in the order of groups, cut at pieces
        told_a, told_b = self.a_text[0][a], self.b_text[0][b]
        told_a[last_a], told_b[last_b] = self.a_text[1][a[last_a]], self.b_text[1][b[last_b]]
        order = np.argsort(np.r_[2 * group_a, 2 * group_b + 1], kind="stable")
        told = np.r_[told_a, told_b][order].tolist()
        width = np.fromiter(map(len, told), np.int64, len(told))
        stop = np.cumsum(_sums(np.r_[piece_a, np.repeat(np.arange(len(new)), n_b)][order], width, len(new))).tolist()
        whole, start = "".join(told), 0
        for end in stop:
            self.digests.append(whole[start : end - 1] if end > start else "")
            start = end

    @staticmethod
    def _join(table: list[bytes], ids) -> bytes:
        return b"".join(map(table.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))

    def count(self, number: np.ndarray, doc: np.ndarray):
        """((document, pair) keys pair-major, multiplicities) of pieces ``number`` in documents ``doc``."""
        key, times = np.unique(doc * len(self.digests) + number, return_counts=True)
        doc, number = np.divmod(key, len(self.digests))
        links = self.first[number + 1] - self.first[number]
        k = np.arange(links.sum()) - np.repeat(np.cumsum(links) - links, links)
        pair = self.pairs[np.repeat(self.first[number], links) + k]
        return sum_by_key(pair * SLICE_DOCS + np.repeat(doc, links), np.repeat(times, links))


def sum_by_key(key: np.ndarray, n: np.ndarray):
    """Sorted distinct keys and the sums of ``n``."""
    if not len(key):
        return key, n
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[start], np.add.reduceat(n, start)


def planes(key: np.ndarray, n: np.ndarray):
    """(plane, pair, word, mask) of multiplicities ``n`` at pair-major keys of (pair, document)."""
    out = []
    for k in range(int(n.max(initial=0)).bit_length()):
        at = key[(n >> k) & 1 == 1]
        if len(at):
            word = at >> 6  # SLICE_DOCS is a multiple of 64: pair * words + word of the document
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            mask = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), start)
            out.append((k, word[start], mask))
    return out


WORDS = SLICE_DOCS // 64


def to_blob(parts) -> bytes:
    """Planes as one compressed block: head (planes, plane and length of each), word gaps, masks."""
    head = np.array([len(parts), *(x for k, w, _ in parts for x in (k, len(w)))], np.int64).tobytes()
    body = b"".join(np.diff(w, prepend=0).tobytes() + m.tobytes() for _, w, m in parts)
    raw = head + body
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def from_blob(blob: bytes):
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 2 * n, 8).reshape(-1, 2)
    at, out = 8 + 16 * n, []
    for k, size in head.tolist():
        word = np.cumsum(np.frombuffer(raw, np.int64, size, at))
        out.append((k, word, np.frombuffer(raw, np.uint64, size, at + 8 * size)))
        at += 16 * size
    return out


def or_merged(parts):
    """Words and masks of the documents that hold each pair: all planes ORed."""
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = np.concatenate([w for _, w, _ in parts])
    mask = np.concatenate([m for _, _, m in parts])
    order = np.argsort(word, kind="stable")
    word, mask = word[order], mask[order]
    start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    return word[start], np.bitwise_or.reduceat(mask, start)


def documents_of(word: np.ndarray, mask: np.ndarray, at_once: int = 1 << 16):
    """(entry, document) of all set bits, in blocks."""
    for s in range(0, len(word), at_once):
        m = mask[s : s + at_once]
        bits = np.unpackbits(np.ascontiguousarray(m).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        entry, bit = np.nonzero(bits)
        yield s + entry, (word[s + entry] % WORDS) * 64 + bit


DOC_FIELDS = ("n_a", "n_b", "n_groups", "n_links")


class Slice:
    """Documents of one slice while their pieces are looked up and counted."""

    def __init__(self, aligner: PairAligner):
        self.aligner = aligner
        self.waiting: list = []  # (document, pieces)
        self.held = 0
        self.begin()

    def begin(self) -> None:
        self.ids, self.totals, self.digests, self.fine = [], [], [], []
        self.keys, self.times, self.entries = [], [], 0

    def add(self, key, text: str | None) -> None:
        doc = len(self.ids)
        self.ids.append(key)
        self.totals.append(np.zeros(4, np.int64))
        self.digests.append(None)
        self.fine.append(bool(text))
        for run in pieces(text) if text else ():
            self.waiting.append((doc, run))
            self.held += len(run)
            if self.held > PIECES_AT_ONCE:
                self.settle()

    def settle(self) -> None:
        """Look up and count the waiting pieces, all at once."""
        if not self.waiting:
            return
        sizes = np.array([len(run) for _, run in self.waiting], np.int64)
        number = self.aligner.lookup([p for _, run in self.waiting for p in run])
        doc = np.repeat(np.array([d for d, _ in self.waiting], np.int64), sizes)
        table = self.aligner.numbers[number]
        start = np.cumsum(sizes) - sizes
        for d in set(doc[table[:, 0] < 0].tolist()):
            self.fine[d] = False
        sums = np.add.reduceat(table, start)
        told = list(map(self.aligner.digests.__getitem__, number.tolist()))
        for (d, _), at, n, own in zip(self.waiting, start.tolist(), sizes.tolist(), sums):
            part = ";".join(told[at : at + n]).encode()
            if self.digests[d] is None:
                self.digests[d] = hashlib.sha256(part)
            else:
                self.digests[d].update(b";" + part)
            self.totals[d] += own
        key, n = self.aligner.count(number, doc)
        self.keys.append(key)
        self.times.append(n)
        self.entries += len(key)
        if self.entries > 2 * SLICE_ENTRIES:  # one long document: its runs share pairs
            self.merge()
        self.waiting.clear()
        self.held = 0

    def merge(self) -> None:
        if self.keys:
            key, n = sum_by_key(np.concatenate(self.keys), np.concatenate(self.times))
            self.keys, self.times, self.entries = [key], [n], len(key)

    def full(self) -> bool:
        return len(self.ids) == SLICE_DOCS or self.entries > SLICE_ENTRIES

    def finish(self, id_col: str, id_type) -> pa.RecordBatch:
        """The slice as one row; the next one begins."""
        self.settle()
        self.merge()
        key, n = (self.keys[0], self.times[0]) if self.keys else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        fine = np.array(self.fine, bool)
        if not fine.all():
            kept = fine[key % SLICE_DOCS]
            key, n = key[kept], n[kept]
        number = np.where(fine[:, None], np.array(self.totals), 0)
        columns = {id_col: pa.array([self.ids], pa.list_(id_type))}
        columns |= {c: pa.array([number[:, k].tolist()], pa.list_(pa.int64())) for k, c in enumerate(DOC_FIELDS)}
        told = [d.hexdigest() if ok else "" for d, ok in zip(self.digests, self.fine)]
        columns["groups_sha256"] = pa.array([told], pa.list_(pa.string()))
        columns["blob"] = pa.array([to_blob(planes(key, n))], pa.binary())
        self.begin()
        return pa.RecordBatch.from_pydict(columns)


def slices(df: DataFrame, byte_json: str, piece_model: str, id_col: str, text_col: str) -> DataFrame:
    """One row per slice of documents: their own numbers and digests, and the postings."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        part = Slice(PairAligner(byte_json, piece_model))
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                part.add(key, text.as_py())
                if part.full():
                    yield part.finish(id_col, batch.schema.field(0).type)
        if part.ids:
            yield part.finish(id_col, batch.schema.field(0).type)

    lists = ", ".join(f"{c} array<long>" for c in DOC_FIELDS)
    found = df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` array<{kind}>, {lists}, groups_sha256 array<string>, blob binary")
    return found.withColumn("slice", F.monotonically_increasing_id())


def pair_counts(posted: DataFrame) -> DataFrame:
    """(slice, pair, n): documents of every slice that hold the pair, by OR-merge and population count."""

    def run(batches):
        for batch in batches:
            for s, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                word, mask = or_merged(from_blob(blob.as_py()))
                pair, start = np.unique(word // WORDS, return_index=True)
                n = np.add.reduceat(np.bitwise_count(mask).astype(np.int64), start) if len(pair) else start
                for at in range(0, len(pair), 1 << 16):
                    p = pair[at : at + (1 << 16)]
                    yield pa.RecordBatch.from_pydict(
                        {"slice": pa.array(np.full(len(p), s), pa.int64()), "pair": pa.array(p, pa.int64()), "n": pa.array(n[at : at + (1 << 16)], pa.int64())}
                    )

    return posted.select("slice", "blob").mapInArrow(run, "slice long, pair long, n long")


def corpus_counts(counted: DataFrame, width: int) -> DataFrame:
    """(pair, count, best): corpus-wide documents, and whether no pair of the first id has more."""
    total = counted.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("a", F.expr(f"pair div {width}"))
    most = total.groupBy("a").agg(F.max("count").alias("most"))
    return total.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align(df: DataFrame, byte_json: str, piece_model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    kind = df.schema[id_col].dataType.simpleString()
    width = _width(piece_model)
    posted = stored(slices(df, byte_json, piece_model, id_col, text_col), "crosstok")
    counted = stored(pair_counts(posted), "crosstok-pairs")
    back = counted.select("slice", "pair").join(corpus_counts(counted, width), "pair")
    names = [id_col, *DOC_FIELDS, "n_best", "count_sum", "groups_sha256"]

    def score(key, counts, rows):
        if not len(rows):
            return None
        docs = rows.column(id_col)[0].values
        best, total = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
        pair = counts.column("pair").to_numpy()
        order = np.argsort(pair)
        pair, count = pair[order], counts.column("count").to_numpy()[order]
        is_best = counts.column("best").to_numpy()[order].astype(np.int64)
        for k, word, mask in from_blob(rows.column("blob")[0].as_py()):
            at = np.searchsorted(pair, word // WORDS)
            for entry, doc in documents_of(word, mask):
                total += _sums(doc, count[at[entry]], len(docs)) << k
                best += _sums(doc, is_best[at[entry]], len(docs)) << k
        columns = [docs, *(rows.column(c)[0].values for c in DOC_FIELDS), pa.array(best), pa.array(total), rows.column("groups_sha256")[0].values]
        return pa.table(dict(zip(names, columns)))

    shape = f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in names[1:-1]) + ", groups_sha256 string"
    return back.groupBy("slice").cogroup(posted.groupBy("slice")).applyInArrow(score, shape)


def _sums(doc: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """Exact sums of ``n`` per document."""
    out = np.zeros(size, np.int64)
    np.add.at(out, doc, n)
    return out


def _width(piece_model: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_model).get_piece_size()
