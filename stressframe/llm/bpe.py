"""Byte-level BPE encoding and decoding over Arrow batches (operator 10).

The text is cut by the published split pattern; each piece is encoded by the
``tokenizers`` library's BPE model on its byte-level alphabet (every byte is one
printable character), and pieces met before come from a bounded memo of two halves:
when the newer one is full it becomes the older one, and pieces still in use move on.
Pieces of several texts are learned together.  Decoding maps each id's characters back
through the reversed byte table and joins the *bytes*; a character that BPE split over
several ids is whole again after that.  The vocabulary comes from
a file of ranks or a tokenizer JSON; its merges are derived once, on the driver.

Results in special cases: null or empty text has no tokens; texts of any length
are encoded in bounded runs of pieces; unknown bytes do not exist (all 256 are
in the alphabet); equal rows give equal results; further columns are left alone.
"""

from __future__ import annotations

import base64
import hashlib
import json
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

PIECES_AT_ONCE = 40_000  # pieces held in memory before they are looked up
ROWS_AT_ONCE = 256  # rows whose ids wait in one output batch
MEMO_PIECES = 75_000  # pieces remembered in one task, and as many older ones
_SEP = "\x00"


def byte_alphabet() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    other bytes, in ascending order, for the characters from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    out = [""] * 256
    for b in own:
        out[b] = chr(b)
    for i, b in enumerate(rest):
        out[b] = chr(0x100 + i)
    return out


def _halves(ranks: dict[bytes, int], token: bytes, rank: int) -> tuple[bytes, bytes]:
    """The two tokens whose merge gives ``token``: its bytes merged by ranks below its own."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        best, at = min((ranks.get(parts[i] + parts[i + 1], rank), i) for i in range(len(parts) - 1))
        if best >= rank:
            raise ValueError(f"token of rank {rank} cannot be merged from lower ranks")
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


def read_vocabulary(path: str) -> tuple[dict[str, int], list[tuple[str, str]]]:
    """(ids of tokens, merges in order) in the byte-level alphabet.

    ``path``: a file of ranks (base64 token and rank a line) or a tokenizer JSON."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        return model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    alphabet = byte_alphabet()
    word = {t: "".join(map(alphabet.__getitem__, t)) for t in ranks}
    merges = [tuple(word[half] for half in _halves(ranks, t, r)) for t, r in sorted(ranks.items(), key=lambda x: x[1]) if len(t) > 1]
    return {word[t]: r for t, r in ranks.items()}, merges


class ByteBpe:
    """Encoder and decoder for one published vocabulary (``read_vocabulary``)."""

    def __init__(self, vocabulary, pattern: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        vocab, merges = read_vocabulary(vocabulary) if isinstance(vocabulary, str) else vocabulary
        cut = pre_tokenizers.Split(_SEP, behavior="removed")
        self.tokenizer = Tokenizer(models.BPE(vocab=vocab, merges=merges))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [cut, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.split = regex.compile(pattern)
        back = {c: b for b, c in enumerate(byte_alphabet())}
        size = max(vocab.values()) + 1
        self.token_bytes: list[bytes | None] = [None] * size  # None: not made of bytes (special tokens)
        for token, i in vocab.items():
            if all(c in back for c in token):
                self.token_bytes[i] = bytes(back[c] for c in token)
        self.decimal = [str(i) for i in range(size)]
        self.memo: dict[str, list[int]] = {}  # ids of pieces
        self.older: dict[str, list[int]] = {}

    def _ids(self, pieces: set[str]) -> dict[str, list[int]]:
        plain = [p for p in pieces if _SEP not in p]
        out: dict[str, list[int]] = {p: self._with_zero(p) for p in pieces.difference(plain)}  # the separator occurs in the piece
        if plain:
            enc = self.tokenizer.encode(_SEP.join(plain), add_special_tokens=False)
            found: list[list[int]] = [[] for _ in plain]
            for word, i in zip(enc.word_ids, enc.ids):
                found[word].append(i)
            out.update(zip(plain, found))
        return out

    def _learn(self, miss: set[str]) -> None:
        """Pieces seen a while ago come back from the older half of the memo, the others
        are encoded, all at once."""
        known = miss & self.older.keys()
        self.memo.update((p, self.older[p]) for p in known)
        if new := miss.difference(known):
            self.memo.update(self._ids(new))

    def _with_zero(self, piece: str) -> list[int]:
        """A piece that holds NUL: merged by rank from its bytes."""
        from tokenizers import pre_tokenizers

        mapped = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(piece)
        return [t.id for t in self.tokenizer.model.tokenize("".join(s for s, _ in mapped))]

    def _runs(self, text: str):
        """Lists of pieces that make up the text, one if it is not very long."""
        if len(text) <= PIECES_AT_ONCE:
            if text:
                yield self.split.findall(text)
            return
        found = (m.group() for m in self.split.finditer(text))
        while run := list(islice(found, PIECES_AT_ONCE)):
            yield run

    def _settle(self, waiting):
        """The ids of each waiting list of pieces; what is not known is learned at once."""
        if miss := set(chain.from_iterable(waiting)).difference(self.memo):
            if len(self.memo) > MEMO_PIECES:
                self.memo, self.older = {}, self.memo
                miss = set(chain.from_iterable(waiting))
            self._learn(miss)
        for run in waiting:
            yield list(chain.from_iterable(map(self.memo.__getitem__, run)))

    def encode(self, text: str | None):
        """Lists of ids, one list for each bounded run of pieces."""
        for run in self._runs(text or ""):
            yield from self._settle([run])

    def encode_many(self, texts):
        """``encode`` of every text, pieces of several texts learned together."""
        waiting, held = [], 0
        for text in texts:
            if text and len(text) > PIECES_AT_ONCE:
                yield from ([ids] for ids in self._settle(waiting))
                waiting, held = [], 0
                yield self.encode(text)
                continue
            waiting.append(self.split.findall(text) if text else [])
            held += len(waiting[-1])
            if held > PIECES_AT_ONCE:
                yield from ([ids] for ids in self._settle(waiting))
                waiting, held = [], 0
        yield from ([ids] for ids in self._settle(waiting))

    def offsets(self, text: str | None) -> list[tuple[int, int, int]]:
        """(id, first character, last character + 1) of every token.

        Token borders are byte positions; they are mapped to the characters
        whose bytes they touch, so tokens that split one character overlap."""
        raw = (text or "").encode("utf-8")
        char_of, k = [0] * (len(raw) + 1), -1
        for i, b in enumerate(raw):
            k += (b & 0xC0) != 0x80
            char_of[i] = k
        char_of[len(raw)] = k + 1
        out, at = [], 0
        for i in chain.from_iterable(self.encode(text)):
            end = at + len(self.token_bytes[i])
            out.append((i, char_of[at], char_of[end - 1] + 1))
            at = end
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))


def small_batches(batches):
    """The same rows, at most ``ROWS_AT_ONCE`` at a time."""
    for batch in batches:
        for at in range(0, len(batch), ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ids and character spans of its tokens."""
    vocabulary = read_vocabulary(path)

    def run(batches):
        bpe = ByteBpe(vocabulary, pattern)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = bpe.offsets(text.as_py())
                yield pa.RecordBatch.from_pydict(
                    {
                        id_col: pa.array([key], batch.schema.field(0).type),
                        "ids": pa.array([[r[0] for r in rows]], pa.list_(pa.int32())),
                        "starts": pa.array([[r[1] for r in rows]], pa.list_(pa.int32())),
                        "ends": pa.array([[r[2] for r in rows]], pa.list_(pa.int32())),
                    }
                )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, ids array<int>, starts array<int>, ends array<int>"
    )


def decode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per id list: its bytes (``raw``) and text (bytes that are no UTF-8 become U+FFFD)."""
    vocabulary = read_vocabulary(path)

    def run(batches):
        bpe = ByteBpe(vocabulary, pattern)
        for batch in batches:
            raw = [bpe.decode(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    id_col: batch.column(0),
                    "raw": pa.array(raw, pa.binary()),
                    "text": pa.array([r.decode("utf-8", "replace") for r in raw], pa.string()),
                }
            )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, raw binary, text string")


def round_trip(
    df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Encode, then decode the ids: token counts and digests of ids and bytes, one row per
    document; ``with_ids`` adds the ids themselves."""

    vocabulary = read_vocabulary(path)

    def code(batches):
        pa.default_memory_pool().release_unused()  # of what this worker ran before
        bpe = ByteBpe(vocabulary, pattern)
        for batch in small_batches(batches):
            n, h_ids, h_raw, all_ids = [], [], [], []
            for runs in bpe.encode_many(batch.column(1).to_pylist()):
                count, a, b, own = 0, hashlib.sha256(), hashlib.sha256(), []
                for ids in runs:
                    if ids:
                        a.update(((" " if count else "") + " ".join(map(bpe.decimal.__getitem__, ids))).encode())
                        b.update(bpe.decode(ids))
                        count += len(ids)
                        if with_ids:
                            own.append(np.array(ids, np.int32))
                n.append(count)
                h_ids.append(a.hexdigest())
                h_raw.append(b.hexdigest())
                all_ids.append(np.concatenate(own) if own else np.zeros(0, np.int32))
            columns = {
                id_col: batch.column(0),
                "n_tokens": pa.array(n, pa.int64()),
                "ids_sha256": pa.array(h_ids, pa.string()),
                "decoded_sha256": pa.array(h_raw, pa.string()),
            }
            if with_ids:
                columns["ids"] = pa.array(all_ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(
        code, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    )
