"""Token alignment against the two libraries on whole texts and nested loops."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from stressframe.llm import bpe, crosstok
from tests.llm.data import LONG, corpus, empty, frame

P = pytest.importorskip("public_tokenizers")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
NONE = (0, 0, 0, 0, 0, 0, "")


def brute(texts):
    """One tuple per text: n_a, n_b, n_groups, n_links, n_best, count_sum, digest."""
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    back = {c: i for i, c in enumerate(bpe.byte_alphabet())}
    token = {i: k for k, i in t.get_vocab().items()}
    found, count = [], Counter()
    for text in texts:
        found.append(None)
        if not text:
            continue
        a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        raw_a = [bytes(back[c] for c in token[i]) for i in a]
        raw_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in raw]).tolist() for raw in (raw_a, raw_b))
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = i, j
            while i < len(a) and ends_a[i] <= end:
                i += 1
            while j < len(b) and ends_b[j] <= end:
                j += 1
            groups.append((a[x:i], b[y:j]))
        links = Counter((p, q) for x, y in groups for p in x for q in y)
        count.update(links.keys())
        found[-1] = (len(a), len(b), groups, links)
    best: dict = {}
    for (p, _), n in count.items():
        best[p] = max(best.get(p, 0), n)
    out = []
    for f in found:
        if f is None:
            out.append(NONE)
            continue
        n_a, n_b, groups, links = f
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        n_best = sum(n for p, n in links.items() if count[p] == best[p[0]])
        total = sum(n * count[p] for p, n in links.items())
        out.append((n_a, n_b, len(groups), sum(links.values()), n_best, total, hashlib.sha256(told.encode()).hexdigest()))
    return out


SPACES = ["  two  spaces  ", " lead", "trail ", "a b c", "tab\t x", "x \ty", "\n\n a \n b", "a\x1c b \x85 c", "don't 's it 'll", "　 a  b"]
MARKS = ["<|endoftext|> <s> </s> <unk>", "a ▁ b", "▁", "a▁b c", "<0x41> <0x0A>", "\x00 \x00a", "😀 é ẞ ñ 日本語 한국어", "� x", "x" * 300, "1 22 333 4444"]


def aligned(df, **kw):
    return crosstok.align(df, A, B, **kw).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()


def test_alignment(spark):
    rows = corpus(21, 60)
    rows += [(1000 + k, t) for k, t in enumerate(SPACES + MARKS)]
    got = aligned(frame(spark, rows, clash=True))
    want = dict(zip((i for i, _ in rows), brute([t for _, t in rows])))
    assert {r.doc_id: tuple(r)[1:] for r in got} == want and len(got) == len(rows)
    assert want[1011] == NONE and want[1012] == NONE  # a text with U+2581 cannot be told from a space


def test_small_slices_and_memo(spark, monkeypatch):
    """Several slices a task, a memo that is forgotten, long texts in runs, a spoiled long text."""
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice(["alpha", "beta's", "γάμμα", "x9", "del-ta", "…"]) for _ in range(rng.randrange(60)))) for k in range(150)]
    rows += [(900, LONG[:9000]), (901, LONG[:5000] + " ▁"), (902, None)]
    want = dict(zip((i for i, _ in rows), brute([t for _, t in rows])))
    from pyspark import cloudpickle

    small = {"MEMO_PIECES": 40, "PIECES_AT_ONCE": 50, "SLICE_DOCS": 64, "SLICE_ENTRIES": 300, "WORDS": 1}
    for name, value in small.items():
        monkeypatch.setattr(crosstok, name, value)
    assert cloudpickle  # the module travels by value, with these settings
    got = aligned(frame(spark, rows))
    assert {r.doc_id: tuple(r)[1:] for r in got} == want and want[901] == NONE


def test_alignment_special(spark):
    rows = [(5, "same row"), (5, "same row"), (None, "same thing"), (7, ""), (8, None)]
    got = sorted(aligned(frame(spark, rows)), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    want = brute([t for _, t in rows])
    assert [tuple(r)[1:] for r in got] == [want[0], want[1], want[3], want[4], want[2]]  # every row is a document
    assert got[0].count_sum > got[0].n_links
    assert aligned(empty(spark)) == []


def test_planes_round_trip():
    rng = np.random.default_rng(8)
    key = np.unique(rng.integers(0, 50 * crosstok.SLICE_DOCS, 3000))
    n = rng.integers(1, 40, len(key))
    parts = crosstok.from_blob(crosstok.to_blob(crosstok.planes(key, n)))
    back: Counter = Counter()
    for k, word, mask in parts:
        for entry, doc in crosstok.documents_of(word, mask, at_once=100):
            for e, d in zip(entry.tolist(), doc.tolist()):
                back[int(word[e]) // crosstok.WORDS * crosstok.SLICE_DOCS + d] += 1 << k
    assert back == dict(zip(key.tolist(), n.tolist()))
    word, mask = crosstok.or_merged(parts)
    assert int(np.bitwise_count(mask).sum()) == len(key)
    assert crosstok.from_blob(crosstok.to_blob([])) == [] and len(crosstok.or_merged([])[0]) == 0
