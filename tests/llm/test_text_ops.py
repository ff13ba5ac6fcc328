"""Operators on whole texts against brute force: bytes, lines, sets, licences, fingerprints, tokens."""

from __future__ import annotations

import base64

import pytest

from tests.llm import brute
from tests.llm.data import LONG, corpus, empty, frame

from stressframe.llm import bpe, jaccard, licences, lines, phrases, substring
from stressframe.llm.components import components


@pytest.mark.parametrize("kw", [{}, {"many": 2, "shard_size": 7}, {"window": 9, "inner": 4, "bucket_bytes": 4096, "shard_size": 50}])
def test_repeated_bytes(spark, kw):
    rows = corpus(2, 80)
    got = substring.dedup_substrings(frame(spark, rows, clash=True), **kw).collect()
    want = brute.repeated_bytes(rows, kw.get("window", 100))
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept))) for r in got} == want
    assert len(got) == len(rows)


def test_repeated_bytes_special(spark):
    text = "".join(chr(97 + (k * k * 7 + k // 3) % 26) for k in range(300))  # period 39
    rows = [(5, text), (5, text), (None, text), (9, None)]  # repeated rows lose nothing to each other
    got = sorted((r.doc_id or 99, r.n_removed) for r in substring.dedup_substrings(frame(spark, rows)).collect())
    assert got == [(5, 261), (5, 261), (9, 0), (99, 300)]
    assert substring.dedup_substrings(empty(spark)).collect() == []


def test_one_letter_text(spark):
    got = substring.dedup_substrings(frame(spark, [(1, "a" * 5000), (2, "a" * 99)])).collect()
    assert {r.doc_id: (r.n_removed, r.n_spans) for r in got} == {1: (4999, 1), 2: (0, 0)}


def test_line_dedup(spark):
    rows = corpus(3, 90)
    got = lines.dedup_lines(frame(spark, rows, clash=True)).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in got} == brute.line_dedup(rows)
    assert all(r.key == 7 for r in got)
    assert lines.dedup_lines(empty(spark)).collect() == []


def test_line_dedup_repeated_rows(spark):
    rows = [(1, "a long enough line\nx"), (1, "a long enough line\nx"), (None, " A LONG ENOUGH LINE \ny"), (4, None)]
    got = sorted((r.doc_id or 99, r.text, r.n_dropped) for r in lines.dedup_lines(frame(spark, rows)).collect())
    assert got == [(1, "a long enough line\nx", 0), (1, "a long enough line\nx", 0), (4, "", 0), (99, "y", 1)]


@pytest.mark.parametrize("kw", [{}, {"hot_least": 1, "hot_most": 50}, {"hot_least": 10**6}])
def test_jaccard_join(spark, kw):
    rows = corpus(4, 140)
    got = jaccard.link_near(frame(spark, rows, clash=True), **kw).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_components(rows)


@pytest.mark.parametrize("kw", [{}, {"block": 8, "hot_least": 1, "hot_most": 400}])
def test_jaccard_family_near_the_threshold(spark, kw):
    """Copies of one text with some edits each: few reach the threshold with the first copy."""
    import random

    from tests.llm.data import WORDS

    rng = random.Random(12)
    base = [rng.choice(WORDS) for _ in range(90)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randrange(0, 7)):
            at = rng.randrange(len(words))
            if rng.random() < 0.5:
                words[at] = rng.choice(WORDS) + rng.choice("abc")
            else:
                del words[at]
        rows.append((1000 - i, " ".join(words)))
    got = jaccard.link_near(frame(spark, rows), **kw).collect()
    want = brute.near_components(rows)
    assert len({c for _, c in want.values()}) > 3
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


@pytest.mark.parametrize("kw", [{}, {"hot_least": 1, "hot_most": 300}])
def test_jaccard_cut_copies(spark, kw):
    """Texts whose only near copy is the same text with its end cut off, just above the threshold."""
    rows = []
    for k in range(160):
        n, left = [(100, 86), (100, 88), (200, 171), (300, 256)][k % 4]
        words = [f"p{k}w{j}" for j in range(n + 3)]
        pair = [" ".join(words), " ".join(words[: left + 3])]
        rows += [(2 * k + j, t) for j, t in enumerate(pair[:: 1 if k % 3 else -1])]
    got = jaccard.link_near(frame(spark, rows), **kw).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i - i % 2 for i, _ in rows}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_components(rows)


def test_jaccard_chain_and_special(spark):
    words = [f"v{k}" for k in range(100)]
    rows = [(10 + k, " ".join(words[k * 2 :] + [f"z{k}{j}" for j in range(k * 2)])) for k in range(6)]
    rows += [(1, None), (2, ""), (3, "only three words"), (4, "ONLY three\twords"), (5, "three words only")]
    got = {r.doc_id: r.component_id for r in jaccard.link_near(frame(spark, rows)).collect()}
    assert got == {i: c for i, (_, c) in brute.near_components(rows).items()}
    assert got[4] == 3 and got[2] == 2
    again = jaccard.link_near(frame(spark, [(7, "a b c d e"), (7, "a b c d e"), (None, "a b c d e")])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in again) == [(0, 0), (7, 7), (7, 7)]
    assert jaccard.link_near(empty(spark)).collect() == []


def test_components_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 60)] + [(100, 101), (101, 102), (100, 102)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{k: 1 for k in range(1, 61)}, 100: 100, 101: 100, 102: 100}


MIT_REST = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED"
)
GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as "
    "published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)


def test_parts_of_licence_texts(spark):
    cc = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
    rows = [
        (1, "words before. " + MIT_REST + " and words behind", "mit"),
        (2, GNU.format("", 2), "gpl-2"),
        (3, GNU.format("", 3), "gpl-3"),
        (4, GNU.format("Affero ", 3), "agpl-3"),
        (5, GNU.format("Lesser ", "2.1").replace("program", "library"), "lgpl"),
        (6, cc.format(""), "cc-by"),
        (7, cc.format("-ShareAlike"), "cc-by-sa"),
        (8, cc.format("-NonCommercial"), "cc-by-nc"),
        (9, GNU.format("", 2) + " other words " * 20 + MIT_REST, "gpl-2,mit"),
        (10, "the software is a program and the authors of this work are free to use, copy and sell it", ""),
        (11, "Licensed under the GNU General Public License, version 2", "gpl-2"),
    ]
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    assert {k: r.labels for k, r in got.items()} == {r[0]: r[2] for r in rows}
    assert all(r.spans and r.score >= 0.6 for k, r in got.items() if k != 10)
    assert got[10].spans == [] and got[10].score < 0.6
    words = licences.words_of(rows[0][1])
    span = got[1].spans[0]
    assert " ".join(words[span.start : span.stop]) == " ".join(licences.words_of(MIT_REST))


def test_licences(spark):
    rows = corpus(5, 30) + [
        (1000, "x Released under the MIT License. y under THE mit\nlicense"),
        (1001, "Licensed under the Apache License, Version 2.0."),
        (1002, "CC BY-NC 4.0 and (cc) by nc"),
        (1003, "This work is licensed under the GNU General Public License, version 3."),
        (1004, "under the mit licenses"),
    ]
    got = {r.doc_id: r for r in licences.scan(frame(spark, rows, clash=True)).collect()}
    for i, t in rows:
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.licence_base(t, licences.PHRASES)
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
    assert got[1003].labels == "gpl-3" and got[1003].score == 1.0
    assert [s.label for s in got[1003].spans] == ["gpl-3"] and got[1003].spans[0].start == 0
    assert licences.scan(empty(spark)).collect() == []


def test_matching_statistics():
    model = licences.SuffixAutomaton()
    strings = [[1, 2, 3, 1, 2], [2, 2, 3], [3, 1, 4, 1, 2, 2]]
    for k, s in enumerate(strings):
        model.add(k, s)
    text = [1, 2, 3, 1, 2, 2, 3, 9, 4, 1, 2, 2, 3, 1, 4, 4, 3, 1, 4, 1, 2, 2, 2]
    for k, (_, n) in enumerate(model.stream(text)):
        want = max(
            (m for m in range(k + 2) for s in strings for at in range(len(s)) if s[at : at + m] == text[k + 1 - m : k + 1] and at + m <= len(s)),
            default=0,
        )
        assert n == want


def test_fingerprints(spark):
    rows = corpus(6, 60)
    got = {r.doc_id: r for r in phrases.fingerprint_next(frame(spark, rows, clash=True)).collect()}
    ordered = sorted(rows)
    seen: dict[str, str] = {}
    for (i, t), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        t, following, r = t or "", following or "", got[i]
        q = len(t) // 4
        assert r.n_chars == len(t)
        assert r.edited_sha256 == brute.sha((t[: len(t) - q] + following[:q]).encode())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert seen.setdefault(t, r.fingerprint) == r.fingerprint
    long = [got[i] for i, t in rows if t and len(t) > 1500 and len(set(t.split())) > 50]  # not one word again and again
    assert min(r.near_edited for r in long) > 0.3
    assert phrases.fingerprint_next(empty(spark)).collect() == []
    one = phrases.fingerprint_next(frame(spark, [(4, "abcdefgh")])).first()
    assert one.edited_sha256 == brute.sha(b"abcdefab") and one.near_next == 1.0


def test_phrases_do_not_depend_on_the_offset():
    body = LONG[:6000].encode()
    one, two = phrases.sketches([body, b"another beginning, " + body], 10**6)
    both = len(set(one.tolist()) & set(two.tolist()))
    assert both >= 0.95 * len(one)


def test_fingerprint_buckets(spark, monkeypatch):
    rows = corpus(7, 50)
    want = {r.doc_id: tuple(r) for r in phrases.fingerprint_next(frame(spark, rows)).collect()}
    monkeypatch.setattr(phrases, "ROWS_PER_BUCKET", 4)
    monkeypatch.setattr(phrases, "CHUNK_CHARS", 500)
    assert {r.doc_id: tuple(r) for r in phrases.fingerprint_next(frame(spark, rows)).collect()} == want


@pytest.fixture(scope="module")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    with open(public.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return public, tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_ranks(spark, tokenizer):
    public, reference = tokenizer
    path = public.path("byte_bpe_50k.tiktoken")
    rows = corpus(8, 40) + [(900, "<|endoftext|> it's 'LL"), (901, " " * 999 + "x"), (902, "\x00\x00 \x00"), (903, "👩‍👩‍👧é")]
    df = frame(spark, rows, clash=True)
    got = {r.doc_id: r for r in bpe.round_trip(df, path, public.PATTERN, with_ids=True).collect()}
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        assert got[i].ids == ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == brute.sha(" ".join(map(str, ids)).encode())
        assert got[i].decoded_sha256 == brute.sha((t or "").encode())
    coded = bpe.encode(df, path, public.PATTERN)
    back = {r.doc_id: r for r in bpe.decode(coded, path, public.PATTERN).collect()}
    assert all(back[i].text == (t or "") for i, t in rows)
    r = coded.where("doc_id = 903").first()
    text = dict(rows)[903]
    assert r.ids == reference.encode_ordinary(text) and r.starts[0] == 0 and r.ends[-1] == len(text)
    assert bpe.round_trip(empty(spark), path, public.PATTERN).collect() == []
    assert bpe.decode(empty(spark).selectExpr("doc_id", "array(1) AS ids"), path, public.PATTERN).collect() == []


def test_bpe_memo_and_runs_are_bounded(tokenizer, monkeypatch):
    public, reference = tokenizer
    monkeypatch.setattr(bpe, "MEMO_PIECES", 50)
    monkeypatch.setattr(bpe, "PIECES_AT_ONCE", 100)
    coder = bpe.ByteBpe(public.path("byte_bpe_50k.json"), public.PATTERN)
    ids = [i for run in coder.encode(LONG[:20_000]) for i in run]
    assert ids == reference.encode_ordinary(LONG[:20_000])
    texts = [t for _, t in corpus(9, 60)] + [LONG[:9_000], "  a  b", " x", "x ", "\n a", " ", "a\x1cb c", "a\x00b \x00"]
    for text, runs in zip(texts, coder.encode_many(texts), strict=True):
        ids = [i for run in runs for i in run]
        assert ids == reference.encode_ordinary(text or "") and coder.decode(ids) == (text or "").encode()


def test_ranks_give_the_merges(tokenizer):
    public, _ = tokenizer
    ids, merges = bpe.read_vocabulary(public.path("byte_bpe_50k.tiktoken"))
    same_ids, same_merges = bpe.read_vocabulary(public.path("byte_bpe_50k.json"))
    assert merges == same_merges and ids.items() <= same_ids.items()
