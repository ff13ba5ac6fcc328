"""Licence scan with a generalised suffix automaton of licence tokens (operator 5).

The automaton holds every token substring of the licence templates.  A
document's words are streamed through it; the matching statistic at a word is
the length of the longest template substring that ends there.  Maximal matches
of ``min_match`` words or more are chained, per template, in document and
template order; the words of the best chain are the covered span.  The model is
a few hundred words, the same for every table size, and travels with the task;
documents are scanned once, in place, with no shuffle.

Special cases: null or empty text has no words, no label and score 0; texts of
any length are scanned in one pass in memory bounded by the text; repeated rows
give equal results; an empty table gives an empty result; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stressframe.llm.textvec import SLICE_BYTES, Roller, class_table, lower_table, text_slices, word_spans

# Exact phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Notices and whole texts of public licences, by label.
TEMPLATES = [
    ("mit", "released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
            "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
            "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
            "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
            "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
            "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                 "compliance with the License. You may obtain a copy of the License at"),
    ("apache-2", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                 "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See "
                 "the License for the specific language governing permissions and limitations under the License"),
    ("apache-2", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, "
                 "worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare "
                 "Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such "
                 "Derivative Works in Source or Object form"),
    ("gpl-2", "licensed under the GNU General Public License, version 2"),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
              "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
              "option) any later version"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
              "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
              "option) any later version"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
             "your option) any later version"),
    ("agpl-3", "licensed under the GNU Affero General Public License, version 3"),
    ("agpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
               "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
               "your option) any later version"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
            "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
            "the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
            "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
            "DISCLAIMED"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("epl-2", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

WORD = class_table([(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)])


def words_of(text: str) -> list[str]:
    """Words of a text by the same rule as the scan (small inputs: templates, tests)."""
    raw = lower_table()[np.frombuffer(text.encode("utf-8"), np.uint8)]
    s, e, _ = word_spans(raw, np.array([0, len(raw)]), WORD)
    b = raw.tobytes()
    return [b[i:j].decode("utf-8") for i, j in zip(s, e)]


class SuffixAutomaton:
    """Generalised suffix automaton over integer token sequences.

    States are grown one token at a time; each keeps its longest length, suffix
    link, transitions and, per template, one place where its strings end."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, int]] = [{}]

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.ends.append({})
        return len(self.length) - 1

    def _split(self, p: int, token: int, q: int) -> int:
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, token: int) -> int:
        q = self.next[last].get(token)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, token, q)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][token]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, token, q)
        return new

    def add(self, template: int, tokens: list[int]) -> None:
        last = 0
        for token in tokens:
            last = self._extend(last, token)
        state = 0
        for end, token in enumerate(tokens, 1):
            state = self.next[state][token]
            s = state
            while s > 0 and template not in self.ends[s]:
                self.ends[s][template] = end
                s = self.link[s]

    def stream(self, tokens):
        """Matching statistics: (state, length of the longest match) after each token."""
        state = length = 0
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            step = self.next[state].get(token)
            if step is None:
                state = length = 0
            else:
                state, length = step, length + 1
            yield state, length


class LicenceModel:
    def __init__(self, phrases: dict[str, str], templates, min_match: int, min_cover: float, max_gap: int, long_run: int):
        self.min_match, self.min_cover, self.max_gap, self.long_run = min_match, min_cover, max_gap, long_run
        self.templates = [(label, words_of(text)) for label, text in templates]
        self.phrases = [(words_of(p), label) for p, label in phrases.items()]
        vocabulary = sorted({w for _, ws in self.templates for w in ws} | {w for ws, _ in self.phrases for w in ws})
        self.id_of = {w: i for i, w in enumerate(vocabulary)}
        self.automaton = SuffixAutomaton()
        for k, (_, ws) in enumerate(self.templates):
            self.automaton.add(k, [self.id_of[w] for w in ws])
        for j, (ws, _) in enumerate(self.phrases):
            self.automaton.add(len(self.templates) + j, [self.id_of[w] for w in ws])
        self.phrase_ids = [[self.id_of[w] for w in ws] for ws, _ in self.phrases]
        self.shortest = min([min_match, *(len(p) for p in self.phrase_ids)])
        self.roller = Roller()
        raw = [w.encode() for w in vocabulary]
        data = np.frombuffer(b"".join(raw), np.uint8)
        offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        self.roller.load(data)
        keys = self.roller.ranges(offs[:-1], offs[1:])
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], order

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary number of each word hash, -1 for other words."""
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.key_ids[at], -1)

    def scan_run(self, first: int, ids: list[int], bases: list, matches: list) -> None:
        """Stream one run of template words: exact phrases and maximal matches."""
        before = (0, 0)
        for k, now in enumerate(self.automaton.stream(ids)):
            if now[1] >= self.shortest:
                for j, p in enumerate(self.phrase_ids):
                    if now[1] >= len(p) and ids[k + 1 - len(p) : k + 1] == p:
                        bases.append((first + k + 1 - len(p), j))
            if now[1] <= before[1] and before[1] >= self.min_match:
                matches.append((first + k - before[1], before[1], before[0]))
            before = now
        if before[1] >= self.min_match:
            matches.append((first + len(ids) - before[1], before[1], before[0]))

    def chain(self, matches: list):
        """Per template: (covered share, first word, last word + 1, covered words) of its best chain."""
        out = {}
        for k, (_, ws) in enumerate(self.templates):
            pieces = [(s, n, e[k] - n) for s, n, state in matches if k in (e := self.automaton.ends[state])]
            best: list[tuple[int, int]] = []  # words covered by the chain that ends in a piece, its first word
            for i, (s, n, t) in enumerate(pieces):
                top = (n, s)
                for j in range(i - 1, -1, -1):
                    ps, pn, pt = pieces[j]
                    if s - ps - pn > self.max_gap:
                        break
                    over = max(0, ps + pn - s, pt + pn - t)
                    if pt < t and over < n:
                        top = max(top, (best[j][0] + n - over, best[j][1]), key=lambda x: x[0])
                best.append(top)
            if best:
                i = max(range(len(best)), key=lambda i: best[i][0])
                out[k] = (min(1.0, best[i][0] / len(ws)), best[i][1], pieces[i][0] + pieces[i][1], best[i][0])
        return out

    def accept(self, chains: dict) -> dict:
        """Chains that tell a licence: ``min_cover`` of a template, or ``long_run`` words of one
        that fill ``min_cover`` of their span (a part of a licence's text).  Licences
        share sentences: of chains of different labels over the same words the one that
        covers most words counts; labels that cover as many all count."""
        good = {
            k: c for k, c in chains.items()
            if c[0] >= self.min_cover or (c[3] >= self.long_run and c[3] >= self.min_cover * (c[2] - c[1]))
        }

        def told_better(k, c):
            for j, d in good.items():
                same = min(c[2], d[2]) - max(c[1], d[1])
                if self.templates[j][0] != self.templates[k][0] and d[3] > c[3] and 2 * same >= c[2] - c[1]:
                    return True
            return False

        return {k: c for k, c in good.items() if not told_better(k, c)}


def _flags_runs(ids: np.ndarray, row: np.ndarray, shortest: int):
    """Runs of at least ``shortest`` template words inside one row: (first, last + 1)."""
    hit = ids >= 0
    if not hit.any():
        return []
    edge = np.ones(len(ids) + 1, bool)
    edge[1:-1] = (hit[1:] != hit[:-1]) | (row[1:] != row[:-1])
    cut = np.flatnonzero(edge)
    a, b = cut[:-1], cut[1:]
    keep = hit[a] & (b - a >= shortest)
    return list(zip(a[keep].tolist(), b[keep].tolist()))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, str] | None = None,
    templates=None,
    min_match: int = 5,
    min_cover: float = 0.6,
    max_gap: int = 12,
    long_run: int = 20,
) -> DataFrame:
    """One row per document: n_words, base hits, labels, covered spans and score.

    A template whose best chain covers ``min_cover`` of its words, or at least ``long_run``
    of them in a span that it fills to ``min_cover``, adds its label, unless another
    licence covers more words there.  The score is 1 with a base phrase, else the largest
    share of a template or, for a long run, of its span that is covered.
    ``spans`` lists (label, first word, last word + 1, covered share)."""
    phrases, templates = phrases or PHRASES, templates or TEMPLATES

    def run(batches):
        model = LicenceModel(phrases, templates, min_match, min_cover, max_gap, long_run)
        lower = lower_table()
        for batch in batches:
            n = len(batch)
            words = np.zeros(n, np.int64)
            found: dict[int, tuple[list, list]] = {}
            for first_row, data, offsets in text_slices(batch.column(1), SLICE_BYTES):
                data = lower[data]
                start, end, row = word_spans(data, offsets, WORD)
                words[first_row : first_row + len(offsets) - 1] = np.bincount(row, minlength=len(offsets) - 1)
                if not len(start):
                    continue
                model.roller.load(data)
                ids = model.word_ids(model.roller.ranges(start, end))
                base = np.searchsorted(row, np.arange(len(offsets) - 1))
                for a, b in _flags_runs(ids, row, model.shortest):
                    r = int(row[a])
                    bases, matches = found.setdefault(first_row + r, ([], []))
                    model.scan_run(a - int(base[r]), ids[a:b].tolist(), bases, matches)
            out = {k: [] for k in ("n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")}
            for r in range(n):
                bases, matches = found.get(r, ([], []))
                chains = model.chain(matches)
                own = {model.phrases[j][1] for _, j in bases}
                good = model.accept(chains)
                out["n_base"].append(len(bases))
                out["first_word"].append(min((b[0] for b in bases), default=None))
                out["last_word"].append(max((b[0] for b in bases), default=None))
                out["base_labels"].append(",".join(sorted(own)))
                out["labels"].append(",".join(sorted(own | {model.templates[k][0] for k in good})))
                shares = [max(c[0], c[3] / (c[2] - c[1]) if c[3] >= long_run else 0.0) for c in chains.values()]
                out["score"].append(1.0 if bases else min(1.0, max(shares, default=0.0)))
                out["spans"].append([{"label": model.templates[k][0], "start": s, "stop": e, "cover": c} for k, (c, s, e, _) in sorted(good.items())])
            span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("cover", pa.float64())]))
            yield pa.RecordBatch.from_pydict(
                {
                    id_col: batch.column(0),
                    "n_words": pa.array(words, pa.int64()),
                    "n_base": pa.array(out["n_base"], pa.int64()),
                    "first_word": pa.array(out["first_word"], pa.int64()),
                    "last_word": pa.array(out["last_word"], pa.int64()),
                    "base_labels": pa.array(out["base_labels"], pa.string()),
                    "labels": pa.array(out["labels"], pa.string()),
                    "score": pa.array(out["score"], pa.float64()),
                    "spans": pa.array(out["spans"], span),
                }
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run,
        f"`{id_col}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, spans array<struct<label:string,start:long,stop:long,cover:double>>",
    )
