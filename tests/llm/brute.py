"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def repeated_bytes(docs: list[tuple], window: int) -> dict:
    """{id: (n_bytes, n_removed, n_spans, kept sha)}; ids unique."""
    seen, out = set(), {}
    for i, text in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        b = (text or "").encode()
        runs: list[list[int]] = []
        for s in range(len(b) - window + 1):
            w = b[s : s + window]
            if w in seen:
                if runs and s <= runs[-1][1]:
                    runs[-1][1] = s + window
                else:
                    runs.append([s, s + window])
            seen.add(w)
        kept, at = b"", 0
        for a, z in runs:
            kept += b[at:a]
            at = z
        kept += b[at:]
        out[i] = (len(b), len(b) - len(kept), len(runs), sha(kept))
    return out


def edit_distance_within(text: str, item: str) -> int:
    """Fewest edits between the item and any substring of the text."""
    row = [0] * (len(text) + 1)
    for j, c in enumerate(item, 1):
        new = [j]
        for i, t in enumerate(text, 1):
            new.append(min(row[i - 1] + (c != t), row[i] + 1, new[-1] + 1))
        row = new
    return min(row)


def shingles(text: str | None, words: int = 4) -> set:
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))
    if not w:
        return set()
    return {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)}


def near_components(docs: list[tuple], percent: int = 85) -> dict:
    """{id: (set size, smallest id reached)}; ids unique and not null."""
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def line_dedup(docs: list[tuple]) -> dict:
    """{id: (n_lines, n_dropped, text left)}; ids unique and not null."""
    blank = " \t\n\x0b\x0c\r"
    split = {i: (t or "").split("\n") for i, t in docs}
    holders: dict[str, set] = {}
    for i, lines in split.items():
        for x in lines:
            key = x.strip(blank).translate(UP)
            if len(key) >= 10:
                holders.setdefault(key, set()).add(i)
    out = {}
    for i, lines in split.items():
        kept = [x for x in lines if not ((h := holders.get(x.strip(blank).translate(UP))) and len(h) > 1 and min(h) != i)]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def licence_base(text: str | None, phrases: dict[str, str]):
    """(n_words, n_base, first, last, labels)."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))
    hits, labels = [], set()
    for p, label in phrases.items():
        q = p.split()
        for k in range(len(w) - len(q) + 1):
            if w[k : k + len(q)] == q:
                hits.append(k)
                labels.add(label)
    return len(w), len(hits), min(hits, default=None), max(hits, default=None), ",".join(sorted(labels))


def word_counts(text: str | None) -> Counter:
    return Counter(re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP)))
