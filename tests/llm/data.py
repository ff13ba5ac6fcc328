"""Small random corpora with copies, shared passages and odd rows."""

from __future__ import annotations

import random

WORDS = [a + b for a in "ka mo ti se lu ra né öst ing the".split() for b in "na do ri ß st ve".split()]
LONG = " ".join(f"w{k % 977} x{k % 31}" for k in range(30_000))  # about 250 kB
ODD = [None, "", " ", "\n\n", "one", "two words", "a\x00b c", "ÄÖÜ ẞ 😀 é", "The " * 400]


def prose(rng: random.Random, n: int) -> str:
    out = []
    for k in range(n):
        out.append(rng.choice(WORDS))
        if rng.random() < 0.06:
            out[-1] += "."
        if rng.random() < 0.04:
            out[-1] += "\n"
    return " ".join(out).replace("\n ", "\n")


def corpus(seed: int = 1, n: int = 120) -> list[tuple]:
    """(id, text) with exact copies, near copies, shared passages and the odd rows."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randrange(5, 220)) for _ in range(n // 2)]
    passage = prose(rng, 40)
    texts = list(base)
    while len(texts) < n:
        t = rng.choice(base)
        kind = rng.randrange(4)
        if kind == 1:
            words = t.split(" ")
            for _ in range(rng.randrange(1, 5)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            t = " ".join(words)
        elif kind == 2:
            at = rng.randrange(len(t) + 1)
            t = t[:at] + " " + passage + " " + t[at:]
        elif kind == 3:
            t = prose(rng, 30) + "\n" + passage
        texts.append(t)
    texts += ODD + [LONG, LONG + " tail"]
    rng.shuffle(texts)
    return [(3 * i + 1, t) for i, t in enumerate(texts)]


#: Columns whose names the operators also use inside.
CLASH = "id int, doc int, key int, kind int, n int, a int, b int, _x int, _d int, _row int, n_lines int, score int, html2 int, lang string"


def frame(spark, rows, clash: bool = False):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    if clash:
        for c in CLASH.split(", "):
            name, kind = c.split(" ")
            df = df.selectExpr("*", f"CAST(7 AS {kind}) AS `{name}`")
    return df


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")
