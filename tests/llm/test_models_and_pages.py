"""Quality ranking, decontamination, language-model scores, page text."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm import brute
from tests.llm.data import corpus, empty, frame, prose

from stressframe.llm import decontam, lmscore, pages, quality
from stressframe.session import cut_lineage


def test_quality_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.rate(docs, labels).join(labels, "doc_id").where("held_out").select("predicted", "quality").collect()
    assert len(got) > 50 and sum(r.predicted == r.quality for r in got) >= 0.97 * len(got)


def test_quality_special(spark):
    rows = corpus(9, 40)
    labels = spark.createDataFrame([(i, k % 2, 0) for k, (i, _) in enumerate(rows)] + [(10**6, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark, [*rows, rows[0], (None, "x")], clash=True)
    got = quality.rate(docs, labels).collect()
    assert len(got) == len(rows) + 2 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    import zlib

    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    one_class = quality.rate(docs, labels.where("quality = 1")).collect()
    assert {(r.score, r.predicted) for r in one_class} == {(0.7, 1)}
    assert quality.rate(empty(spark), labels).collect() == []
    kept = quality.keep_good(docs, labels).collect()
    want = sorted((r.doc_id or 0) for r in got if r.predicted)
    assert sorted((r.doc_id or 0) for r in kept) == want and all(r.key == 7 for r in kept)


def _mutate(rng, text, edits):
    s = list(text)
    for _ in range(edits):
        k, i = rng.randrange(3), rng.randrange(len(s))
        if k == 0:
            s[i] = "#"
        elif k == 1:
            s.insert(i, "@")
        else:
            del s[i]
    return "".join(s)


def test_decontamination(spark):
    rng = random.Random(10)
    items = [(k, re.sub(r"[^ -~]", "x", prose(rng, 14 + 3 * k))) for k in range(8)] + [(50, None), (51, "short"), (52, "")]
    items += [(60 + k, re.sub(r"[^ -~]", "x", prose(rng, 30))[: 12 + 4 * k].strip()) for k in range(9)]  # short: fewer grams, the same budget rule
    rows, want = [], set()
    for i in range(60):
        text = re.sub(r"[^ -~]", "x", prose(rng, rng.randrange(0, 60)))
        if i % 3 == 0:
            k = rng.choice([*range(8), *range(11, 20)])
            n = len(items[k][1])
            text = text + _mutate(rng, items[k][1], rng.randrange(int(0.08 * n) + 1)).upper() + re.sub(r"[^ -~]", "x", prose(rng, 9))
        rows.append((i, text))
    for i, t in rows:
        for k, x in items:
            e = int(0.08 * len(x or ""))
            if x and brute.edit_distance_within(t.lower(), x.lower()) <= e:
                want.add((i, k))
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, rows, clash=True)
    got = decontam.find_leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(want) >= 20 and any(k > 51 for _, k in want)
    low = {(r.doc_id, r.item_id): r.edits for r in got}
    for i, k in want:
        assert low[i, k] == brute.edit_distance_within(dict(rows)[i].lower(), dict(items)[k].lower())
    blocks = decontam.find_leaks(docs, bench, block_bytes=200).collect()
    assert sorted(map(tuple, blocks)) == sorted(map(tuple, got))
    clean = decontam.drop_leaks(docs, bench, block_bytes=300).collect()
    assert sorted(r.doc_id for r in clean) == sorted(set(range(60)) - {i for i, _ in want}) and clean[0].key == 7


def test_decontamination_special(spark):
    item = "a question that is long enough to be found again, with an answer"
    bench = spark.createDataFrame([(1, item), (2, item)], "item_id long, text string")
    long = ("filler words without meaning " * 700_000)[: 17 << 20]
    rows = [(1, None), (2, ""), (3, item), (3, item), (None, item), (4, long[: 8 << 20] + item + long[: 9 << 20])]
    got = decontam.find_leaks(frame(spark, rows), bench).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in got) == sorted([(0, 1), (0, 2), (3, 1), (3, 2), (3, 1), (3, 2), (4, 1), (4, 2)])
    assert {r.stop_byte for r in got if r.doc_id == 4} == {(8 << 20) + len(item)}
    assert decontam.find_leaks(empty(spark), bench).collect() == []
    assert decontam.find_leaks(frame(spark, rows[:3]), bench.where("false")).collect() == []


def test_lm_scores(spark):
    """Against the same models computed word by word (tables wide enough for few shared cells)."""
    rows = corpus(11, 30)
    good = {i for i, _ in rows[::3]}
    ids = spark.createDataFrame([(i,) for i in good] + [(None,), (10**6,)], "doc_id long")
    bits = dict(word_bits=12, pair_bits=14)
    got = {r.doc_id: r for r in lmscore.cross_entropy_difference(frame(spark, rows, clash=True), ids, **bits).collect()}

    import numpy as np

    from stressframe.llm.textvec import Roller, lower_table

    lower, roller = lower_table(), Roller()
    coded = {}
    for i, t in rows:
        raw = np.frombuffer((t or "").encode(), np.uint8)
        _, word, before, cell = lmscore.classes(raw, np.array([0, len(raw)]), roller, lower, 12, 14)
        assert len(word) == sum(brute.word_counts(t).values())
        coded[i] = (word.tolist(), before.tolist(), cell.tolist())

    def model(ids_, scale):
        w, c, start = {}, {}, 0
        for i in ids_:
            for a, b, d in zip(*coded[i]):
                w[a], c[d] = w.get(a, 0) + 1, c.get(d, 0) + 1
                start += b == 4096
        total = sum(w.values())
        first = lambda a: (w.get(a, 0) * scale + 0.5) / (total * scale + 0.5 * 4096)
        context = lambda b: (start if b == 4096 else w.get(b, 0)) * scale
        return lambda a, b, d: -math.log(min(1.0, (c.get(d, 0) * scale + 64 * first(a)) / (context(b) + 64))), total

    target, n_good = model([i for i, _ in rows if i in good], 1.0)
    _, n_all = model([i for i, _ in rows], 1.0)
    background, _ = model([i for i, _ in rows], n_good / n_all)
    for i, _ in rows:
        words = list(zip(*coded[i]))
        one = sum(target(*x) for x in words) / max(1, len(words))
        two = sum(background(*x) for x in words) / max(1, len(words))
        r = got[i]
        assert r.n_words == len(words)
        assert r.target_loss == pytest.approx(one) and r.background_loss == pytest.approx(two) and r.score == pytest.approx(one - two)


@pytest.mark.parametrize("slice_text", [6 << 20, 2000])
def test_lm_scores_of_real_words(spark, slice_text):
    """Against counts of real words and pairs; more distinct pairs than the former 2**18 cells."""
    rows = [*corpus(11, 30), (5000, " ".join(f"u{k}" for k in range(300_000)))]
    good = {i for i, _ in rows[::3]}
    ids = spark.createDataFrame([(i,) for i in good], "doc_id long")
    got = {r.doc_id: r for r in lmscore.cross_entropy_difference(frame(spark, rows, clash=True), ids, slice_text=slice_text).collect()}
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(brute.UP)) for i, t in rows}
    every = len({w for x in words.values() for w in x})

    def model(ids_, scale):
        from collections import Counter

        one, two = Counter(), Counter()
        for i in ids_:
            one.update(words[i])
            two.update(zip([None, *words[i]], words[i]))
        total = sum(one.values())
        one[None] = sum(bool(words[i]) for i in ids_)

        def loss(b, w):
            first = (one[w] * scale + 0.5) / (total * scale + 0.5 * every)
            return -math.log((two[b, w] * scale + 64 * first) / (one[b] * scale + 64))

        return loss, total

    target, n_good = model(good, 1.0)
    background, _ = model(words, n_good / model(words, 1.0)[1])
    assert len(got) == len(rows)
    for i, w in words.items():
        one, two = (sum(f(*x) for x in zip([None, *w], w)) / max(1, len(w)) for f in (target, background))
        r = got[i]
        assert r.n_words == len(w)
        assert r.target_loss == pytest.approx(one) and r.background_loss == pytest.approx(two) and r.score == pytest.approx(one - two)


def test_lm_special(spark):
    ids = spark.createDataFrame([(10**6,)], "doc_id long")
    got = lmscore.cross_entropy_difference(frame(spark, [(1, "a b"), (1, "a b"), (2, None), (None, "")]), ids).collect()
    assert len(got) == 4 and all(r.score == 0.0 for r in got)
    assert lmscore.cross_entropy_difference(empty(spark), ids).collect() == []


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var a = "</p><article>no";</script></head>
<body class="page"><header><h1>Site</h1></header><nav><ul><li>Menu<ul><li>Sub</li></ul></li></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="ad">Buy <div>now</div></div>
<article class="post"><h1>A &amp; B</h1><p><b>First  part<br>second&nbsp;line <p>Tom&#39;s &lt;tag&gt; <i>x</i>y
<aside>Aside</aside><form><p>Your name</p></form><ul><li>one<li>two</ul><!-- <p>gone</p> -->
<section class="comments"><p>Reader says</p></section><p hidden>no</p></article>
<aside>Side</aside><footer>Foot</footer></body></html>"""


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "7 AS inside", "8 AS text", "9 AS _page")


def test_page_text(spark):
    rows = [(1, "http://h/1", PAGE), (2, None, None), (3, "http://h/2", ""), (4, "http://h/3", "<article><p>cut o"), (1, "http://h/1", PAGE)]
    got = pages.main_text(_pages(spark, rows)).collect()
    want = "A & B\n\nFirst part second line\n\nTom's <tag> xy\n\none\n\ntwo"
    assert sorted((r.page_id, r.text, r.n_chars) for r in got) == sorted([(1, want, len(want)), (1, want, len(want)), (2, "", 0), (3, "", 0), (4, "cut o", 5)])
    assert pages.main_text(_pages(spark, rows[:1]).where("false")).collect() == []


def test_host_boilerplate(spark):
    note = "sign up for the weekly letter of this site and never miss it"
    body = [f"tale{k} about " + " ".join(f"thing{k}x{j}" for j in range(12)) for k in range(4)]
    rows = [(k, f"http://one.example/p{k}", f"<body><div>{note}</div><div>{body[k]}</div></body>") for k in range(3)]
    rows += [(8, "http://two.example/a", f"<body><div>{note}</div><div>{body[3]}</div></body>")]
    rows += [(9, "http://one.example/copy", rows[0][2])]  # an equal page is the same page
    got = {r.page_id: r.text for r in pages.main_text(_pages(spark, rows)).collect()}
    assert got == {0: body[0], 1: body[1], 2: body[2], 9: body[0], 8: f"{note}\n\n{body[3]}"}


def test_blocks_beside_an_article(spark):
    """They go through the host's suffix array as those of pages without one: what the host repeats
    goes, the rest stays; the article's own text stays whatever other pages hold."""
    note = "sign up for the weekly letter of this site and never miss it"
    long = [f"part{k} " + " ".join(f"word{k}x{j}" for j in range(15)) for k in range(3)]
    teaser = "a tale that is told on two pages of this host alike"
    page = "<body><p>Our Site</p><p>{}</p><main><p>{}</p></main><p>{}</p><p>{}</p></body>"
    rows = [(k, f"http://one.example/p{k}", page.format(note, f"intro {k}", long[k], teaser if k else "end of it")) for k in range(2)]
    rows += [(2, "http://one.example/p2", f"<article><p>{teaser}</p></article>")]
    rows += [(3, "http://two.example/p3", page.format(note, teaser, long[2], "last"))]
    got = {r.page_id: r.text for r in pages.main_text(_pages(spark, rows)).collect()}
    assert got == {
        0: f"intro 0\n\n{long[0]}\n\nend of it", 1: f"intro 1\n\n{long[1]}", 2: teaser,
        3: f"Our Site\n\n{note}\n\n{teaser}\n\n{long[2]}\n\nlast",
    }


def test_queries_registered():
    from stressframe.llm.queries import ORACLE_SQL, QUERIES

    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert SMALL


def test_page_markup_cases(spark):
    """Text that stays, and text that goes, in awkward markup."""
    cases = {
        '<article><div class="menu-card">soup of the day</div><p class=reply>he did reply</p></article>': "soup of the day\n\nhe did reply",
        '<article><p class="share-price">41.5</p><p id="related-work">earlier work</p></article>': "41.5\n\nearlier work",
        "<article><p>energy is <math><mi>m</mi><mi>c</mi></math> here</p></article>": "energy is mc here",
        "<article><p>before</p><select><option>a<option>b<p>after the list</p><p>more</p></article>": "before\n\nafter the list\n\nmore",
        "<article><script src=/a/>var x=1</script><p>only text</p></article>": "only text",
        "<article><p>&<b>lt;</b> and &lt;b&gt;</p></article>": "&lt; and <b>",
        '<article><p>kept</p><div class="share-buttons">tweet</div><div class="ad">buy</div><div id="comments">first!</div><p>too</p></article>': "kept\n\ntoo",
        '<article><p>kept</p><div class="ad-slot-2">buy</div><section class="related">else</section></article>': "kept",
        "<article><p>one</p><svg/><p>two</p><svg><text>drawn</text></svg><p>three</p></article>": "one\n\ntwo\n\nthree",
        "<article><p>all</p><iframe src=x><p>rest</p></article>": "all\n\nrest",
        "<article><p>text</p><script>never closed <p>code</p>": "text",
    }
    rows = [(k, f"https://h{k}.example/", page) for k, page in enumerate(cases)]
    got = {r.page_id: r.text for r in pages.main_text(_pages(spark, rows)).collect()}
    assert got == dict(enumerate(cases.values()))


def test_every_labelled_row_teaches(spark, monkeypatch):
    """More labelled rows than any former bound: the cut is their exact quantile, and a
    change to any part of them changes the weights; ranks do not depend on the ranges."""
    x = [F.rand(j + 1) + F.when(F.col("_y") == 1, 0.2).otherwise(0.0) for j in range(len(quality.MEASURES))]
    known = spark.range(30_000).select(F.col("id").alias("_id"), (F.col("id") % 3 == 0).cast("int").alias("_y")).select("_id", F.array(*x).alias("_x"), "_y")
    known = cut_lineage(known)
    weights, cut = quality.learn(known, 2, 1e-3)
    margins = np.sort([np.dot(r["_x"], weights) for r in known.collect()])
    assert cut == pytest.approx((margins[19_999] + margins[20_000]) / 2, abs=1e-9)
    late = known.orderBy(F.xxhash64("_id").desc()).limit(5000).select("_id", F.lit(True).alias("_late"))
    moved = known.join(late, "_id", "left").select("_id", "_y", F.when(F.col("_late"), F.transform("_x", lambda v: -v)).otherwise(F.col("_x")).alias("_x"))
    assert not np.allclose(quality.learn(cut_lineage(moved), 2, 1e-3)[0], weights, rtol=1e-3)
    few = quality._ranked(known, 30_000).groupBy("_y").agg(F.count_distinct("_r").alias("n"), F.max("_r").alias("m")).collect()
    monkeypatch.setattr(quality, "ROWS_PER_RANGE", 500)
    many = quality._ranked(known, 30_000).groupBy("_y").agg(F.count_distinct("_r").alias("n"), F.max("_r").alias("m")).collect()
    assert {tuple(r) for r in few} == {tuple(r) for r in many} == {(0, 20_000, 19_999), (1, 10_000, 9_999)}
