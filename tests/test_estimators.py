"""Ordered target statistics, extremely random trees, contributions: against brute force."""

from __future__ import annotations

import hashlib
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stressframe.operators import contributions as C
from stressframe.operators.random_trees import Forest, draws, fit_extra_trees
from stressframe.operators.target_stats import TargetStatistics, ordered_target_statistics


def _md5_order(key, seed):
    return int(hashlib.md5(f"{key}|{seed}".encode()).hexdigest()[:15], 16)


@pytest.mark.parametrize("rows_per_bucket", [1 << 21, 16])
def test_ordered_target_statistics(spark, rows_per_bucket, tmp_dir):
    rng = random.Random(3)
    levels = ["hot"] * 8 + ["a", "b", None]
    rows = [(k, rng.choice(levels), rng.choice([0, 1, 1, None]), 7) for k in range(200)]
    df = spark.createDataFrame(rows, "k long, c string, y int, n int").repartition(5)
    out, fitted = ordered_target_statistics(df, ["c"], "y", "k", strength=2.0, seed=9, rows_per_bucket=rows_per_bucket)
    known = [y for _, _, y, _ in rows if y is not None]
    prior, want, seen = sum(known) / len(known), {}, {}
    for k, c, y, _ in sorted(rows, key=lambda r: _md5_order(r[0], 9)):
        n, p = seen.get(c, (0, 0))
        want[k] = (p + 2.0 * prior) / (n + 2.0)
        if y is not None:
            seen[c] = (n + 1, p + y)
    got = {r.k: r.c_ts for r in out.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    assert out.columns == ["k", "c", "y", "n", "c_ts"]
    new = spark.createDataFrame([(1, "hot"), (2, None), (3, "unseen")], "k long, c string")
    path = os.path.join(tmp_dir, "ts")
    fitted.save(path)
    for model in (fitted, TargetStatistics.load(spark, path)):
        scored = {r.k: r.c_ts for r in model.transform(new).collect()}
        assert scored[3] == prior
        for k, c in ((1, "hot"), (2, None)):
            assert abs(scored[k] - (seen[c][1] + 2.0 * prior) / (seen[c][0] + 2.0)) < 1e-12


def test_target_statistics_empty(spark):
    df = spark.createDataFrame([], "k long, c string, y int")
    out, fitted = ordered_target_statistics(df, ["c"], "y", "k")
    assert out.collect() == [] and fitted.prior == 0.0


def grown(rows, names, trees, depth, min_leaf, drawn, seed):
    """{(tree, node): (feature, cut, n0, n1)} by plain recursion."""
    n0, n1 = (sum(r[0] == c for r in rows) for c in (0, 1))
    w = (n0 + n1) / (2 * n0), (n0 + n1) / (2 * n1)
    out = {}

    def purity(part):
        a, b = (sum(r[0] == c for r in part) * w[c] for c in (0, 1))
        return (a * a + b * b) / (a + b)

    def grow(tree, node, part, level):
        counts = [sum(r[0] == c for r in part) for c in (0, 1)]
        out[tree, node] = (None, None, *counts)
        if level == depth or min(counts) == 0 or len(part) < 2 * min_leaf:
            return
        keys, at = draws(seed, np.array([tree]), np.array([node]), len(names))
        best = None
        for f in sorted(range(len(names)), key=lambda i: (keys[0, i], i))[:drawn]:
            seen = [r[1][f] for r in part if r[1][f] is not None]
            if not seen or min(seen) == max(seen):
                continue
            cut = min(seen) + (max(seen) - min(seen)) * at[0, f]
            sides = [[r for r in part if r[1][f] is None or r[1][f] <= cut], [r for r in part if r[1][f] is not None and r[1][f] > cut]]
            if min(map(len, sides)) < min_leaf:
                continue
            score = purity(sides[0]) + purity(sides[1])
            if best is None or score > best[0]:
                best = score, f, cut, sides
        if best:
            out[tree, node] = (best[1], best[2], *counts)
            for k, side in enumerate(best[3]):
                grow(tree, 2 * node + k, side, level + 1)

    for tree in range(trees):
        grow(tree, 1, rows, 0)
    return out, w


def test_extra_trees_equal_plain_recursion(spark, tmp_dir):
    rng = random.Random(4)
    names = ["a", "b", "flat", "gaps", "int"]
    rows = []
    for k in range(160):
        x = [rng.gauss(0, 1), rng.random(), 3.0, None if rng.random() < 0.3 else rng.gauss(2, 1), float(rng.randrange(4))]
        rows.append((int(x[0] + x[4] + rng.gauss(0, 1) > 1), x))
    df = spark.createDataFrame([(k, y, *x) for k, (y, x) in enumerate(rows)], "k long, y int, a double, b double, flat double, gaps double, int double")
    odd = spark.createDataFrame([(900, None, 1.0, 1.0, 1.0, 1.0, 1.0)], df.schema)  # no label: not fitted on
    forest = fit_extra_trees(df.unionAll(odd).repartition(7), "y", names, trees=6, depth=5, min_leaf=3, drawn=3, seed=11)
    want, w = grown(rows, names, 6, 5, 3, 3, 11)
    got = {(r.tree, r.node): (r.feature, r.cut, r.n0, r.n1) for r in forest.table(spark).collect()}
    assert got == want and len(want) > 60 and forest.weights == w
    path = os.path.join(tmp_dir, "forest")
    forest.save(spark, path)
    again = Forest.load(spark, path)
    assert (again.feature == forest.feature).all() and (again.counts == forest.counts).all() and again.names == names
    scored = {r.k: r.probability for r in again.transform(df.unionAll(odd)).collect()}
    for k, (_, x) in list(enumerate(rows))[:20]:
        p = 0.0
        for tree in range(6):
            node = 1
            while want[tree, node][0] is not None:
                f, cut = want[tree, node][:2]
                node = 2 * node + (x[f] is not None and x[f] > cut)
            a, b = want[tree, node][2] * w[0], want[tree, node][3] * w[1]
            p += b / (a + b) / 6
        assert abs(scored[k] - p) < 1e-12
    assert len(scored) == 161


def test_extra_trees_special(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 3.0)], "y int, a double")
    one = fit_extra_trees(df, "y", ["a"], trees=2, depth=3)
    assert {r.probability for r in one.transform(df).collect()} == {1.0}  # one class: a root each
    none = fit_extra_trees(df.limit(0), "y", ["a"], trees=2, depth=3)
    assert {r.probability for r in none.transform(df).collect()} == {0.0}
    assert one.transform(df.limit(0)).collect() == []


def test_shapley_against_all_moves(spark):
    rows = [(k, float(k % 7), float(k * k % 5), None if k == 3 else 1.5 * k) for k in range(30)]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double")
    score = lambda d: d.withColumn("p", F.col("a") * F.col("b") + F.coalesce("c", F.lit(-1.0)) * F.col("a"))
    base = {"a": 1.0, "b": 2.0, "c": 0.5}
    got = C.shapley_values(df, score, ["a", "b", "c"], "k", base, orders=3, seed=5, score_col="p").withColumn("ok", C.adds_up()).collect()
    f = lambda v: v[0] * v[1] + (-1.0 if v[2] is None else v[2]) * v[0]
    for r in got:
        x, want = rows[r.k][1:], [0.0] * 3
        for o in range(3):
            order = sorted(range(3), key=lambda i: hashlib.md5(f"{r.k}|{o}|5|{'abc'[i]}".encode()).hexdigest())
            v = [1.0, 2.0, 0.5]
            for i in order:
                before = f(v)
                v[i] = x[i]
                want[i] += (f(v) - before) / 3
        assert all(abs(r.contributions[c] - w) < 1e-9 for c, w in zip("abc", want)) and r.ok
        assert r.score == f(x) and r.base_score == 2.5
    assert len(got) == 30
    assert C.shapley_values(df.limit(0), score, ["a"], "k", base, score_col="p").collect() == []
    with pytest.raises(ValueError):
        C.shapley_values(df, score, [], "k", base)


def test_linear_values_and_summary(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(k, Vectors.dense([k, -2.0 * k])) for k in range(4)], ["k", "features"])
    own = C.linear_values(df, [2.0, 1.0], ["a", "b"], [1.5, -3.0], "k")
    assert {r.k: r.contributions for r in own.collect()}[3] == {"a": 3.0, "b": -3.0}
    assert [(r.feature, r.mean_abs, r["mean"]) for r in C.mean_absolute(own).collect()] == [("a", 2.0, 0.0), ("b", 2.0, 0.0)]


def test_staged_margins_and_patience(spark, tmp_dir):
    import duckdb
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    from stressframe.operators.staged import StagedTrees, chosen_rounds, probability, staged_curve, staged_loss, with_patience

    rng = random.Random(6)
    rows = [(k, k % 2, rng.gauss(0, 1) + (k % 4 == 1), rng.random(), float(rng.randrange(3))) for k in range(240)]
    df = spark.createDataFrame(rows, "k long, g int, a double, b double, c double").withColumn("y", (F.col("a") + F.col("c") > 1.4).cast("int"))
    data = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    model = GBTClassifier(labelCol="y", maxIter=6, maxDepth=3, stepSize=0.4, seed=1, maxBins=16).fit(data.where("k < 120"))
    trees = StagedTrees.from_model(model, ["a", "b", "c"], os.path.join(tmp_dir, "gbt"))
    trees.save(spark, os.path.join(tmp_dir, "staged"))
    trees = StagedTrees.load(spark, os.path.join(tmp_dir, "staged"))
    staged = trees.staged(df).withColumn("p", probability(F.element_at("margins", -1)))
    want = {r.k: r.probability[1] for r in model.transform(data).select("k", "probability").collect()}
    got = staged.collect()
    assert all(abs(r.p - want[r.k]) < 1e-12 and len(r.margins) == 6 for r in got) and len(got) == 240
    early = {r.k: r.probability for r in trees.cut(2).transform(df).collect()}
    assert all(abs(early[r.k] - 1 / (1 + np.exp(-2 * r.margins[1]))) < 1e-12 for r in got)
    for curve in (staged_curve(staged, "y", ("g",)), staged_loss(staged, "y", ("g",))):
        assert curve.count() == 12
    # the chosen round again, in SQL over the stored curve
    metric = [(g, r, m) for g, ms in enumerate([[1, 3, 3, 2, 2, 2, 9], [5, 4, 6, 4, 7, 4, 4], [1, 2, 3, 4, 5, 6, 7], [9, 1, 1, 1, 1, 1, 1]]) for r, m in enumerate(ms, 1)]
    curve = spark.createDataFrame(metric, "g int, round int, metric int")
    con = duckdb.connect()
    con.execute("CREATE TABLE c (g INT, r INT, m INT)")
    con.executemany("INSERT INTO c VALUES (?, ?, ?)", metric)
    sql = """WITH b AS (SELECT g, r, m, (SELECT x.r FROM c x WHERE x.g = c.g AND x.r <= c.r ORDER BY x.m DESC, x.r LIMIT 1) AS best FROM c),
      s AS (SELECT g, coalesce(min(r) FILTER (r - best >= 3), max(r)) AS stop FROM b GROUP BY g)
      SELECT s.g, b.best, s.stop FROM s JOIN b ON b.g = s.g AND b.r = s.stop"""
    assert {(r.g, r.chosen_round, r.trained_rounds) for r in chosen_rounds(curve, 3, ("g",)).collect()} == set(con.execute(sql).fetchall())
    assert [r.trained for r in with_patience(curve.where("g = 3"), 3).orderBy("round").collect()] == [True] * 4 + [False] * 3


@pytest.mark.parametrize("distinct", [9, 4000])
def test_fit_staged_grows_the_trees_of_spark_ml(spark, tmp_dir, distinct):
    """Same margins after every round as Spark ML's GBT, few and many values per column, whatever
    the order of the rows; only splits reach the driver."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    from stressframe.operators.staged import StagedTrees, fit_staged

    rng = np.random.default_rng(distinct)
    x = rng.integers(0, distinct, size=(3000, 4)) / distinct
    y = (x[:, 0] * x[:, 1] + x[:, 2] / 3 + rng.normal(size=3000) / 5 > 0.4).astype(int)
    rows = [(i, int(y[i]), *map(float, x[i])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, y int, a double, b double, c double, d double")
    model = GBTClassifier(labelCol="y", maxIter=8, stepSize=0.1, maxDepth=4, seed=1).fit(VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(df))
    want = StagedTrees.from_model(model, list("abcd"), f"{tmp_dir}/model").margins(x)
    got = fit_staged(df, "y", list("abcd"), 8, 0.1, 4)
    np.testing.assert_allclose(got.margins(x), want, atol=1e-9)
    again = fit_staged(df.orderBy(F.rand(3)), "y", list("abcd"), 8, 0.1, 4)
    np.testing.assert_array_equal(got.margins(x), again.margins(x))
    flat = fit_staged(df.where("y = 1"), "y", list("abcd"), 2, 0.1, 4)  # one class: no split
    assert (flat.feature < 0).all() and (np.diff(flat.margins(x)[:, 0]) == 0).all()
    scored = got.transform(df).select("id", "probability").toPandas().sort_values("id")
    np.testing.assert_allclose(scored["probability"], 1 / (1 + np.exp(-2 * got.margins(x)[:, -1])), atol=1e-12)


def test_fit_staged_adds_up_blocks(spark, monkeypatch):
    from stressframe.operators import staged

    rng = np.random.default_rng(8)
    x = rng.integers(0, 20, size=(2000, 2)) / 20
    rows = [(int(a + b + rng.normal() / 9 > 1), float(a), float(b)) for a, b in x]  # some nodes are pure early
    df = spark.createDataFrame([*rows, (None, 0.0, 0.0)], "y int, a double, b double")
    one = staged.fit_staged(df, "y", ["a", "b"], 6, 0.1, 6)
    monkeypatch.setattr(staged, "BLOCK_ROWS", 300)
    monkeypatch.setattr(staged, "AFRESH", 2)
    np.testing.assert_allclose(staged.fit_staged(df, "y", ["a", "b"], 6, 0.1, 6).margins(x), one.margins(x), atol=1e-9)
