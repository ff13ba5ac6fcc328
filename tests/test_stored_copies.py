"""What model queries leave on disk."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import functions as F

from stressframe.operators import forest as FO
from stressframe.operators import models as MD
from stressframe.session import checkpoint_path, ensure_checkpoint_dir


def _stored(spark):
    path = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {d for d in os.listdir(path) if d.startswith("rdd-")}


def test_a_fit_input_is_stored_once(spark):
    before = _stored(spark)
    rows = MD.materialize(spark.range(2000).selectExpr("id", "id % 7 AS v"))
    assert len(_stored(spark) - before) == 1
    assert rows.count() == 2000 and rows.selectExpr("sum(v)").first()[0] == sum(k % 7 for k in range(2000))


def test_small_forests_score_rows_where_they_are(spark, monkeypatch):
    """The same scores as by sending rows to the branches, without storing what is sent."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 20, (600, 3)).astype(float)
    df = spark.createDataFrame([(i, int(x[i, 0] + x[i, 1] > 20), *x[i].tolist()) for i in range(600)], "id int, y int, a double, b double, c double")
    rows = MD.prepare(df, "y", list("abc"), keep=("id",)).data
    model = FO.fit_forest(rows, "y", "m", 5, depth=6, local_rows=150)
    before, got = _stored(spark), []
    for limit in (FO.SENT_NODES, -1):
        monkeypatch.setattr(FO, "SENT_NODES", limit)
        out = model.transform(rows)
        got.append(({r.id: r.p for r in out.select("id", MD.prob1("m").alias("p")).collect()}, len(_stored(spark) - before)))
    (here, few), (there, more) = got
    assert here == there and len(here) == 600
    assert few < more - few


def test_permutations_in_one_pass_store_no_pairs(spark, monkeypatch):
    """Rows with their partner's columns are read once: they are not stored, and the ranks go."""
    from stressframe.operators import explain

    df = spark.range(300).selectExpr("id", "CAST(id % 2 AS INT) AS y", "id % 9 AS a", "(id % 2) * 3 + id % 5 AS b")
    kept, cut = [], explain.cut_lineage
    monkeypatch.setattr(explain, "cut_lineage", lambda t: kept.append(cut(t)) or kept[-1])

    def score(t):
        return t.withColumn("probability", (F.col("a") + F.col("b")).cast("double"))

    def swapped(pairs):
        return pairs.select("y", F.array(F.col("_p_a") + F.col("b"), F.col("a") + F.col("_p_b")).cast("array<double>").alias("swapped"))

    got = explain.permutation_importance(df, score, ["a", "b"], "y", "id", score_swapped=swapped).collect()
    assert not any("_p_a" in t.columns for t in kept)
    assert not any(os.path.exists(checkpoint_path(t).removeprefix("file:")) for t in kept)
    assert got == explain.permutation_importance(df, score, ["a", "b"], "y", "id").collect()
