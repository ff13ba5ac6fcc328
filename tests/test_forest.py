"""Forests on the executors: same trees whoever grows them, whole depth, weights, saved and loaded."""

from __future__ import annotations

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from stressframe.operators import forest as FO
from stressframe.operators import models as MD
from stressframe.operators.metrics import roc_auc


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 30, (1500, 5)).astype(float)
    y = (x[:, 0] + x[:, 1] * (x[:, 2] > 12) + rng.normal(0, 4, 1500) > 28).astype(int)
    data = [(i, int(y[i]) if i % 50 else None, *x[i].tolist()) for i in range(1500)] + [(1500 + i, int(y[1]), *x[1].tolist()) for i in range(300)]
    df = spark.createDataFrame(data, "id int, y int, a double, b double, c double, d double, e double")
    return MD.prepare(df, "y", list("abcde"), keep=("id",)).data


def scores(model, df):
    return {r.id: r.p for r in model.transform(df).select("id", MD.prob1(model.getOrDefault("name")).alias("p")).collect()}


def test_branches_grown_by_groups_or_by_passes_are_the_same(rows):
    fits = [FO.fit_forest(df, "y", "m", 6, weights=(0.7, 1.6), local_rows=n) for df, n in ((rows, 10_000), (rows.repartition(7), 150), (rows.coalesce(1), 1))]
    a, b, c = (scores(m, rows) for m in fits)
    assert a == b == c and len(a) == 1800 and all(0 <= p <= 1 for p in a.values())
    for m in fits[1:]:
        np.testing.assert_allclose(m.featureImportances.toArray(), fits[0].featureImportances.toArray(), atol=1e-12)
    assert fits[0].featureImportances.toArray().sum() == pytest.approx(1.0)
    scored = fits[0].transform(rows).select("y", MD.prob1("m").alias("p"))
    assert roc_auc(scored.where("y IS NOT NULL"), "y", "p").first().auc > 0.9


def test_default_forest_keeps_its_nodes_off_the_driver(rows, tmp_dir):
    model = MD.fit_one(rows, "rf_default", "rf", "y")
    nodes = sum(len(r.nodes) // FO.NODE.itemsize for r in model.nodes.select("nodes").collect())
    known = json.loads(model.getOrDefault("payload"))
    assert len(known["tops"]) == 100 and nodes > 100 * 50
    assert sum(len(t["heap"]) for t in known["tops"]) == 100  # the driver has the roots alone
    path = os.path.join(tmp_dir, "forest")
    model.write().overwrite().save(path)
    assert scores(FO.ForestModel.load(path), rows) == scores(model, rows)


def test_without_a_limit_trees_grow_until_leaves_are_pure(rows):
    distinct = rows.where("y IS NOT NULL AND id < 1500")
    model = FO.fit_forest(distinct, "y", "m", 1, bootstrap=False)
    got = scores(model, distinct)
    labels = {r.id: r.y for r in distinct.select("id", "y").collect()}
    assert sum(abs(got[k] - labels[k]) for k in labels) < 0.02 * len(labels)  # all but leaves without a gain
    limited = FO.fit_forest(distinct, "y", "m", 1, depth=2, min_rows=40, bootstrap=False, local_rows=200)
    assert len(set(scores(limited, distinct).values())) <= 4


def test_poisson_has_its_mean_and_variance():
    u = (FO.mix(np.arange(200_000, dtype=np.uint64)) >> np.uint64(11)).astype(float) / (1 << 53)
    for mean in (1, 7, 5000):
        k = FO.poisson(u, np.full(len(u), mean))
        assert k.mean() == pytest.approx(mean, rel=0.02) and k.var() == pytest.approx(mean, rel=0.03)


def test_one_class_and_no_rows(rows):
    ones = rows.where("y = 1")
    assert set(scores(FO.fit_forest(ones, "y", "m", 2), ones.where(F.col("id") < 40)).values()) <= {1.0}
    with pytest.raises(ValueError):
        FO.fit_forest(rows.where("y > 5"), "y", "m", 2)
