"""Boosted fits learn from every labelled row, in one task or in blocks on the executors."""

from __future__ import annotations

import json
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from stressframe.operators import boost


def _rows(spark, n):
    """Rows with one positive among ``n`` / 5,000 and two features."""
    x = F.array((F.col("id") % 700).cast("double"), (F.col("id") % 3).cast("double"))
    return spark.range(n).select("id", (F.col("id") % 5000 == 0).cast("int").alias("y"), array_to_vector(x).alias("features"))


def test_every_row_is_fitted(spark):
    model = boost.fit_boost(_rows(spark, 120_001), "y", "m", boost.Boost(rounds=1, depth=1, min_weight=0.0))
    payload = json.loads(model.getOrDefault("payload"))
    assert payload["base"] == pytest.approx(math.log(25 / (120_001 - 25)), abs=1e-9)


def test_every_row_is_watched(spark, monkeypatch):
    """The area that patience looks at is that of all held-out rows."""
    seen, rows = [], _rows(spark, 70_000)
    monkeypatch.setattr(boost, "fit_blocks", lambda both, p, edges, n, *rest: seen.append((n, both.where("_valid").count())) or {"rounds": 0})
    monkeypatch.setattr(boost, "TASK_CELLS", 1)
    boost.fit_boost(rows, "y", "m", boost.Boost(rounds=1, depth=1, patience=3), rows.where("id < 60000"))
    assert seen == [(130_000, 60_000)]


SETTINGS = [
    dict(rounds=4, leaves=12, min_rows=20, col_rate=0.7),
    dict(rounds=30, depth=3, patience=3, min_rows=5, pos_weight=2.0),
    dict(rounds=12, depth=3, leaves=6, patience=3, metric="loss", l1=0.1),
]


@pytest.mark.parametrize("settings", SETTINGS)
def test_blocks_grow_the_same_trees_as_one_task(spark, monkeypatch, settings):
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=(3000, 4)), 2)
    y = (rng.random(3000) < 1 / (1 + np.exp(-2 * x[:, 0] - x[:, 1] * x[:, 2]))).astype(int)
    df = spark.createDataFrame([(k, int(y[k]) if k % 50 else None, [float(v) for v in x[k]]) for k in range(3000)], "id int, y int, x array<double>")
    df = df.select("id", "y", array_to_vector("x").alias("features")).repartition(3)
    p = boost.Boost(**settings)
    train, held = df.where("id % 4 > 0"), df.where("id % 4 = 0") if p.patience else None
    monkeypatch.setattr(boost, "COUNTED_ROWS", 500)
    fits = []
    for cells, block in ((10**9, 1), (100, 900)):
        monkeypatch.setattr(boost, "TASK_CELLS", cells)
        monkeypatch.setattr(boost, "BLOCK_ROWS", block)
        monkeypatch.setattr(boost, "KEEP_ROUNDS", 2)
        fits.append(json.loads(boost.fit_boost(train, "y", "m", p, held).getOrDefault("payload")))
    one, blocks = fits
    assert one["rounds"] == blocks["rounds"] and one["base"] == pytest.approx(blocks["base"], abs=1e-12)
    for a, b in zip(one["trees"], blocks["trees"]):
        assert all(a[k] == b[k] for k in ("col", "cut", "left", "right"))
        np.testing.assert_allclose(a["value"], b["value"], atol=1e-9)


def test_edges_from_summaries():
    """Few values: all of them; many: quantiles within the summaries' rank error, the largest value last."""
    rng = np.random.default_rng(1)
    few, many = rng.integers(0, 40, 30_000).astype(float), rng.normal(size=30_000)
    for v, bins in ((few, 255), (many, 64)):
        parts = [boost.summary(v[s : s + 10_000]) for s in range(0, 30_000, 10_000)]
        assert sum(n.sum() for _, n in parts) == 30_000
        edges = boost.edges_of(*(np.concatenate(c) for c in zip(*parts)), bins)
        assert len(edges) <= bins and edges[-1] == v.max() and np.isin(edges, v).all()
        if v is few:
            assert (edges == np.unique(v)).all()
        else:
            ranks = np.searchsorted(np.sort(v), edges, side="right") / len(v)
            np.testing.assert_allclose(ranks, np.arange(1, bins + 1) / bins, atol=2 / boost.STEPS)
