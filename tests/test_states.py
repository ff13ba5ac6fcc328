"""States per part, merged: against one pass over everything."""

from __future__ import annotations

import os
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from stressframe.operators.states import MomentStore, QuantileStore

NAN = float("nan")


def table(spark, seed=1, n=400):
    rng = random.Random(seed)
    rows = [(rng.randrange(6), rng.choice([0, 1, 1, None]), rng.choice([None, NAN, *[round(rng.gauss(5e5, 3), 6)] * 8]), 4.0, rng.randrange(9)) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "week int, y int, x double, flat double, k int").repartition(4)


def added(store, df, twice=3):
    for week in range(6):
        store.add(df.where(F.col("week") == week))
    store.add(df.where(F.col("week") == twice))  # again: replaces itself
    return store


def test_moments(spark, tmp_dir):
    rows, df = table(spark)
    store = added(MomentStore(spark, os.path.join(tmp_dir, "m"), ["x", "flat", "k"], "y", "week"), df)
    got = {(r.label, r.feature): r for r in store.stats().collect()}
    for label in (0, 1, None):
        for i, c in ((2, "x"), (3, "flat"), (4, "k")):
            v = [float(r[i]) for r in rows if r[1] == label and r[i] is not None and r[i] == r[i]]
            r = got[label, c]
            assert (r.n, r.min, r.max) == (len(v), min(v), max(v))
            assert r.mean == pytest.approx(statistics.fmean(v), rel=1e-14) and r.std == pytest.approx(statistics.stdev(v), rel=1e-9, abs=1e-12)
    corr = {r.column: r.correlation for r in store.correlations().collect()}
    pairs = [(r[1], r[2]) for r in rows if r[1] is not None and r[2] is not None and r[2] == r[2]]
    assert corr["x"] == pytest.approx(np.corrcoef(np.array(pairs).T)[0, 1], rel=1e-6) and corr["flat"] is None
    # the order of the parts leaves no trace
    whole = MomentStore(spark, os.path.join(tmp_dir, "w"), ["x", "flat", "k"], "y", "week")
    whole.add(df)
    assert sorted(map(str, whole.merged().collect())) == sorted(map(str, store.merged().collect()))


def test_quantiles_from_sketches(spark, tmp_dir):
    rng = random.Random(2)
    rows = [(k % 6, rng.choice([None, NAN, rng.gauss(0, 1), 7.0, 7.0]), float(k % 3)) for k in range(3000)]
    df = spark.createDataFrame(rows, "week int, x double, few double")
    store = added(QuantileStore(spark, os.path.join(tmp_dir, "q"), ["x", "few"], "week", k=8), df)  # coarse: brackets will miss
    probs = [0.0, 0.25, 0.5, 0.99, 1.0]
    for kw in ({}, {"error": 0.0}, {"gather": 5}, {"error": 0.4, "gather": 50}):
        got = {(r.column, r.prob): r.value for r in store.quantiles(df, probs, **kw).collect()}
        for i, c in ((1, "x"), (2, "few")):
            v = [r[i] for r in rows if r[i] is not None and r[i] == r[i]]
            for p in probs:
                assert got[c, p] == pytest.approx(np.quantile(v, p), rel=1e-12), (c, p, kw)


def test_empty_states(spark, tmp_dir):
    m = MomentStore(spark, os.path.join(tmp_dir, "m"), ["x"], "y", "week")
    q = QuantileStore(spark, os.path.join(tmp_dir, "q"), ["x"], "week")
    assert m.stats().collect() == [] and [r.correlation for r in m.correlations().collect()] == [None]
    empty = spark.createDataFrame([], "week int, y int, x double")
    assert q.quantiles(empty, [0.5]).collect() == []
    m.add(empty)
    assert m.stats().collect() == []
    gaps = spark.createDataFrame([(1, 0, None), (1, 1, NAN)], "week int, y int, x double")
    m.add(gaps)
    q.add(gaps)
    assert {(r.n, r.mean, r.std) for r in m.stats().collect()} == {(0, None, None)}
    assert q.quantiles(gaps, [0.5]).collect() == []
