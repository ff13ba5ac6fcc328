"""Model steps: shapes, probability range, one OOF row per key, AUC above
chance, stack persistence round trip, encoders' persistence."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from stressframe.operators import boost
from stressframe.operators import models as MD
from stressframe.operators.encode import ImputeScale, ImputeScaleModel, OneHot, OneHotModel
from stressframe.operators.metrics import roc_auc
from stressframe.plans.q_models import BASES, stack_input
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def stacked(spark):
    prep = stack_input(spark, SMALL)
    res = MD.stack(prep, BASES, "default_next_4_weeks", "statement_id", refit=True)
    return prep, res


def test_oof_shape_and_range(stacked):
    prep, res = stacked
    n = prep.data.count()
    oof = res.oof
    assert oof.count() == n == oof.select("statement_id").distinct().count()
    for c in ("prob_lgbm", "prob_xgb", "prob_cat", "prob_meta"):
        lo, hi = oof.agg(F.min(c), F.max(c)).first()
        assert 0.0 <= lo <= hi <= 1.0
    auc = roc_auc(oof, "default_next_4_weeks", "prob_meta").first().auc
    assert auc > 0.5
    assert res.meta_coefficients.count() == 5 * 3


def test_stack_round_trip(spark, stacked, tmp_dir):
    prep, res = stacked
    path = os.path.join(tmp_dir, "stack")
    res.model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    from stressframe.plans.q_features import transform_v2

    df = transform_v2(spark, SMALL)
    a = MD.score_stack(res.model, df, ["statement_id"])
    b = MD.score_stack(loaded, df, ["statement_id"])
    assert a.count() == df.count()
    diff = a.join(b.withColumnRenamed("probability", "p2"), "statement_id").where(F.abs(F.col("probability") - F.col("p2")) > 1e-12)
    assert diff.count() == 0


def test_encoders_persist(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0), (None, 4.0)], "k string, x double")
    oh = OneHot(inputCols=["k"]).fit(df)
    oh.write().overwrite().save(os.path.join(tmp_dir, "oh"))
    got = OneHotModel.load(os.path.join(tmp_dir, "oh")).transform(df)
    assert got.columns == ["k_b", "k_c", "x"]
    assert [tuple(r)[:2] for r in got.collect()] == [(0, 0), (1, 0), (0, 1), (0, 0)]
    sc = ImputeScale(inputCols=["x"]).fit(df)
    sc.write().overwrite().save(os.path.join(tmp_dir, "sc"))
    vals = [r.x for r in ImputeScaleModel.load(os.path.join(tmp_dir, "sc")).transform(df).collect()]
    assert sum(vals) == pytest.approx(0.0, abs=1e-12)  # centred on the imputed column
    filled = [1.0, 3.0, 3.0, 4.0]  # NULL -> median of (1, 3, 4)
    mean = sum(filled) / 4
    std = (sum((v - mean) ** 2 for v in filled) / 4) ** 0.5  # population std
    assert vals == pytest.approx([(v - mean) / std for v in filled], abs=1e-12)


def test_predictor_round_trip(spark, stacked, tmp_dir):
    from stressframe.operators.features import CLIP_V2, ClipLimits, add_features
    from stressframe.sources.derive import stress_statement

    prep, res = stacked
    raw = stress_statement(spark, SMALL).drop("customer_id", "week_number")
    caps = ClipLimits(inputCols=list(CLIP_V2)).fit(add_features(raw, "v2"))
    pred = MD.Predictor("v2", res.model, caps)
    pred.save(os.path.join(tmp_dir, "predictor"))
    back = MD.Predictor.load(os.path.join(tmp_dir, "predictor"))
    a = pred.predict(raw, ["statement_id"])
    b = back.predict(raw, ["statement_id"]).withColumnRenamed("probability", "p2")
    assert a.count() == raw.count()
    assert a.join(b, "statement_id").where(F.abs(F.col("probability") - F.col("p2")) > 1e-12).count() == 0


def test_draw_params_ranges():
    from stressframe.plans.q_models import SEARCH_SPACE, TUNE_SPACE

    draws = MD.draw_params(TUNE_SPACE, 30, seed=1)
    assert len(draws) == 30
    for d in draws:
        assert 500 <= d["rounds"] <= 2000 and 3 <= d["depth"] <= 12 and 20 <= d["leaves"] <= 150
        assert 0.005 <= d["rate"] <= 0.1 and 0.6 <= d["row_rate"] <= 1.0 and 1.0 <= d["pos_weight"] <= 10.0
    assert MD.draw_params(SEARCH_SPACE, 20, seed=42) == MD.draw_params(SEARCH_SPACE, 20, seed=42)
    assert all(d["depth"] in SEARCH_SPACE["depth"] for d in MD.draw_params(SEARCH_SPACE, 20))


# (preset: rounds, rate, depth, leaves, rows per child, row rate, column rate, L1, L2, weight, patience), written out from the recipes
RECIPES = {
    "lgbm": (1351, 0.031, 3, 40, 71, 0.956, 0.837, 7e-05, 0.0008, 2.475, 50),
    "lgbm_final": (1351, 0.03118, 3, 40, 71, 0.9558, 0.8371, 7e-05, 0.0008, 2.4752, 50),
    "lgbm_optimized": (1000, 0.03, 0, 31, 20, 0.8, 0.8, 0.0, 0.0, 1.0, 50),
    "lgbm_simple": (500, 0.05, 4, 15, 50, 1.0, 1.0, 1.0, 1.0, 1.0, 50),
    "xgb": (1000, 0.03, 4, 0, 1, 0.8, 0.8, 0.0, 1.0, 2.5, 50),
    "xgb_default": (100, 0.3, 6, 0, 1, 1.0, 1.0, 0.0, 1.0, 1.0, 0),
    "xgb_vote": (300, 0.05, 6, 0, 1, 0.8, 0.8, 0.0, 1.0, 1.0, 0),
    "cat": (1000, 0.03, 6, 0, 1, 1.0, 1.0, 0.0, 3.0, 2.5, 50),
    "cat_alone": (2000, 0.02, 6, 0, 1, 1.0, 1.0, 0.0, 3.0, 1.0, 100),
    "ceiling": (500, 0.1, 0, 31, 20, 1.0, 1.0, 0.0, 0.0, 1.0, 0),
    "gb": (200, 0.05, 5, 0, 1, 1.0, 1.0, 0.0, 0.0, 1.0, 10),
}


@pytest.mark.parametrize("kind", sorted(RECIPES))
def test_recipe_parameters(kind):
    p = MD.boost_params(kind)
    got = (p.rounds, p.rate, p.depth, p.leaves, p.min_rows, p.row_rate, p.col_rate, p.l1, p.l2, p.pos_weight, p.patience)
    assert got == RECIPES[kind]


def _toy(n=3000, seed=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 6)), 2)
    odds = 2 * x[:, 0] + x[:, 1] * x[:, 2]
    return x, (rng.random(n) < 1 / (1 + np.exp(-odds))).astype(float), odds


def test_boost_learns_and_waits():
    x, y, odds = _toy()
    p = boost.Boost(rounds=400, rate=0.1, depth=4, min_rows=5, patience=20)
    m = boost.fit_arrays(x[:2000], y[:2000], p, x[2000:], y[2000:])
    trees = [{k: np.array(v) for k, v in t.items()} for t in m["trees"]]
    raw = np.full(1000, m["base"])
    scores = []
    for t in trees:
        raw = raw + boost.walk(t, x[2000:], "cut")
        scores.append(boost.auc(y[2000:], raw))
    assert scores[-1] > 0.9 * boost.auc(y[2000:], odds[2000:])
    assert len(trees) < 400 and scores[-1] == max(scores)  # the best round is kept ...
    gaps = np.diff([k for k in range(len(scores)) if scores[k] == max(scores[: k + 1])])
    assert len(trees) > 3 and gaps.max() > 1  # ... though rounds without a gain lie before it
    assert boost.fit_arrays(x[:500], y[:500], boost.Boost(rounds=30))["rounds"] == 30  # no patience: all rounds


def test_boost_controls():
    x, y, _ = _toy(800)
    one = boost.fit_arrays(x, y, boost.Boost(rounds=1, rate=1.0, leaves=4, min_rows=100))
    t = one["trees"][0]
    leaf = [k for k, c in enumerate(t["col"]) if c < 0]
    assert len(leaf) <= 4
    at = boost.walk({**{k: np.array(v) for k, v in t.items()}, "value": np.arange(len(t["col"]), dtype=float)}, x, "cut")
    assert min(np.sum(at == k) for k in leaf) >= 100
    deep = boost.fit_arrays(x, y, boost.Boost(rounds=1, depth=2))["trees"][0]
    assert sum(c < 0 for c in deep["col"]) <= 4
    assert boost.fit_arrays(x, y, boost.Boost(rounds=2, l1=1e9))["trees"][0]["col"] == [-1]  # L1 stops every split


def test_fit_does_not_depend_on_partitions(spark, tmp_dir):
    x, y, _ = _toy(500)
    rows = [(int(k), int(y[k]), *map(float, x[k])) for k in range(500)]
    df = spark.createDataFrame(rows, "id int, y int, a double, b double, c double, d double, e double, f double")
    fits = []
    for n in (1, 7):
        data = MD.prepare(df.repartition(n), "y", list("abcdef"), keep=("id",)).data
        fits.append(boost.fit_boost(data, "y", "m", boost.Boost(rounds=10, depth=3, row_rate=0.7, col_rate=0.7)))
    assert fits[0].getOrDefault("payload") == fits[1].getOrDefault("payload")
    path = os.path.join(tmp_dir, "boost")
    fits[0].write().overwrite().save(path)
    a, b = (m.transform(data).select("id", MD.prob1("m").alias("p")).collect() for m in (fits[0], boost.BoostModel.load(path)))
    assert sorted(a) == sorted(b) and all(0 <= r.p <= 1 for r in a)


def test_scorer_equals_walks():
    """Leaf sets give the margins of the walk, for trees within every word and beyond."""
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(3000, 6)), 2)
    y = (x[:, 0] * x[:, 1] + x[:, 2] > 0.3).astype(float)
    for settings in (dict(depth=3), dict(depth=4), dict(depth=6), dict(leaves=31), dict(leaves=150, depth=12)):
        model = boost.fit_arrays(x, y, boost.Boost(rounds=140, row_rate=0.8, **settings))
        probe = np.vstack([x, x + 0.005, [[np.nan] * 6, [np.inf] * 6, [-1e9] * 6]])
        want = np.full(len(probe), model["base"])
        for t in model["trees"]:
            want += boost.walk({k: np.array(v, np.int32 if k in ("col", "left", "right") else np.float64) for k, v in t.items()}, probe, "cut")
        scorer = boost.Scorer(model)
        assert bool(scorer.walked) == (settings.get("leaves", 0) > 64)
        np.testing.assert_allclose(scorer.margins(probe), want, atol=1e-9)


def test_sample_rows_are_the_smallest_hashes(spark, monkeypatch):
    """Per group, with copies and rows without a label; no driver collect holds the rows."""
    rows = [(i % 2, i % 3 if i % 5 else None, [float(i // 4 % 400), float(i % 3)]) for i in range(6000)]
    df = spark.createDataFrame(rows, "g int, label int, x array<double>").select("g", (F.col("label") == 1).cast("int").alias("y"), array_to_vector("x").alias("features"))
    x = vector_to_array("features")
    keyed = df.where("y IS NOT NULL").select("g", F.xxhash64(x, F.col("y").cast("double")).alias("h"), F.col("y").cast("double").alias("y"))
    for limit in (700, 100_000):
        got = boost.sample_rows(df, "y", ("g",), limit)
        for g in (0, 1):
            want = sorted((r.h, r.y) for r in keyed.where(F.col("g") == g).collect())[:limit]
            assert sorted((r["_h"], r["_y"]) for r in got.where(F.col("g") == g).collect()) == want


def test_fit_partitions_grow_with_full_parts_only():
    assert [MD.fit_partitions(n) for n in (0, 10_001, 320_000, 900_000, 9_000_000)] == [1, 2, 32, 32, 36]


def test_leaves_at_the_depth_limit_sum_one_column_only(monkeypatch):
    """Leaves that are not split any more need no histogram; the trees stay the same to the bit."""
    x, y, _ = _toy(1500)
    settings = [boost.Boost(rounds=5, depth=4, l2=1.0, row_rate=0.8, col_rate=0.6), boost.Boost(rounds=5, depth=3, min_rows=30, l1=0.1)]
    sums, whole = [], boost._Grower._hist

    def counted(self, rows, g, h, last=False):
        out = whole(self, rows, g, h, last)
        sums.append(out.shape[1])
        return out

    monkeypatch.setattr(boost._Grower, "_hist", counted)
    fits = [boost.fit_arrays(x, y, p) for p in settings]
    assert {1, 6} == set(sums)
    monkeypatch.setattr(boost._Grower, "_hist", lambda self, rows, g, h, last=False: whole(self, rows, g, h)[:, : 1 if last else None])
    assert [boost.fit_arrays(x, y, p) for p in settings] == fits


def test_swapped_margins_equal_margins_of_swapped_rows():
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(1500, 6)), 2)
    x[:, 5] = 1.0  # cut by no tree
    y = (x[:, 0] * x[:, 1] + x[:, 2] > 0.3).astype(float)
    other = x[rng.permutation(len(x))]
    for settings in (dict(depth=3), dict(depth=4), dict(depth=6), dict(leaves=150, depth=12)):
        scorer = boost.Scorer(boost.fit_arrays(x, y, boost.Boost(rounds=140, row_rate=0.8, col_rate=0.4, **settings)))
        got = scorer.swapped(x, other)
        for c in range(6):
            mixed = x.copy()
            mixed[:, c] = other[:, c]
            np.testing.assert_allclose(got[c], scorer.margins(mixed), atol=1e-12)


def test_permutation_importance_scores_all_columns_in_one_pass(spark):
    """Same areas as column by column, and the model is asked for plain scores once."""
    from stressframe.operators.explain import permutation_importance

    x, y, _ = _toy(700)
    levels = ["low", "mid", None]
    rows = [(int(k), int(y[k]) if k % 50 else None, levels[k % 3], *(float(v) if (k + j) % 40 else None for j, v in enumerate(x[k, :3]))) for k in range(700)]
    df = spark.createDataFrame(rows, "id int, y int, kind string, a double, b double, c double")
    columns = ["a", "kind", "b", "c"]
    prep = MD.prepare(df, "y", columns, ["kind"], keep=("id",))
    model = boost.fit_boost(prep.data, "y", "m", boost.Boost(rounds=20, depth=3))
    calls = []

    def score(t):
        calls.append(t)
        return model.transform(prep.prep_model.transform(t)).withColumn("probability", MD.prob1("m"))

    def swapped(pairs):
        own = prep.prep_model.transform(pairs).select("y", F.col("features").alias("_own"), *[F.col(f"_p_{c}").alias(c) for c in columns])
        return model.swapped(prep.prep_model.transform(own), "_own", "features", "swapped")

    got = permutation_importance(df, score, columns, "y", "id", score_swapped=swapped).collect()
    assert len(calls) == 1
    assert got == permutation_importance(df, score, columns, "y", "id").collect()
    assert [r.feature for r in got] == columns and max(r.auc_drop for r in got) > 0.05
