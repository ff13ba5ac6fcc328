"""Inline edge tables: NULLs, missing columns, bin edges, zero division,
constants, non-finite values, ties, one class, probability and policy edges."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from stressframe.functions.columns import clip_lower, clip_upper, non_finite_to_null, right_closed_bins
from stressframe.operators import metrics as M
from stressframe.operators import policy as P
from stressframe.operators import profile as PR
from stressframe.operators.clean import clean, cleaning_report
from stressframe.operators.encode import fill_non_finite
from stressframe.operators.features import add_features

INF = float("inf")
NAN = float("nan")


def test_null_mask_inputs_survive_clean(spark):
    rows = [
        (1, None, 0, 800),  # NULL missed payments
        (1, 0, None, 800),
        (1, 0, 0, None),
        (None, 0, 0, 800),
        (1, 0, 0, 800),  # the only contradictory row
        (0, 0, 0, 800),
    ]
    df = spark.createDataFrame(rows, "default_next_30_days int, missed_payments_last_6m int, failed_autodebit_count int, credit_score int")
    assert clean(df, "default_next_30_days").count() == 5
    rep = cleaning_report(df, "default_next_30_days").first()
    assert (rep.initial_rows, rep.removed_rows, rep.final_rows) == (6, 1, 5)


def test_adaptive_rule_and_missing_target(spark):
    v2 = spark.createDataFrame(
        [(1, 2.5, 0.1), (1, 2.5, 0.3), (0, 3.0, 0.0), (1, None, 0.1)],
        "default_next_4_weeks int, liquidity_ratio double, unified_stress_index double",
    )
    assert clean(v2, "default_next_4_weeks").count() == 3
    assert clean(v2, "no_such_target").count() == 4  # returned unchanged
    only_v2 = spark.createDataFrame([(1, 5.0)], "default_next_4_weeks int, other double")
    assert clean(only_v2, "default_next_4_weeks").count() == 1  # neither rule applies


def test_missing_column_branches(spark):
    v2 = spark.createDataFrame(
        [(0.2, 1000.0, 3, 0.5, 0.1)],
        "savings_decline_pct double, monthly_income double, failed_autodebit_count int, unified_stress_index double, stress_momentum_score double",
    )
    out = add_features(v2, "v2")
    assert "savings_income_strain" in out.columns and "savings_cushion_erosion" not in out.columns
    r = out.first()
    assert r.total_delinquency_events == 3  # fallback without missed payments
    assert r.savings_income_strain == pytest.approx(0.2 * math.log1p(1000.0))
    with_drop = v2.withColumn("income_drop_pct", F.lit(0.5))
    out2 = add_features(with_drop, "v2")
    assert "savings_cushion_erosion" in out2.columns and "savings_income_strain" not in out2.columns
    # gate: without the stress pair no stress features
    out3 = add_features(v2.drop("stress_momentum_score"), "v2")
    assert "stress_acceleration" not in out3.columns
    with pytest.raises(ValueError):
        add_features(v2, "v1", strict=True)


def test_bins_right_closed(spark):
    vals = [-2, -1, 0, 1, 15, 16, 30, 31, 1000, 1001, None]
    df = spark.createDataFrame([(v,) for v in vals], "x int")
    got = [r.b for r in df.select(right_closed_bins("x", (-1, 0, 15, 30, 1000), (0, 1, 3, 5)).alias("b")).collect()]
    assert got == [None, None, 0, 1, 1, 3, 3, 5, 5, None, None]
    with pytest.raises(Exception):
        df.select(right_closed_bins("x", (-1, 0, 15, 30, 1000), (0, 1, 3, 5), strict=True).alias("b")).collect()


def test_headroom_floors(spark):
    df = spark.createDataFrame([(u,) for u in [0.0, 0.99, 0.995, 1.0, 1.3, None]], "credit_utilization_ratio double")
    v1 = [r.utilization_headroom for r in add_features(df, "v1").collect()]
    v2 = [r.utilization_headroom for r in add_features(df, "v2").collect()]
    assert v1[0] == 1.0 and v1[2] == 0.01 and v1[3] == 0.01 and v1[4] == 0.01 and v1[5] is None
    assert v2[3] == 0.0 and v2[4] == 0.0 and v2[5] is None
    assert v1[1] == pytest.approx(0.01)


def test_clip_null_semantics(spark):
    df = spark.createDataFrame([(None,), (1.0,), (7.0,)], "x double")
    lo = [r.v for r in df.select(clip_lower("x", 2.0).alias("v")).collect()]
    hi = [r.v for r in df.select(clip_upper("x", 5.0).alias("v")).collect()]
    assert lo == [None, 2.0, 7.0] and hi == [None, 1.0, 5.0]


def test_zero_division_is_null(spark):
    df = spark.createDataFrame([(-1e-5, 1.0), (0.0, 1.0), (None, 1.0)], "monthly_income double, total_spend double")
    df = df.withColumn("unified_stress_index", F.lit(0.1)).withColumn("stress_momentum_score", F.lit(0.1))
    got = [r.income_utilization for r in add_features(df, "v2").collect()]
    assert got[0] is None and got[1] == pytest.approx(1e5) and got[2] is None


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 1), (1.0, 0)], "x double, y int")
    r = {row.column: row.correlation for row in PR.target_correlation(df, "y", ["x", "y"]).collect()}
    assert r["x"] is None and r["y"] == pytest.approx(1.0)
    st = PR.stats_by(df, "y", ["x"]).where("y = 0").first()
    assert st["std"] == 0.0


def test_non_finite(spark):
    df = spark.createDataFrame([(NAN,), (INF,), (-INF,), (None,), (1.0,)], "x double")
    assert [r.v for r in df.select(non_finite_to_null("x").alias("v")).collect()] == [None, None, None, None, 1.0]
    assert [r.x for r in fill_non_finite(df, 0.0).collect()] == [0.0, 0.0, 0.0, 0.0, 1.0]
    prof = PR.range_profile(df, ["x"]).first()
    assert (prof.nan_count, prof.inf_count) == (2, 2)
    assert PR.null_profile(df).first().null_count == 2


def _brute_auc(pairs):
    pos = [s for l, s in pairs if l == 1]
    neg = [s for l, s in pairs if l == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


@pytest.mark.parametrize(
    "pairs",
    [
        [(1, 0.5), (0, 0.5), (1, 0.2), (0, 0.9)],  # ties across labels
        [(1, 0.3), (0, 0.3), (0, 0.3)],  # all equal
        [(1, 0.9), (1, 0.8), (0, 0.1)],  # perfect
        [(0, 0.9), (0, 0.8), (1, 0.1)],  # inverted
    ],
)
def test_auc_ties(spark, pairs):
    df = spark.createDataFrame(pairs, "label int, score double")
    assert M.roc_auc(df, "label", "score").first().auc == pytest.approx(_brute_auc(pairs), abs=1e-15)


def test_one_class(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.7)], "label int, score double")
    assert M.roc_auc(df, "label", "score").first().auc is None
    assert PR.class_ratio(df, "label").first().ratio == 1.0
    pred = df.withColumn("p", M.predict_label("score", 0.5))
    cells = {(r.actual, r.predicted): r.n_rows for r in M.confusion(pred, "label", "p").collect()}
    assert cells == {(0, 0): 1, (0, 1): 1, (1, 0): 0, (1, 1): 0}
    assert M.recall_of(pred, "label", "p").first().recall == 0.0
    rep = {r["class"]: r for r in M.class_report(pred, "label", "p").collect()}
    assert rep["1"].precision == 0.0 and rep["1"].support == 0
    best = M.best_f1_threshold(df, "label", "score").first()
    assert best.threshold == 0.1 and best.f1 == 0.0  # all F1 zero: lowest threshold


def test_probability_edges(spark):
    vals = [0.0, 0.3, 0.5, 0.6, 0.7, 0.8, 0.99, 1.0, None, NAN]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    got = df.select(P.risk_tier("p").alias("t"), P.status("p").alias("s")).collect()
    assert [r.t for r in got] == ["Low", "Medium", "Medium", "High", "High", "Critical", "Critical", "Critical", "Critical", "Critical"]
    assert [r.s for r in got][:5] == ["Low Risk", "Monitor Closely", "Monitor Closely", "Monitor Closely", "CRITICAL ALERT"]


def test_policy_edges(spark):
    cols = "liquidity_ratio double, savings_balance double, total_spend double, unified_stress_index double, monthly_income double, failed_autodebit_count int, credit_utilization_ratio double, gambling_ratio double"
    rows = [
        (1.5, 0.0, 0.0, 0.5, 1.0, 0, 0.3, 0.0),  # knee: no penalty; months 0 -> dampener 2
        (2.0, 1.0, 0.0, 0.0, 1.0, 0, 0.3, 0.0),  # savings months exactly 1
        (1.0, 3000.0, 999.0, 0.0, 1.0, 0, 0.2, 0.06),  # exactly 3 months; savings 3000 not > 3000
    ]
    df = spark.createDataFrame(rows, cols)
    out = P.assess(df, "unified_stress_index").collect()
    assert out[0].final_probability == pytest.approx(0.5 + 0.5 * 0.15)
    assert out[1].final_probability == 0.0
    assert out[2].final_probability == pytest.approx((0.25 * 0.8) * 1.0)
    assert [f.factor for f in out[2].factors] == ["Gambling Activity", "Overspending (Deficit)", "Low Credit Utilization"]
    assert out[2].verdict == P.VERDICT_WATCH
    assert out[2].actions == [P.ACTIONS[0][1], P.ACTIONS[3][1]]
    assert out[1].factors == [] and out[1].verdict == P.VERDICT_HEALTHY


def test_scenarios_order(spark):
    s = add_features(P.scenarios(spark), "v2")
    out = {r.profile: r for r in P.assess(s, "unified_stress_index").collect()}
    assert out["Safe"].final_probability < out["Risky"].final_probability < out["Crisis"].final_probability
    assert out["Crisis"].verdict == P.VERDICT_HIGH
    assert [f.factor for f in out["Crisis"].factors][:2] == ["Gambling Activity", "Missed Auto-Debits"]
