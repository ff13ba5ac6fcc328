"""Queries: feature sets, quantile caps, full transforms, projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stressframe.operators.clean import clean
from stressframe.operators.features import (
    CLIP_QUANTILE,
    CLIP_V1,
    CLIP_V2,
    CORE_FEATURES,
    V2_MODEL_COLUMNS,
    ClipLimits,
    add_features,
    align,
    drop_ids,
)
from stressframe.plans import sql_features as S
from stressframe.plans.registry import query
from stressframe.plans.sql_fixtures import with_tables
from stressframe.schemas import ID_COLUMNS, TARGET_V1, TARGET_V2, V1 as V1_SCHEMA, V2 as V2_SCHEMA
from stressframe.sources.derive import risk_customer, stress_statement

W1 = with_tables("risk_customer")
W2 = with_tables("stress_statement")
V1_COLS = [f.name for f in V1_SCHEMA.fields]
V2_COLS = [f.name for f in V2_SCHEMA.fields]
# The SQL's own column lists and quantile, written out apart from the code under test.
_SQL_CLIP_V1 = ["income_drop_pct", "savings_decline_pct", "gambling_spend_increase_pct"]
_SQL_CLIP_V2 = ["unified_stress_index", "gambling_spend", "total_spend"]
_SQL_CORE = ("missed_payments_last_6m, failed_autodebit_count, risk_momentum_score, credit_utilization_ratio, "
             "adjusted_obligation_burden, gambling_spend_increase_pct")
_SQL_MODEL_V2 = (
    "employment_type, monthly_income, emi_amount, credit_limit, salary_delay_days, total_spend, essential_spend, "
    "discretionary_spend, gambling_spend, savings_balance, savings_decline_pct, liquidity_ratio, credit_utilization_ratio, "
    "failed_autodebit_count, lending_app_txn_count, stress_momentum_score, behavioral_shock_index, unified_stress_index, "
    "stress_acceleration, shock_amplification, income_utilization, gambling_ratio, delayed_liquidity_crunch, "
    "savings_income_strain, utilization_headroom, total_delinquency_events"
)
_V2_MASK = "COALESCE(default_next_4_weeks=1 AND liquidity_ratio>2.0 AND unified_stress_index<0.2, FALSE)"


def round_log_feature(df: DataFrame) -> DataFrame:
    """Round the one transcendental feature for engine-independent comparison."""
    if "savings_income_strain" not in df.columns:
        return df
    return df.withColumn("savings_income_strain", F.round("savings_income_strain", 6))


@query("features_v1", f"{W1} SELECT *, {S.select_list(S.V1)} FROM risk_customer")
def q_features_v1(spark, sf_dir):
    return add_features(risk_customer(spark, sf_dir), "v1", strict=True)


@query("features_base", f"{W1} SELECT *, {S.select_list(S.BASE)} FROM risk_customer")
def q_features_base(spark, sf_dir):
    return add_features(risk_customer(spark, sf_dir), "base", strict=True)


@query("features_v2", f"{W2} SELECT *, {S.select_list(S.V2)} FROM stress_statement")
def q_features_v2(spark, sf_dir):
    return round_log_feature(add_features(stress_statement(spark, sf_dir), "v2"))


@query(
    "clip_limits_v1",
    f"{W1}, {S.quantile_caps('risk_customer', _SQL_CLIP_V1, 0.99)} SELECT column_name, cap FROM caps",
)
def q_clip_limits_v1(spark, sf_dir):
    from stressframe.operators.quantile import exact_quantiles

    q = exact_quantiles(risk_customer(spark, sf_dir), list(CLIP_V1), [CLIP_QUANTILE])
    return q.select(F.col("column").alias("column_name"), F.col("value").alias("cap"))


@query(
    "clip_limits_v2",
    f"{W2}, {S.quantile_caps('stress_statement', _SQL_CLIP_V2, 0.99)} "
    "SELECT column_name, cap FROM caps",
)
def q_clip_limits_v2(spark, sf_dir):
    from stressframe.operators.quantile import exact_quantiles

    cols = [c for c in CLIP_V2 if c in V2_COLS]
    q = exact_quantiles(stress_statement(spark, sf_dir), cols, [CLIP_QUANTILE])
    return q.select(F.col("column").alias("column_name"), F.col("value").alias("cap"))


def transform_v1(spark, sf_dir, cleaned: bool = True) -> DataFrame:
    """v1 transformer over the (cleaned) customer table: features on raw
    values, then caps fitted on the same frame."""
    df = risk_customer(spark, sf_dir)
    if cleaned:
        df = clean(df, TARGET_V1)
    feats = add_features(df, "v1", strict=True)
    return ClipLimits(inputCols=list(CLIP_V1)).fit(feats).transform(feats)


def transform_v2(spark, sf_dir) -> DataFrame:
    """v2 training input: clean -> drop ids -> features -> caps."""
    df = drop_ids(clean(stress_statement(spark, sf_dir), TARGET_V2), ID_COLUMNS)
    feats = add_features(df, "v2")
    return ClipLimits(inputCols=list(CLIP_V2)).fit(feats).transform(feats)


_V1_MASK = "COALESCE(default_next_30_days=1 AND missed_payments_last_6m=0 AND failed_autodebit_count=0 AND credit_score>700, FALSE)"
_T1_SQL = f"""{W1}, cleaned AS (SELECT * FROM risk_customer WHERE NOT {_V1_MASK}),
{S.quantile_caps('cleaned', _SQL_CLIP_V1, 0.99)},
feat AS (SELECT *, {S.select_list(S.V1)} FROM cleaned)"""
_T1_COLS = V1_COLS + list(S.V1)
_T1_SELECT = S.replace_star(_T1_COLS, {c: S.capped(c) for c in _SQL_CLIP_V1})


@query("transform_v1", f"{_T1_SQL} SELECT {_T1_SELECT} FROM feat")
def q_transform_v1(spark, sf_dir):
    return transform_v1(spark, sf_dir)


_V2_KEEP = [c for c in V2_COLS if c not in ID_COLUMNS]
_T2_SQL = f"""{W2}, cleaned AS (SELECT {', '.join(_V2_KEEP)} FROM stress_statement WHERE NOT {_V2_MASK}),
{S.quantile_caps('cleaned', _SQL_CLIP_V2, 0.99)},
feat AS (SELECT *, {S.select_list(S.V2)} FROM cleaned)"""
_T2_COLS = _V2_KEEP + list(S.V2)
_T2_SELECT = S.replace_star(_T2_COLS, {c: S.capped(c) for c in _SQL_CLIP_V2})


@query("transform_v2", f"{_T2_SQL} SELECT {_T2_SELECT} FROM feat")
def q_transform_v2(spark, sf_dir):
    return round_log_feature(transform_v2(spark, sf_dir))


@query(
    "align_columns",
    f"{_T2_SQL}, t AS (SELECT {_T2_SELECT} FROM feat) SELECT statement_id, {_SQL_MODEL_V2} FROM t",
)
def q_align_columns(spark, sf_dir):
    return align(round_log_feature(transform_v2(spark, sf_dir)), V2_MODEL_COLUMNS, keep=("statement_id",))


@query(
    "select_core_features",
    f"{_T1_SQL}, t AS (SELECT {_T1_SELECT} FROM feat) SELECT customer_id, {_SQL_CORE}, default_next_30_days FROM t",
)
def q_select_core_features(spark, sf_dir):
    return transform_v1(spark, sf_dir).select("customer_id", *CORE_FEATURES, TARGET_V1)


FLAGSHIP_COLUMNS = (
    "unified_stress_index", "gambling_spend", "total_spend", "stress_acceleration", "shock_amplification",
    "income_utilization", "gambling_ratio", "delayed_liquidity_crunch", "savings_income_strain",
    "utilization_headroom", "total_delinquency_events",
)


def flagship(spark, sf_dir) -> DataFrame:
    """Derived statements -> clean -> features -> p99 caps -> feature means by label."""
    t = round_log_feature(transform_v2(spark, sf_dir))
    return t.groupBy(TARGET_V2).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.round(F.avg(c), 6).alias(c) for c in FLAGSHIP_COLUMNS]
    )


@query(
    "flagship_means_by_label",
    f"{_T2_SQL}, t AS (SELECT {_T2_SELECT} FROM feat) SELECT default_next_4_weeks, COUNT(*) AS n_rows, "
    + ", ".join(f"ROUND(AVG({c}), 6) AS {c}" for c in FLAGSHIP_COLUMNS)
    + " FROM t GROUP BY default_next_4_weeks",
)
def q_flagship(spark, sf_dir):
    return flagship(spark, sf_dir)
