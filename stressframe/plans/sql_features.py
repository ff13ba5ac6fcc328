"""SQL text for the feature sets and the quantile caps (DuckDB oracle).

Double constants are written with an exponent (``0.3e0``) because DuckDB reads
``0.3`` as DECIMAL; operation order matches the Column expressions so that the
row arithmetic is bit-identical on both engines.
"""

from __future__ import annotations


def _flag(cond: str) -> str:
    return f"CAST(COALESCE({cond}, FALSE) AS INT)"


def _clip_lower(x: str, lo: str) -> str:
    return f"CASE WHEN {x} < {lo} THEN {lo} ELSE {x} END"


_HEADROOM_V1 = _clip_lower("(1-credit_utilization_ratio)", "0.01e0")

V1 = {
    "gambling_stress_interaction": "gambling_spend_increase_pct*emi_to_income_ratio",
    "panic_cutback_flag": _flag("discretionary_spend_drop_pct>0.3e0"),
    "savings_cushion_erosion": "savings_decline_pct*income_drop_pct",
    "utilization_headroom": _HEADROOM_V1,
    "recent_delinquency_intensity": "missed_payments_last_6m*recent_failed_autodebit_flag",
    "utility_delay_severity": (
        "CASE WHEN utility_payment_delay_days>-1 AND utility_payment_delay_days<=0 THEN 0 "
        "WHEN utility_payment_delay_days>0 AND utility_payment_delay_days<=15 THEN 1 "
        "WHEN utility_payment_delay_days>15 AND utility_payment_delay_days<=30 THEN 3 "
        "WHEN utility_payment_delay_days>30 AND utility_payment_delay_days<=1000 THEN 5 END"
    ),
    "total_delinquency_events": "missed_payments_last_6m+failed_autodebit_count",
    "failed_autodebit_count_per_credit_tier": "failed_autodebit_count/(credit_score/100+1e-5)",
    "utility_payment_delay_days_per_credit_tier": "utility_payment_delay_days/(credit_score/100+1e-5)",
    "income_drop_pct_per_credit_tier": "income_drop_pct/(credit_score/100+1e-5)",
    "stress_concentration": f"emi_to_income_ratio/({_HEADROOM_V1})",
    "perfect_storm": _flag("income_drop_pct>0.15e0 AND savings_decline_pct>0.3e0 AND missed_payments_last_6m>0"),
    "adjusted_obligation_burden": f"emi_to_income_ratio*(1+{_clip_lower('savings_decline_pct', '0.0e0')})",
    "risk_velocity": "risk_momentum_score/(credit_score+1e-5)",
    "volatility_risk_factor": "balance_volatility_30d*savings_decline_pct",
}

BASE = {
    "debt_stress_index": "emi_to_income_ratio*credit_utilization_ratio",
    "income_stability_shock": "salary_delay_days*income_drop_pct",
    "total_delinquency_events": "missed_payments_last_6m+failed_autodebit_count",
    "financial_retrenchment": "discretionary_spend_drop_pct*savings_decline_pct",
    "recent_payment_trouble": "recent_failed_autodebit_flag*utility_payment_delay_days",
    "risk_velocity": "risk_momentum_score/(credit_score+1e-5)",
    "volatility_impact": "balance_volatility_30d*savings_decline_trend",
}

# v2 features on the statement table (no income_drop_pct, no missed payments)
V2 = {
    "stress_acceleration": "unified_stress_index*stress_momentum_score",
    "shock_amplification": "behavioral_shock_index*(1+stress_momentum_score)",
    "income_utilization": "total_spend/(monthly_income+1e-5)",
    "gambling_ratio": "gambling_spend/(monthly_income+1e-5)",
    "delayed_liquidity_crunch": "salary_delay_days/(liquidity_ratio+0.1e0)",
    "savings_income_strain": "ROUND(savings_decline_pct*LN(1+monthly_income), 6)",
    "utilization_headroom": _clip_lower("(1-credit_utilization_ratio)", "0.0e0"),
    "total_delinquency_events": "failed_autodebit_count",
}


def select_list(features: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in features.items())


def replace_star(columns: list[str], replaced: dict[str, str]) -> str:
    """Column list where some columns are replaced by an expression."""
    return ", ".join(f"{replaced[c]} AS {c}" if c in replaced else c for c in columns)


def quantile_caps(source: str, cols: list[str], q: float, name: str = "caps") -> str:
    """CTEs ``<name>_v``, ``<name>_r`` and ``<name>`` (column, cap): linear
    interpolation at q*(n-1) over 0-based ranks."""
    union = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM {source} WHERE {c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))"
        for c in cols
    )
    return f"""{name}_v AS ({union}),
{name}_r AS (SELECT column_name, value, ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY value)-1 AS rk,
  COUNT(*) OVER (PARTITION BY column_name) AS n FROM {name}_v),
{name}_p AS (SELECT DISTINCT column_name, CAST({q!r} AS DOUBLE)*(n-1) AS pos FROM {name}_r),
{name} AS (SELECT p.column_name, lo.value + (hi.value-lo.value)*(p.pos-FLOOR(p.pos)) AS cap
  FROM {name}_p p JOIN {name}_r lo ON lo.column_name=p.column_name AND lo.rk=FLOOR(p.pos)
  JOIN {name}_r hi ON hi.column_name=p.column_name AND hi.rk=CEIL(p.pos))"""


def capped(col: str, caps: str = "caps") -> str:
    cap = f"(SELECT cap FROM {caps} WHERE column_name='{col}')"
    return f"CASE WHEN {col} > {cap} THEN {cap} ELSE {col} END"


def quantile_table(source: str, cols: list[str], probs: list[float], name: str = "qt") -> str:
    """CTEs ending in ``<name>`` (column_name, prob, value) for several probabilities."""
    union = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM {source} WHERE {c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))"
        for c in cols
    )
    probs_sql = " UNION ALL ".join(f"SELECT CAST({p!r} AS DOUBLE) AS prob" for p in probs)
    return f"""{name}_v AS ({union}),
{name}_r AS (SELECT column_name, value, ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY value)-1 AS rk,
  COUNT(*) OVER (PARTITION BY column_name) AS n FROM {name}_v),
{name}_q AS ({probs_sql}),
{name}_p AS (SELECT DISTINCT r.column_name, q.prob, q.prob*(r.n-1) AS pos FROM {name}_r r CROSS JOIN {name}_q q),
{name} AS (SELECT p.column_name, p.prob, lo.value + (hi.value-lo.value)*(p.pos-FLOOR(p.pos)) AS value
  FROM {name}_p p JOIN {name}_r lo ON lo.column_name=p.column_name AND lo.rk=FLOOR(p.pos)
  JOIN {name}_r hi ON hi.column_name=p.column_name AND hi.rk=CEIL(p.pos))"""
