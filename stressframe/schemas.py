"""Table schemas (customer v1, weekly statement v2) and target detection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Target column names, in detection order.
TARGET_V1 = "default_next_30_days"
TARGET_V2 = "default_next_4_weeks"
TARGETS = (TARGET_V1, TARGET_V2)

# Identifier / time columns dropped before modelling.
ID_COLUMNS = ("customer_id", "week_number", "expected_salary_day", "actual_salary_day")

_L, _I, _D, _S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()

V1 = T.StructType(
    [
        T.StructField("customer_id", _L),
        T.StructField("employment_type", _S),
        T.StructField("credit_score", _I),
        T.StructField("missed_payments_last_6m", _I),
        T.StructField("failed_autodebit_count", _I),
        T.StructField("recent_failed_autodebit_flag", _I),
        T.StructField("utility_payment_delay_days", _I),
        T.StructField("emi_to_income_ratio", _D),
        T.StructField("credit_utilization_ratio", _D),
        T.StructField("gambling_spend_increase_pct", _D),
        T.StructField("discretionary_spend_drop_pct", _D),
        T.StructField("savings_decline_pct", _D),
        T.StructField("savings_decline_trend", _D),
        T.StructField("income_drop_pct", _D),
        T.StructField("balance_volatility_30d", _D),
        T.StructField("risk_momentum_score", _D),
        T.StructField("salary_delay_days", _I),
        T.StructField(TARGET_V1, _I),
    ]
)

V2 = T.StructType(
    [
        T.StructField("statement_id", _L),
        T.StructField("customer_id", _L),
        T.StructField("week_number", _I),
        T.StructField("employment_type", _S),
        T.StructField("monthly_income", _D),
        T.StructField("emi_amount", _D),
        T.StructField("credit_limit", _D),
        T.StructField("salary_delay_days", _I),
        T.StructField("total_spend", _D),
        T.StructField("essential_spend", _D),
        T.StructField("discretionary_spend", _D),
        T.StructField("gambling_spend", _D),
        T.StructField("savings_balance", _D),
        T.StructField("savings_decline_pct", _D),
        T.StructField("liquidity_ratio", _D),
        T.StructField("credit_utilization_ratio", _D),
        T.StructField("failed_autodebit_count", _I),
        T.StructField("lending_app_txn_count", _I),
        T.StructField("stress_momentum_score", _D),
        T.StructField("behavioral_shock_index", _D),
        T.StructField("unified_stress_index", _D),
        T.StructField(TARGET_V2, _I),
    ]
)

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
CATEGORICAL_TYPES = (T.StringType, T.BooleanType)


def detect_target(df: DataFrame) -> str:
    """30-day target first, then 4-week; error when neither exists."""
    for name in TARGETS:
        if name in df.columns:
            return name
    raise ValueError(f"no target column found (looked for {', '.join(TARGETS)})")


def require_target(df: DataFrame, target: str) -> None:
    if target not in df.columns:
        raise ValueError(f"target {target!r} not found")


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def categorical_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, CATEGORICAL_TYPES) and f.name not in exclude]
