"""Boolean row predicates (contradictions, record quality, stress flags).

pandas treats a comparison with a missing value as False, so ``df[~mask]``
keeps such rows. Spark yields NULL and a filter on ``NOT NULL`` drops them;
every mask here is therefore wrapped in ``coalesce(..., false)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds of the contradiction rules and record predicates.
V1_RULE_COLUMNS = ("missed_payments_last_6m", "failed_autodebit_count", "credit_score")
V2_RULE_COLUMNS = ("liquidity_ratio", "unified_stress_index")
CREDIT_SCORE_GOOD = 700
LIQUIDITY_HEALTHY = 2.0
STRESS_LOW = 0.2


def definite(cond: Column) -> Column:
    """NULL -> false, matching pandas comparison semantics."""
    return F.coalesce(cond, F.lit(False))


def perfect_record() -> Column:
    """No missed payments, no failed debits, credit score above 700 (FLT-4)."""
    return definite(
        (F.col("missed_payments_last_6m") == 0)
        & (F.col("failed_autodebit_count") == 0)
        & (F.col("credit_score") > CREDIT_SCORE_GOOD)
    )


def terrible_record() -> Column:
    """More than two missed payments and more than two failed debits (FLT-5)."""
    return definite((F.col("missed_payments_last_6m") > 2) & (F.col("failed_autodebit_count") > 2))


def high_stress() -> Column:
    """Utilization above 0.7 and EMI ratio above 0.4, as 0/1 (FLT-6)."""
    return definite((F.col("credit_utilization_ratio") > 0.7) & (F.col("emi_to_income_ratio") > 0.4)).cast("int")


def volatile_decline() -> Column:
    """Savings decline above 0.1 and balance volatility above 0.2, as 0/1 (FLT-7)."""
    return definite((F.col("savings_decline_pct") > 0.1) & (F.col("balance_volatility_30d") > 0.2)).cast("int")


def contradiction_v1(target: str) -> Column:
    """Defaulted despite a perfect record (FLT-1)."""
    return definite((F.col(target) == 1) & perfect_record())


def contradiction_v2(target: str) -> Column:
    """Defaulted despite healthy liquidity and low stress (FLT-2, second rule)."""
    return definite(
        (F.col(target) == 1)
        & (F.col("liquidity_ratio") > LIQUIDITY_HEALTHY)
        & (F.col("unified_stress_index") < STRESS_LOW)
    )


def contradiction_mask(df: DataFrame, target: str) -> Column:
    """Adaptive rule (FLT-2): the v1 rule when its columns exist, else the v2
    rule when its columns exist, else nothing is contradictory."""
    cols = set(df.columns)
    if target not in cols:
        return F.lit(False)
    if cols.issuperset(V1_RULE_COLUMNS):
        return contradiction_v1(target)
    if cols.issuperset(V2_RULE_COLUMNS):
        return contradiction_v2(target)
    return F.lit(False)
