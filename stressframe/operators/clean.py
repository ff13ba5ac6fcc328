"""Contradictory-label cleaning (FLT-1..3) and its report (AGG-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stressframe.functions.predicates import contradiction_mask


def clean(df: DataFrame, target: str) -> DataFrame:
    """Drop contradictory rows; rows whose rule inputs are NULL stay.

    A table without the target is returned unchanged.
    """
    if target not in df.columns:
        return df
    return df.where(~contradiction_mask(df, target))


def split_contradictions(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """(contradictory, clean) by one mask; duplicates stay on both sides (FLT-3, SET-2)."""
    mask = contradiction_mask(df, target)
    return df.where(mask), df.where(~mask)


def cleaning_report(df: DataFrame, target: str) -> DataFrame:
    """One row: initial rows, removed rows, removed share, final rows (one pass)."""
    mask = contradiction_mask(df, target)
    counted = df.agg(
        F.count(F.lit(1)).alias("initial_rows"),
        F.count_if(mask).alias("removed_rows"),
    )
    return counted.select(
        "initial_rows",
        "removed_rows",
        F.try_divide(F.col("removed_rows"), F.col("initial_rows")).alias("removed_share"),
        (F.col("initial_rows") - F.col("removed_rows")).alias("final_rows"),
    )


# Columns of the audit list when an id exists (SNK-1).
AUDIT_COLUMNS = ("customer_id", "credit_score", "income_drop_pct")


def audit_list(df: DataFrame, target: str) -> DataFrame:
    """Contradictory rows for review: id, credit score, income drop when
    ``customer_id`` exists, else all columns."""
    bad, _ = split_contradictions(df, target)
    if "customer_id" in df.columns:
        return bad.select(*[c for c in AUDIT_COLUMNS if c in df.columns])
    return bad
