"""Soft voting over probability columns (MOD-13, MOD-14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vote(cols: list[str], weights: list[float] | None = None) -> Column:
    """sum(w_i * p_i) / sum(w_i); equal weights give the plain mean."""
    if weights is None:
        total = None
        for c in cols:
            total = F.col(c) if total is None else total + F.col(c)
        return total / len(cols)
    total = None
    for w, c in zip(weights, cols):
        term = F.lit(w) * F.col(c)
        total = term if total is None else total + term
    return total / float(sum(weights))


def soft_vote(df: DataFrame, cols: list[str], weights: list[float] | None = None, out: str = "probability") -> DataFrame:
    return df.withColumn(out, vote(cols, weights))
