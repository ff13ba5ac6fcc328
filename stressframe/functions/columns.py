"""Scalar column helpers with pandas-compatible NULL behaviour (SCL-1..16)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

INF = float("inf")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip_lower(c: str | Column, lo: float) -> Column:
    """``Series.clip(lower=lo)``: NULL stays NULL (``greatest`` would return lo)."""
    x = col(c)
    return F.when(x < lo, F.lit(lo)).otherwise(x)


def clip_upper(c: str | Column, hi: float) -> Column:
    """``Series.clip(upper=hi)``: NULL stays NULL (``least`` would return hi)."""
    x = col(c)
    return F.when(x > hi, F.lit(hi)).otherwise(x)


def clamp(c: str | Column, lo: float, hi: float) -> Column:
    """``min(max(x, lo), hi)`` (SCL-9)."""
    return clip_upper(clip_lower(c, lo), hi)


def ratio(num: str | Column, den: str | Column) -> Column:
    """Division that yields NULL on a zero denominator instead of raising
    under ANSI mode (pandas would give +-inf / NaN; see ``non_finite_to_null``)."""
    return F.try_divide(col(num), col(den))


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 with NULL -> 0 (a pandas comparison with NaN is False)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def non_finite_to_null(c: str | Column) -> Column:
    """NaN and +-inf -> NULL (SCL-12, SCL-14)."""
    x = col(c)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(INF)), F.lit(None).cast("double")).otherwise(x)


def right_closed_bins(
    c: str | Column, edges: Sequence[float], labels: Sequence[int], strict: bool = False
) -> Column:
    """``pd.cut(x, bins=edges, labels=labels)``: intervals (e0, e1], (e1, e2], ...

    Out-of-range or missing input is NULL; with ``strict`` it raises instead,
    as the reference's integer cast does. (``Bucketizer`` is left-closed.)
    """
    x = col(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > lo) & (x <= hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    if strict:
        return expr.otherwise(F.raise_error(F.concat(F.lit("value outside bins: "), x.cast("string")))).cast("int")
    return expr.cast("int")


def run_stamp() -> Column:
    """Wall-clock run id ``yyyyMMdd_HHmmss`` (SCL-15)."""
    return F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss")


def nan_to_null_all(df):
    """Normalise NaN -> NULL in every floating column once at load."""
    fixed = [
        F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*fixed)
