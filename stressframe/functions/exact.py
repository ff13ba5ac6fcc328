"""Exact arithmetic on cent-valued and count-valued inputs.

Money, rates and tax in the source tables carry two decimals and quantities are
integral. Summing them as integers (cents) is associative, so a derived value is
bit-identical whatever the partitioning, retry order or engine. Ratios of such
integer sums are rounded to six places by integer arithmetic, half away from
zero, and only then turned into a double (one correctly rounded division).

Each helper has a Column form and a SQL-text form so the DuckDB oracle computes
the very same operations.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 1_000_000  # six decimal places


def cents(c: str | Column) -> Column:
    """Two-decimal double -> exact integer hundredths."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col * 100).cast("long")


def whole(c: str | Column) -> Column:
    """Integral double -> long."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col).cast("long")


def int_div(a: Column, b: Column) -> Column:
    """Integral division (SQL ``div``) of non-negative exact numbers; no double is involved."""
    return F.call_function("div", a, b)


def ratio6(num: Column, den: Column) -> Column:
    """num / den for longs, den > 0, rounded half away from zero to 6 places. Whole
    part and rest are divided apart, the rest as a decimal: no long input overflows
    or loses a unit."""
    size, by = F.abs(num.cast("long")), den.cast("long")
    rest = (size % by).cast("decimal(19,0)") * F.lit(2 * SCALE).cast("decimal(7,0)")
    twice = by.cast("decimal(19,0)") * F.lit(2).cast("decimal(1,0)")
    k = int_div(size, by).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(7,0)") + int_div(rest + by.cast("decimal(19,0)"), twice)
    return F.signum(num) * k.cast("double") / float(SCALE)


def sql_cents(expr: str) -> str:
    return f"CAST(ROUND(({expr})*100) AS BIGINT)"


def sql_whole(expr: str) -> str:
    return f"CAST(ROUND({expr}) AS BIGINT)"


def sql_ratio6(num: str, den: str) -> str:
    return (
        f"(SIGN({num}) * ((ABS({num})*{2 * SCALE} + ({den})) // (2*({den}))) / 1e6)"
    )
