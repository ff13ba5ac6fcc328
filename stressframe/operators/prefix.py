"""Distributed running sums (cumulative counts) in a global sort order.

A plain ``sum(...) over (order by x)`` moves every row to one task. Here the
ordered key space is cut into buckets (approximate-quantile boundaries, or
caller-given contiguous buckets such as hash prefixes); each bucket totals its
rows (small table: groups x buckets), bucket offsets come from a window over
that small table, and every bucket then runs its own windowed prefix sum plus
its offset. Only bounded data (boundaries, the bucket-total table) is ever
gathered; no task holds more than one bucket. How many buckets there are changes
the plan, never the result.

Used by exact quantiles, ROC / PR curves and stratified folds.
"""

from __future__ import annotations

import functools
import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stressframe.session import cut_lineage

ROWS_PER_BUCKET = 1 << 21  # ~2M keys per window partition


def null_safe(left: str, right: str, cols: list[str]) -> Column:
    """Join condition on ``cols`` of two aliased frames; NULL keys match NULL keys."""
    return functools.reduce(Column.__and__, [F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in cols])


def quantile_buckets(df: DataFrame, order_col: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame | None:
    """Add ``_bucket``: contiguous ranges of ``order_col`` holding about
    ``rows_per_bucket`` rows each; the number of buckets follows from one count,
    the boundaries from approximate quantiles at as many points.
    Returns None when everything fits in one bucket."""
    n = df.count()
    nb = max(1, math.ceil(n / rows_per_bucket))
    if nb == 1:
        return None
    points = [i / nb for i in range(1, nb)]
    grid = df.agg(F.percentile_approx(F.col(order_col).cast("double"), points, 10 * nb).alias("q")).first()["q"] or []
    splits = [-math.inf, *sorted({float(b) for b in grid if math.isfinite(b)}), math.inf]
    keyed = df.withColumn("_okey", F.col(order_col).cast("double"))
    out = Bucketizer(splits=splits, inputCol="_okey", outputCol="_bucket", handleInvalid="keep").transform(keyed)
    return out.drop("_okey")


def running_totals(
    df: DataFrame,
    order_cols: list[str] | str,
    sum_cols: list[str],
    by: tuple[str, ...] | list[str] = (),
    bucket_col: str | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    prefix: str = "cum_",
    single_bucket: bool = False,
) -> DataFrame:
    """Add ``cum_<c>`` = inclusive running sum of each ``c`` in ``sum_cols``,
    ascending by ``order_cols`` within each ``by`` group, plus ``total_<c>``
    (group total). ``order_cols`` must be unique within a group.

    ``bucket_col`` (optional) must be monotone non-decreasing in the order;
    when absent, buckets come from approximate quantiles of the first order
    column.
    """
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    by = list(by)
    if single_bucket:
        return _one_bucket(df, order_cols, sum_cols, by, prefix)
    if bucket_col is None:
        df = cut_lineage(df)  # counted, bracketed and summed: what gave the rows (a model, say) runs once
        bucketed = quantile_buckets(df, order_cols[0], rows_per_bucket)
        if bucketed is None:
            return _one_bucket(df, order_cols, sum_cols, by, prefix)
        bucket_col = "_bucket"
    else:
        bucketed = df
    totals = bucketed.groupBy(*by, bucket_col).agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    before = Window.partitionBy(*by).orderBy(bucket_col).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = totals.select(
        *by,
        bucket_col,
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sum_cols],
        *[F.sum(f"_t_{c}").over(whole).alias(f"total_{c}") for c in sum_cols],
    )
    # null-safe: rows whose group key is NULL are a group like any other
    added = [F.col(f"o.`{c}`") for c in offsets.columns if c not in (*by, bucket_col)]
    joined = bucketed.alias("r").join(offsets.alias("o"), null_safe("r", "o", [*by, bucket_col])).select("r.*", *added)
    running = (
        Window.partitionBy(*by, bucket_col)
        .orderBy(*order_cols)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = joined.select(
        "*", *[(F.col(f"_o_{c}") + F.sum(c).over(running)).alias(f"{prefix}{c}") for c in sum_cols]
    )
    drop = [f"_o_{c}" for c in sum_cols]
    if bucket_col == "_bucket":
        drop.append("_bucket")
    return out.drop(*drop)


def _one_bucket(df: DataFrame, order_cols: list[str], sum_cols: list[str], by: list[str], prefix: str) -> DataFrame:
    """Everything within one bucket (at most ``rows_per_bucket`` keys per
    group): running and total sums share one exchange and sort, no join."""
    running = Window.partitionBy(*by).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*by)
    return df.select(
        "*",
        *[F.sum(c).over(whole).alias(f"total_{c}") for c in sum_cols],
        *[F.sum(c).over(running).alias(f"{prefix}{c}") for c in sum_cols],
    )
