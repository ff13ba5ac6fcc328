"""Data-quality and label profiles (AGG-1, AGG-3..13, SRT-1, FLT-8).

Every profile is one fused aggregation pass over the table (no pass per
column), unpivoted afterwards with ``inline`` over a small row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stressframe.operators.quantile import exact_quantiles
from stressframe.schemas import numeric_columns
from stressframe.session import cut_lineage

INF = float("inf")


def _missing(c: str, dtype: T.DataType) -> Column:
    """pandas isnull: NULL, and NaN for floating columns."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.col(c).isNull() | F.isnan(c)
    return F.col(c).isNull()


def row_count(df: DataFrame) -> DataFrame:
    """Rows and columns (AGG-1)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def rate_by_flag(df: DataFrame, flag: str, label: str) -> DataFrame:
    """Label mean per 0/1 flag value, with the row count per value (AGG-9)."""
    return df.groupBy(flag).agg(F.avg(label).alias("default_rate"), F.count(F.lit(1)).alias("n_rows"))


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """Share of each label value among non-null labels (AGG-3)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    # the grouped table has one row per label value: a window over it is tiny
    total = F.sum("n_rows").over(Window.partitionBy(F.lit(1)))
    return counts.select(label, "n_rows", (F.col("n_rows") / total).alias("share"))


def class_ratio(df: DataFrame, label: str) -> DataFrame:
    """Negatives / positives, 1.0 when there are no positives (AGG-13)."""
    agg = df.agg(
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label) == 1).alias("positives"),
    )
    return agg.select(
        "negatives",
        "positives",
        F.when(F.col("positives") > 0, F.col("negatives") / F.col("positives")).otherwise(F.lit(1.0)).alias("ratio"),
    )


def null_profile(df: DataFrame, nonzero_only: bool = True) -> DataFrame:
    """(column, null_count) per column; only non-zero counts by default (AGG-5, FLT-8)."""
    fields = df.schema.fields
    agg = df.agg(*[F.count_if(_missing(f.name, f.dataType)).alias(f"n{i}") for i, f in enumerate(fields)])
    rows = F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f"n{i}").alias("null_count")) for i, f in enumerate(fields)])
    out = agg.select(F.inline(rows))
    return out.where(F.col("null_count") > 0) if nonzero_only else out


def range_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, min, max, nan_count, inf_count) per column, one pass (AGG-6).

    ``nan_count`` counts NULL and NaN (pandas ``isna``)."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        finite = F.when(~F.isnan(x), x)
        aggs += [
            F.min(finite).alias(f"mn{i}"),
            F.max(finite).alias(f"mx{i}"),
            F.count_if(x.isNull() | F.isnan(x)).alias(f"na{i}"),
            F.count_if(F.abs(x) == F.lit(INF)).alias(f"inf{i}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"mn{i}").alias("min"),
                F.col(f"mx{i}").alias("max"),
                F.col(f"na{i}").alias("nan_count"),
                F.col(f"inf{i}").alias("inf_count"),
            )
            for i, c in enumerate(cols)
        ]
    )
    return df.agg(*aggs).select(F.inline(rows))


def target_correlation(df: DataFrame, target: str, cols: list[str] | None = None) -> DataFrame:
    """Pearson correlation of each numeric column with the target, pairwise
    complete, NULL for a constant column; sorted descending, NULL last (AGG-7, SRT-1)."""
    cols = cols or numeric_columns(df)
    y = F.col(target).cast("double")
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        xp = F.when(y.isNotNull(), x)
        yp = F.when(x.isNotNull(), y)
        aggs.append(
            F.try_divide(F.covar_pop(xp, yp), F.stddev_pop(xp) * F.stddev_pop(yp)).alias(f"r{i}")
        )
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"r{i}").alias("correlation")) for i, c in enumerate(cols)])
    return df.agg(*aggs).select(F.inline(rows)).orderBy(F.col("correlation").desc_nulls_last())


def means_by(df: DataFrame, label: str, cols: list[str]) -> DataFrame:
    """Mean of each column per label value (AGG-8)."""
    return df.groupBy(label).agg(*[F.avg(c).alias(c) for c in cols])


def stats_by(df: DataFrame, label: str, cols: list[str]) -> DataFrame:
    """(feature, label, mean, std, min, max) with sample std (AGG-10)."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(c).alias(f"a{i}"), F.stddev_samp(c).alias(f"s{i}"), F.min(c).alias(f"mn{i}"), F.max(c).alias(f"mx{i}")]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"a{i}").cast("double").alias("mean"),
                F.col(f"s{i}").cast("double").alias("std"),
                F.col(f"mn{i}").cast("double").alias("min"),
                F.col(f"mx{i}").cast("double").alias("max"),
            )
            for i, c in enumerate(cols)
        ]
    )
    return df.groupBy(label).agg(*aggs).select(label, F.inline(rows))


def describe_exact(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, std, min, 25%, 50%, 75%, max per column with exact
    interpolated quartiles (AGG-11; ``summary()`` quartiles are approximate).
    The columns are derived once and stored for all passes."""
    df = cut_lineage(df.select(*cols))
    moments = df.agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(c).cast("double").alias("mean"),
                F.stddev_samp(c).cast("double").alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(f"m{i}")
            for i, c in enumerate(cols)
        ]
    )
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}.*")) for i, c in enumerate(cols)])
    m = moments.select(F.inline(rows))
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    pivot = q.groupBy("column").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("p25"),
        F.max(F.when(F.col("prob") == 0.5, F.col("value"))).alias("p50"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("p75"),
    )
    return m.join(pivot, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def head_by_key(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First ``n`` rows in key order (SRT-4; file order is not a Spark order).
    A top-n: each task keeps n rows, the driver-side merge holds n x tasks."""
    return df.orderBy(key).limit(n)


def column_kinds(df: DataFrame) -> DataFrame:
    """(column, kind, non_null) with kind numeric / categorical / other from
    the schema (PRJ-4, PRJ-5) and non-null counts in one pass."""
    from stressframe.schemas import CATEGORICAL_TYPES, NUMERIC_TYPES

    fields = df.schema.fields
    agg = df.agg(*[F.count(F.col(f.name)).alias(f"n{i}") for i, f in enumerate(fields)])

    def kind(t):
        return "numeric" if isinstance(t, NUMERIC_TYPES) else "categorical" if isinstance(t, CATEGORICAL_TYPES) else "other"

    rows = F.array(
        *[F.struct(F.lit(f.name).alias("column"), F.lit(kind(f.dataType)).alias("kind"), F.col(f"n{i}").alias("non_null"))
          for i, f in enumerate(fields)]
    )
    return agg.select(F.inline(rows))
