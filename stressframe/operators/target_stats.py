"""Ordered target statistics for nominal columns (MOD-3 native categoricals).

A training row's level is replaced by the smoothed positive share of the rows of
the same level that come *before* it in a fixed random order, so no row sees its
own label; a row to be scored takes the share over all training rows of its level.

The order is the md5 order of (key, seed), the one of the folds.  Prefix counts are
distributed running sums over hash-prefix buckets, so a level that holds a third of
all rows is spread over as many tasks as it has buckets.  Nothing but the overall
share reaches the driver; the level tables are joined, not collected, so a nominal
column may have as many levels as rows.

A missing level is a level of its own; an unseen level gets the prior; rows without
a label are encoded but count for nobody; rows with equal keys are ordered by nothing
and must not occur in the training table; an empty table has prior 0.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stressframe.operators.prefix import ROWS_PER_BUCKET, running_totals
from stressframe.operators.split import DEFAULT_SEED, HASH_BITS, order_hash


def smoothed(positives: Column, n: Column, prior: float, strength: float) -> Column:
    """(positives + strength * prior) / (n + strength)."""
    return (positives.cast("double") + F.lit(strength * prior)) / (n.cast("double") + F.lit(strength))


class TargetStatistics:
    """Per-level label sums of a training table: (column, level, n, positives)."""

    def __init__(self, table: DataFrame, columns: list[str], prior: float, strength: float):
        self.table, self.columns, self.prior, self.strength = table, list(columns), prior, strength

    def transform(self, df: DataFrame, suffix: str = "_ts") -> DataFrame:
        """``df`` with ``<column>_ts`` from the whole training table."""
        out = df
        for c in self.columns:
            own = self.table.where(F.col("column") == c).select(
                F.col("level").alias("_level"), F.col("n").alias("_n"), F.col("positives").alias("_p")
            )
            joined = out.join(own, F.col(c).cast("string").eqNullSafe(F.col("_level")), "left")
            value = smoothed(F.coalesce("_p", F.lit(0)), F.coalesce("_n", F.lit(0)), self.prior, self.strength)
            out = joined.withColumn(c + suffix, value).drop("_level", "_n", "_p")
        return out

    def save(self, path: str) -> None:
        head = self.table.sparkSession.createDataFrame(
            [(c, self.prior, self.strength) for c in self.columns], "column string, prior double, strength double"
        )
        self.table.write.mode("overwrite").parquet(f"{path}/levels")
        head.coalesce(1).write.mode("overwrite").parquet(f"{path}/head")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TargetStatistics":
        head = spark.read.parquet(f"{path}/head").collect()
        return TargetStatistics(spark.read.parquet(f"{path}/levels"), [r.column for r in head], head[0].prior, head[0].strength)


def fit_target_statistics(df: DataFrame, columns: list[str], label: str, strength: float = 1.0) -> TargetStatistics:
    """One pass for all columns: partial sums per (column, level) before the shuffle."""
    total = df.agg(F.count(label).alias("n"), F.count_if(F.col(label) == 1).alias("p")).first()
    prior = total.p / total.n if total.n else 0.0
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns])
    levels = df.where(F.col(label).isNotNull()).select(F.inline(cells), F.col(label).alias("_y"))
    table = levels.groupBy("column", "level").agg(F.count("*").alias("n"), F.count_if(F.col("_y") == 1).alias("positives"))
    return TargetStatistics(table, columns, prior, strength)


def ordered_target_statistics(
    df: DataFrame,
    columns: list[str],
    label: str,
    key: str,
    strength: float = 1.0,
    seed: int = DEFAULT_SEED,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    suffix: str = "_ts",
) -> tuple[DataFrame, TargetStatistics]:
    """Training rows with ``<column>_ts`` from the rows before them, and the fitted
    statistics that score other rows."""
    fitted = fit_target_statistics(df, columns, label, strength)
    bits = max(0, math.ceil(math.log2(max(1.0, df.count() / rows_per_bucket))))
    y = F.col(label)
    out = df.withColumn("_h", order_hash([key], seed))
    out = out.withColumn("_b", F.shiftright("_h", HASH_BITS - bits)) if bits else out
    for c in columns:
        counted = out.withColumn("_one", y.isNotNull().cast("int")).withColumn("_y", F.coalesce((y == 1).cast("int"), F.lit(0)))
        run = functools.partial(running_totals, counted, ["_h", key], ["_one", "_y"], by=[c])
        summed = run(bucket_col="_b") if bits else run(single_bucket=True)
        value = smoothed(F.col("cum__y") - F.col("_y"), F.col("cum__one") - F.col("_one"), fitted.prior, strength)
        out = summed.withColumn(c + suffix, value).drop("_one", "_y", "cum__one", "cum__y", "total__one", "total__y")
    return out.drop("_h", "_b"), fitted
