"""Contributions of features to scores (EXP-3): sampled Shapley values and the exact
linear ones.

A row's features are moved from a base row to their own values one after another in
a random order; the change of the score at each move is that feature's contribution,
averaged over the orders.  Every order adds up to score(row) - score(base), so their
mean does too.  Orders come from md5 hashes of (key, order number, feature), and the
rows of all steps are scored in one pass by whatever scores the table.

Only (key, order, step, score) rows are shuffled, to meet their neighbours; nothing
reaches the driver.  Keys must be unique; a missing value stays missing and is handled
by the score; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _drawn_order(features: list[str], key: str, seed: int) -> Column:
    """Feature numbers (1-based) in the order of ``md5(key|order|seed|feature)``."""
    keys = [
        F.struct(
            F.md5(F.encode(F.concat_ws("|", F.col(key).cast("string"), F.col("_order").cast("string"), F.lit(str(seed)), F.lit(c)), "UTF-8")).alias("h"),
            F.lit(i + 1).alias("i"),
        )
        for i, c in enumerate(features)
    ]
    return F.transform(F.array_sort(F.array(*keys)), lambda s: s["i"])


def shapley_steps(df: DataFrame, features: list[str], key: str, base: dict[str, float], orders: int, seed: int) -> DataFrame:
    """One row per (row, order, step 0 .. number of features): the features moved so far
    have the row's values, the others the base's."""
    many = df.withColumn("_order", F.explode(F.sequence(F.lit(0), F.lit(orders - 1)))).withColumn("_perm", _drawn_order(features, key, seed))
    steps = many.withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(len(features)))))
    moved = {
        c: F.when(F.array_position("_perm", i + 1) <= F.col("_step"), F.col(c)).otherwise(F.lit(base[c]).cast(df.schema[c].dataType))
        for i, c in enumerate(features)
    }
    return steps.withColumns(moved)


def shapley_values(
    df: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    features: list[str],
    key: str,
    base: dict[str, float],
    orders: int = 4,
    seed: int = 42,
    score_col: str = "probability",
) -> DataFrame:
    """(key, score, base_score, contributions) per row; ``contributions`` maps features to
    their mean change of the score.  ``score(df)`` adds ``score_col`` and keeps the
    other columns."""
    if orders < 1 or not features:
        raise ValueError("at least one order and one feature")
    scored = score(shapley_steps(df, features, key, base, orders, seed)).select(
        key, "_order", "_step", F.col(score_col).alias("_s"), F.when(F.col("_step") == 0, F.col("_perm")).alias("_perm")
    )
    chains = scored.groupBy(key, "_order").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_step", "_s"))), lambda x: x["_s"]).alias("_c"), F.max("_perm").alias("_perm")
    )
    changes = [
        (F.element_at("_c", F.array_position("_perm", i + 1).cast("int") + 1) - F.element_at("_c", F.array_position("_perm", i + 1).cast("int"))).alias(f"_d{i}")
        for i in range(len(features))
    ]
    own = chains.select(key, F.element_at("_c", -1).alias("_x"), F.element_at("_c", 1).alias("_b"), *changes)
    means = own.groupBy(key).agg(
        F.max("_x").alias("score"), F.max("_b").alias("base_score"), *[(F.sum(f"_d{i}") / orders).alias(f"_d{i}") for i in range(len(features))]
    )
    pairs = [x for i, c in enumerate(features) for x in (F.lit(c), F.col(f"_d{i}"))]
    return means.select(key, "score", "base_score", F.create_map(*pairs).alias("contributions"))


def adds_up(contributions: str = "contributions", within: float = 1e-9) -> Column:
    """Whether a row's contributions sum to its score minus the base's."""
    total = F.aggregate(F.map_values(contributions), F.lit(0.0), lambda a, x: a + x)
    return F.abs(total - (F.col("score") - F.col("base_score"))) <= within


def mean_absolute(values: DataFrame, contributions: str = "contributions") -> DataFrame:
    """(feature, mean_abs, mean): the summary over all rows, largest first."""
    long = values.select(F.explode(contributions).alias("feature", "c"))
    return long.groupBy("feature").agg(F.avg(F.abs("c")).alias("mean_abs"), F.avg("c").alias("mean")).orderBy(F.desc("mean_abs"), "feature")


def linear_values(df: DataFrame, coefficients: list[float], names: list[str], means: list[float], key: str, features_col: str = "features") -> DataFrame:
    """Exact contributions ``coefficient * (x - mean)`` to the margin of a linear model."""
    x = vector_to_array(F.col(features_col))
    pairs = [v for i, (c, w, m) in enumerate(zip(names, coefficients, means)) for v in (F.lit(c), F.lit(float(w)) * (x[i] - F.lit(float(m))))]
    return df.select(key, F.create_map(*pairs).alias("contributions"))
