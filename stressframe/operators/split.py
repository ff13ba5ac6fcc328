"""Deterministic stratified splits and folds (SPL-1..3).

Rows are ordered within their label by the first 60 bits of
``md5(key|...|seed)`` (a hash every SQL engine has; ties broken by the key), ranked with distributed running counts, and assigned
``fold = (rank - 1) mod k``: every fold gets floor or ceil of n_label / k rows
of each label, the assignment is a pure function of (key, seed) and so is
stable under retries and re-partitioning.

Two labels give only two rank groups, so ranking uses contiguous hash-prefix
buckets (``shiftright(hash, 60 - bits)`` is monotone in the hash): each bucket
ranks its own rows and adds the row count of the lower buckets, so no task
holds a whole label.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stressframe.operators.prefix import ROWS_PER_BUCKET, null_safe, running_totals

DEFAULT_SEED = 42
HASH_BITS = 60


def order_hash(keys: list[str], seed: int):
    """First ``HASH_BITS`` bits of ``md5(keys|seed)`` as a long."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(F.encode(text, "UTF-8")), 1, HASH_BITS // 4), 16, 10).cast("long")


def hash_rank(df: DataFrame, keys: list[str], seed: int, by: tuple[str, ...], rows_per_bucket: int) -> DataFrame:
    """Add ``_rank`` (1-based, within ``by``, in ``md5(keys|seed)`` order, ties by key) and ``_n`` (group size). Buckets are hash prefixes sized from
    one count, so each window partition holds about ``rows_per_bucket`` rows."""
    n = df.count()
    bits = max(0, math.ceil(math.log2(max(1.0, n / rows_per_bucket))))
    keyed = df.withColumn("_h", order_hash(keys, seed)).withColumn("_one", F.lit(1))
    if bits > 0:
        keyed = keyed.withColumn("_b", F.shiftright(F.col("_h"), HASH_BITS - bits))
        ranked = running_totals(keyed, ["_h", *keys], ["_one"], by=by, bucket_col="_b").drop("_b")
    else:
        ranked = running_totals(keyed, ["_h", *keys], ["_one"], by=by, single_bucket=True)
    return ranked.withColumnRenamed("cum__one", "_rank").withColumnRenamed("total__one", "_n").drop("_h", "_one")


def stratified_folds(
    df: DataFrame,
    label: str,
    key: str | list[str],
    k: int = 5,
    seed: int = DEFAULT_SEED,
    group: str | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add ``fold`` in 0..k-1, stratified by ``label``.

    With ``group`` (e.g. customer_id), folds are assigned per group instead
    (all rows of a group share a fold; not label-stratified), so one entity
    never sits on both sides of a split.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if group is not None:
        groups = df.select(group).distinct()
        ranked = hash_rank(groups, [group], seed, (), rows_per_bucket)
        folds = ranked.select(group, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int").alias("fold"))
        return df.alias("r").join(folds.alias("f"), null_safe("r", "f", [group])).select("r.*", "f.fold")
    ranked = hash_rank(df, keys, seed, (label,), rows_per_bucket)
    return ranked.withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_rank", "_n")


def stratified_split(
    df: DataFrame,
    label: str,
    key: str | list[str],
    test_fraction: float = 0.2,
    seed: int = DEFAULT_SEED,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add ``is_test``: the first ``round(test_fraction * n_label)`` rows of
    each label in hash order are the test set."""
    keys = [key] if isinstance(key, str) else list(key)
    ranked = hash_rank(df, keys, seed, (label,), rows_per_bucket)
    n_test = F.floor(F.lit(float(test_fraction)) * F.col("_n") + F.lit(0.5))
    return ranked.withColumn("is_test", (F.col("_rank") <= n_test).cast("int")).drop("_rank", "_n")
