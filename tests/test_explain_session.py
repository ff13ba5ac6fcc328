"""Explanation helpers, session rules and training-input sizing."""

from __future__ import annotations

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from stressframe.operators import models as MD
from stressframe.operators.explain import linear_contributions, permute_column
from stressframe.session import ensure_checkpoint_dir


def test_permute_column_is_a_permutation(spark):
    df = spark.range(200).withColumn("v", (F.col("id") * 7) % 23).withColumn("w", F.col("id") * 2)
    out = permute_column(df, "v", "id", seed=3, rows_per_bucket=16)
    rows = out.collect()
    assert sorted(r.id for r in rows) == list(range(200))  # every key once
    assert sorted(r.v for r in rows) == sorted(r.v for r in df.collect())  # same multiset of values
    assert all(r.w == 2 * r.id for r in rows)  # other columns stay with their row
    assert sum(1 for r in rows if r.v != (r.id * 7) % 23) > 100  # values actually moved


def test_linear_contributions(spark):
    rows = [(float(i % 5), float(i % 3), 1 if i % 5 > 2 else 0) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = LogisticRegression(labelCol="y", regParam=0.1).fit(data)
    coefs = list(model.coefficients.toArray())
    out = linear_contributions(data, coefs, ["a", "b"]).first()
    got = {c.feature: c.contribution for c in out.contributions}
    assert got["a"] == pytest.approx(coefs[0] * out.a) and got["b"] == pytest.approx(coefs[1] * out.b)
    mags = [abs(c.contribution) for c in out.contributions]
    assert mags == sorted(mags, reverse=True)


def test_checkpoint_dir_comes_from_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert ensure_checkpoint_dir(spark).startswith(configured.rstrip("/")) or configured in ensure_checkpoint_dir(spark)


def test_materialize_depends_on_rows_only(spark):
    def layout(df):
        return [sorted(r.id for r in part) for part in df.rdd.glom().collect()]

    small = MD.materialize(spark.range(5000).repartition(8))
    assert small.rdd.getNumPartitions() == 1  # 5k rows: one task
    one = MD.materialize(spark.range(50_000).coalesce(1))
    seven = MD.materialize(spark.range(50_000).repartition(7))
    assert one.rdd.getNumPartitions() == 5 and layout(one) == layout(seven)
    assert MD.fit_concurrency(small) == spark.sparkContext.defaultParallelism
    assert MD.fit_concurrency(small, requested=2) == 2
