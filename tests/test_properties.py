"""Properties of the distributed operators, forced onto many buckets so the
bucketed paths (offsets across buckets) are exercised on small data."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stressframe.operators import metrics as M
from stressframe.operators.features import ClipLimits
from stressframe.operators.prefix import running_totals
from stressframe.operators.quantile import exact_quantiles
from stressframe.operators.split import stratified_folds, stratified_split


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(7)
    n = 600
    label = rng.integers(0, 2, n)
    score = np.round(rng.normal(label * 0.8, 1.0), 1)  # many ties
    # + 0.0 turns -0.0 into 0.0: the RDD-based evaluator keys them apart, SQL grouping does not
    rows = [(int(i), int(l), float(s) + 0.0) for i, (l, s) in enumerate(zip(label, score))]
    return spark.createDataFrame(rows, "id long, label int, score double"), rows


def test_running_totals_many_buckets(spark, scored):
    df, rows = scored
    counts = df.groupBy("score").agg(F.count(F.lit(1)).alias("w"))
    out = running_totals(counts, "score", ["w"], rows_per_bucket=5).orderBy("score").collect()
    assert len(out) == counts.count()
    expect = np.cumsum([r.w for r in out])
    assert [r.cum_w for r in out] == list(expect)
    assert all(r.total_w == len(rows) for r in out)


def test_exact_quantiles_match_numpy(spark, scored):
    df, rows = scored
    vals = np.array([r[2] for r in rows])
    probs = [0.0, 0.25, 0.5, 0.99, 1.0]
    got = {r.prob: r.value for r in exact_quantiles(df, ["score"], probs, gather=2).collect()}
    assert set(got) == set(probs)
    for q, v in got.items():
        assert v == pytest.approx(float(np.quantile(vals, q)), abs=1e-12)


def test_clip_idempotent_and_persistent(spark, scored, tmp_dir):
    df, _ = scored
    model = ClipLimits(inputCols=["score"], quantile=0.9).fit(df)
    once = model.transform(df)
    twice = model.transform(once)
    assert once.agg(F.max("score")).first()[0] == twice.agg(F.max("score")).first()[0]
    from stressframe.operators.features import ClipLimitsModel

    model.write().overwrite().save(f"{tmp_dir}/clip")
    assert ClipLimitsModel.load(f"{tmp_dir}/clip").limits() == model.limits()


def _brute_auc(rows):
    pos = np.array([s for _, l, s in rows if l == 1])
    neg = np.array([s for _, l, s in rows if l == 0])
    gt = (pos[:, None] > neg[None, :]).sum()
    eq = (pos[:, None] == neg[None, :]).sum()
    return (gt + 0.5 * eq) / (len(pos) * len(neg))


def test_auc_brute_force_and_monotone(spark, scored):
    df, rows = scored
    auc = M.roc_auc(df, "label", "score").first().auc
    assert auc == pytest.approx(_brute_auc(rows), abs=1e-12)
    mono = df.withColumn("score", F.exp(F.col("score") * 3) + 7)
    assert M.roc_auc(mono, "label", "score").first().auc == pytest.approx(auc, abs=1e-12)
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0)
    assert ev.evaluate(df.withColumn("label", F.col("label").cast("double"))) == pytest.approx(auc, abs=1e-12)


def test_auc_by_group(spark, scored):
    df, rows = scored
    g = df.withColumn("g", (F.col("id") % 3).cast("int"))
    got = {r.g: r.auc for r in M.roc_auc(g, "label", "score", by=("g",)).collect()}
    for k in range(3):
        sub = [r for r in rows if r[0] % 3 == k]
        assert got[k] == pytest.approx(_brute_auc(sub), abs=1e-12)


def test_pr_curve_against_brute_force(spark, scored):
    df, rows = scored
    curve = {r.threshold: r for r in M.pr_curve(df, "label", "score").collect()}
    P = sum(1 for r in rows if r[1] == 1)
    for t in list(curve)[:25]:
        tp = sum(1 for r in rows if r[2] >= t and r[1] == 1)
        fp = sum(1 for r in rows if r[2] >= t and r[1] == 0)
        assert curve[t].precision == pytest.approx(tp / (tp + fp))
        assert curve[t].recall == pytest.approx(tp / P)


def test_confusion_sums_to_n(spark, scored):
    df, rows = scored
    pred = df.withColumn("p", M.predict_label("score", 0.3))
    assert sum(r.n_rows for r in M.confusion(pred, "label", "p").collect()) == len(rows)


def test_folds_disjoint_complete_balanced(spark, scored):
    df, rows = scored
    folds = stratified_folds(df, "label", "id", k=5, seed=42, rows_per_bucket=16)
    got = folds.select("id", "label", "fold").collect()
    assert len(got) == len(rows) and len({r.id for r in got}) == len(rows)
    for lab in (0, 1):
        sizes = [sum(1 for r in got if r.label == lab and r.fold == f) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1
    again = stratified_folds(df.repartition(3), "label", "id", k=5, seed=42, rows_per_bucket=16)
    assert {(r.id, r.fold) for r in again.collect()} == {(r.id, r.fold) for r in got}


def test_group_folds_keep_groups_together(spark, scored):
    df, _ = scored
    g = df.withColumn("cust", (F.col("id") % 37))
    folds = stratified_folds(g, "label", "id", k=5, group="cust", rows_per_bucket=4)
    per = folds.groupBy("cust").agg(F.countDistinct("fold").alias("n")).agg(F.max("n")).first()[0]
    assert per == 1


def test_split_fraction(spark, scored):
    df, rows = scored
    s = stratified_split(df, "label", "id", 0.2, 42, rows_per_bucket=16).collect()
    for lab in (0, 1):
        n = sum(1 for r in rows if r[1] == lab)
        t = sum(1 for r in s if r.label == lab and r.is_test == 1)
        assert t == int(np.floor(0.2 * n + 0.5))


def test_null_keys_survive_both_paths(spark):
    """Rows with a NULL group key are a group like any other, whatever the bucket size."""
    from pyspark.sql import functions as F

    rows = [(i, None if i % 10 == 0 else i % 2, None if i % 7 == 0 else i % 5, float(i * 37 % 101)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, label int, grp int, x double")
    for make in (
        lambda n: stratified_folds(df, "label", "id", k=5, seed=42, **n),
        lambda n: stratified_split(df, "label", "id", 0.2, 42, **n),
        lambda n: stratified_folds(df, "label", "id", k=3, group="grp", **n),
        lambda n: running_totals(df.withColumn("w", F.lit(1)).withColumn("o", F.col("x") * 1000 + F.col("id")), "o", ["w"], by=("label",), **n),
        lambda n: running_totals(df.withColumn("w", F.lit(2)).withColumn("o", F.col("id")), "o", ["w"], by=("grp", "label"), **n),
    ):
        whole = sorted(make({}).collect(), key=lambda r: r.id)
        cut = make({"rows_per_bucket": 50})
        assert len(whole) == 1000
        assert sorted(cut.select(*make({}).columns).collect(), key=lambda r: r.id) == whole


def test_exact_quantiles_narrow_and_group(spark):
    """Brackets are narrowed until few values are left; NULL, NaN and NULL groups are handled."""
    import numpy as np

    rng = np.random.default_rng(5)
    vals = np.round(rng.normal(size=4000) * 50, 1)
    rows = [(None if i % 9 == 0 else i % 2, None if i % 50 == 0 else float("nan") if i % 50 == 1 else float(v), 1.5) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "g int, x double, c double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.99, 1.0]
    for gather in (3, 10_000):
        got = {(r.g, r.column, r.prob): r.value for r in exact_quantiles(df, ["x", "c"], probs, by=("g",), gather=gather).collect()}
        for g in (None, 0, 1):
            own = [x for k, x, _ in rows if k == g and x is not None and x == x]
            for p in probs:
                assert got[g, "x", p] == pytest.approx(float(np.quantile(own, p)), abs=1e-9)
                assert got[g, "c", p] == 1.5


def test_ratio6_is_exact_for_large_sums(spark):
    from fractions import Fraction

    from pyspark.sql import functions as F

    from stressframe.functions.exact import ratio6

    pairs = [(405415943610, 820602924003), (5 * 10**12, 10**13), (-7 * 10**15, 3), (10**13 - 1, 10**13), (0, 5), (1, 3), (9 * 10**17, 10**12)]
    df = spark.createDataFrame(pairs, "a long, b long")
    for r in df.select("a", "b", ratio6(F.col("a"), F.col("b")).alias("r")).collect():
        x = Fraction(r.a, r.b) * 10**6
        k = int(abs(x) + Fraction(1, 2)) * (-1 if x < 0 else 1)
        assert r.r == float(k) / 1e6
