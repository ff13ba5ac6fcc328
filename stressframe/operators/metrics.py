"""Ranking and threshold metrics over (label, score) columns (MET-1..9).

Everything starts from one aggregation per distinct score (positives,
negatives): heavy ties collapse map-side, and the ordered sweeps (ROC area, PR
curve) run as distributed running sums (``prefix.running_totals``) instead of a
global window. AUC is exact (ties count one half), equal to scikit-learn's
``roc_auc_score`` and to ``BinaryClassificationEvaluator(numBins=0)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stressframe.operators.prefix import running_totals

F1_EPS = 1e-10
# The goal AUCs of the reference (OOF goal, clean-data ceiling goal).
GOAL_AUC = 0.70
CEILING_GOAL_AUC = 0.75


def score_counts(df: DataFrame, label: str, score: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, score, pos, neg): one row per distinct non-null score."""
    s = F.col(score).cast("double")
    return (
        df.select(*by, s.alias("score"), F.col(label).alias("_label"))
        .where(F.col("score").isNotNull() & ~F.isnan("score"))
        .groupBy(*by, "score")
        .agg(F.count_if(F.col("_label") == 1).alias("pos"), F.count_if(F.col("_label") == 0).alias("neg"))
    )


def roc_auc(df: DataFrame, label: str, score: str, by: tuple[str, ...] = (), goal: float = GOAL_AUC) -> DataFrame:
    """(*by, auc, positives, negatives, goal_met); auc NULL when a class is absent."""
    counts = score_counts(df, label, score, by)
    run = running_totals(counts, "score", ["neg"], by=by)
    below = F.col("cum_neg") - F.col("neg")
    # doubles: exact below 2^53 (any order), no long overflow at P*N ~ 1e24
    twice_u = F.col("pos").cast("double") * (below * 2 + F.col("neg")).cast("double")
    agg = run.groupBy(*by).agg(
        F.sum(twice_u).alias("_u2"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    )
    p, n = F.col("positives"), F.col("negatives")
    auc = F.when((p > 0) & (n > 0), F.col("_u2") / (F.lit(2.0) * p * n))
    return agg.select(*by, auc.alias("auc"), "positives", "negatives", goal_met(auc, goal).alias("goal_met"))


def goal_met(metric: Column, goal: float = GOAL_AUC) -> Column:
    """Strictly above the goal (MET-9)."""
    return F.coalesce(metric > goal, F.lit(False))


def pr_curve(df: DataFrame, label: str, score: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, threshold, precision, recall, f1) per distinct score; a row is
    predicted positive when ``score >= threshold``. Recall is 1 when there are
    no positives (scikit-learn's convention)."""
    counts = score_counts(df, label, score, by)
    run = running_totals(counts, "score", ["pos", "neg"], by=by)
    tp = F.col("total_pos") - (F.col("cum_pos") - F.col("pos"))
    fp = F.col("total_neg") - (F.col("cum_neg") - F.col("neg"))
    out = run.select(*by, F.col("score").alias("threshold"), tp.alias("_tp"), fp.alias("_fp"), F.col("total_pos").alias("_p"))
    precision = F.col("_tp") / (F.col("_tp") + F.col("_fp"))
    recall = F.when(F.col("_p") == 0, F.lit(1.0)).otherwise(F.col("_tp") / F.col("_p"))
    out = out.select(*by, "threshold", precision.alias("precision"), recall.alias("recall"))
    f1 = (F.lit(2) * F.col("recall") * F.col("precision")) / (F.col("recall") + F.col("precision") + F1_EPS)
    return out.withColumn("f1", f1)


def best_f1_threshold(df: DataFrame, label: str, score: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, threshold, f1, precision, recall) at the largest F1; ties go to the
    lowest threshold (first argmax over ascending thresholds)."""
    curve = pr_curve(df, label, score, by)
    best = F.max_by(
        F.struct("threshold", "f1", "precision", "recall"), F.struct(F.col("f1"), -F.col("threshold"))
    )
    return curve.groupBy(*by).agg(best.alias("b")).select(*by, "b.*")


def predict_label(score: str | Column, threshold: str | Column | float, strict: bool = False) -> Column:
    """0/1 prediction: ``score >= t`` (tuned threshold) or ``score > t`` (stack, 0.5)."""
    s = F.col(score) if isinstance(score, str) else score
    t = F.col(threshold) if isinstance(threshold, str) else (threshold if isinstance(threshold, Column) else F.lit(threshold))
    return F.coalesce(s > t if strict else s >= t, F.lit(False)).cast("int")


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """(actual, predicted, n_rows) for all four cells, absent cells 0 (MET-6)."""
    spark = df.sparkSession
    counts = df.groupBy(F.col(label).alias("actual"), F.col(pred).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    cells = spark.createDataFrame([(a, p) for a in (0, 1) for p in (0, 1)], "actual int, predicted int")
    return cells.join(counts, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows")
    )


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class precision, recall, F1, support; accuracy; macro and weighted
    averages; 0/0 -> 0 (MET-7). Built from the four confusion cells in one pass."""
    cm = df.agg(
        *[
            F.count_if((F.col(label) == a) & (F.col(pred) == p)).alias(f"c{a}{p}")
            for a in (0, 1)
            for p in (0, 1)
        ]
    )

    def safe(num: Column, den: Column) -> Column:
        return F.when(den > 0, num / den).otherwise(F.lit(0.0))

    c = {k: F.col(k) for k in ("c00", "c01", "c10", "c11")}
    rows = []
    per = {}
    for k in (0, 1):
        tp = c[f"c{k}{k}"]
        fp = c[f"c{1 - k}{k}"]
        fn = c[f"c{k}{1 - k}"]
        prec = safe(tp, tp + fp)
        rec = safe(tp, tp + fn)
        f1 = safe(tp * 2, tp * 2 + fp + fn)
        sup = tp + fn
        per[k] = (prec, rec, f1, sup)
        rows.append(F.struct(F.lit(str(k)).alias("class"), prec.alias("precision"), rec.alias("recall"),
                             f1.alias("f1"), sup.alias("support")))
    n = c["c00"] + c["c01"] + c["c10"] + c["c11"]
    acc = safe(c["c00"] + c["c11"], n)
    rows.append(F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                         F.lit(None).cast("double").alias("recall"), acc.alias("f1"), n.alias("support")))
    macro = [(per[0][i] + per[1][i]) / 2 for i in range(3)]
    rows.append(F.struct(F.lit("macro avg").alias("class"), macro[0].alias("precision"), macro[1].alias("recall"),
                         macro[2].alias("f1"), n.alias("support")))
    weighted = [safe(per[0][i] * per[0][3] + per[1][i] * per[1][3], n) for i in range(3)]
    rows.append(F.struct(F.lit("weighted avg").alias("class"), weighted[0].alias("precision"),
                         weighted[1].alias("recall"), weighted[2].alias("f1"), n.alias("support")))
    return cm.select(F.inline(F.array(*rows)))


def recall_of(df: DataFrame, label: str, pred: str, positive: int = 1) -> DataFrame:
    """Recall of one class (MET-8)."""
    agg = df.agg(
        F.count_if((F.col(label) == positive) & (F.col(pred) == positive)).alias("tp"),
        F.count_if(F.col(label) == positive).alias("support"),
    )
    return agg.select(F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0)).alias("recall"), "support")
