"""Queries: ROC-AUC, PR curve, best-F1 threshold, confusion, class report,
stratified split / fold counts, soft votes.

Model-free score: ``unified_stress_index`` against ``default_next_4_weeks`` on
the statement table, so the SQL oracle can check every metric exactly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stressframe.operators import metrics as M
from stressframe.operators.split import stratified_folds, stratified_split
from stressframe.operators.vote import soft_vote
from stressframe.plans.registry import query
from stressframe.plans.sql_fixtures import with_tables
from stressframe.schemas import TARGET_V1, TARGET_V2
from stressframe.sources.derive import risk_customer, stress_statement

W2 = with_tables("stress_statement")
W1 = with_tables("risk_customer")
SCORE = "unified_stress_index"
LABEL = TARGET_V2

_COUNTS = (
    "c AS (SELECT {by}CAST(unified_stress_index AS DOUBLE) AS score, "
    "COUNT(*) FILTER (WHERE default_next_4_weeks=1) AS pos, COUNT(*) FILTER (WHERE default_next_4_weeks=0) AS neg "
    "FROM stress_statement WHERE unified_stress_index IS NOT NULL GROUP BY {by}score)"
)


def _auc_sql(by: str = "") -> str:
    sel = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    auc = (
        "CASE WHEN SUM(pos)>0 AND SUM(neg)>0 THEN SUM(CAST(pos AS DOUBLE)*CAST(2*below+neg AS DOUBLE))"
        "/(2.0e0*SUM(pos)*SUM(neg)) END"
    )
    return (
        f"{W2}, {_COUNTS.format(by=sel)}, "
        f"r AS (SELECT *, COALESCE(SUM(neg) OVER ({part}ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c) "
        f"SELECT {sel}{auc} AS auc, CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives, "
        f"COALESCE({auc} > 0.7e0, FALSE) AS goal_met FROM r{grp}"
    )


@query("roc_auc", _auc_sql())
def q_roc_auc(spark, sf_dir):
    return M.roc_auc(stress_statement(spark, sf_dir), LABEL, SCORE)


@query("roc_auc_by_group", _auc_sql("employment_type"))
def q_roc_auc_by_group(spark, sf_dir):
    return M.roc_auc(stress_statement(spark, sf_dir), LABEL, SCORE, by=("employment_type",))


_PR = (
    f"{W2}, {_COUNTS.format(by='')}, "
    "r AS (SELECT score, SUM(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp, "
    "SUM(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp, SUM(pos) OVER () AS p FROM c), "
    "pr0 AS (SELECT score AS threshold, CAST(tp AS DOUBLE)/(tp+fp) AS precision, "
    "CASE WHEN p=0 THEN 1.0e0 ELSE CAST(tp AS DOUBLE)/p END AS recall FROM r), "
    "pr AS (SELECT *, (2*recall*precision)/(recall+precision+1e-10) AS f1 FROM pr0), "
    "best AS (SELECT * FROM pr ORDER BY f1 DESC, threshold ASC LIMIT 1), "
    "pred AS (SELECT default_next_4_weeks AS actual, "
    "CAST(COALESCE(unified_stress_index >= (SELECT threshold FROM best), FALSE) AS INT) AS predicted FROM stress_statement)"
)


@query("pr_curve", f"{_PR} SELECT threshold, precision, recall, f1 FROM pr")
def q_pr_curve(spark, sf_dir):
    return M.pr_curve(stress_statement(spark, sf_dir), LABEL, SCORE)


@query("best_f1_threshold", f"{_PR} SELECT threshold, f1, precision, recall FROM best")
def q_best_f1(spark, sf_dir):
    return M.best_f1_threshold(stress_statement(spark, sf_dir), LABEL, SCORE)


def _predicted(spark, sf_dir):
    df = stress_statement(spark, sf_dir)
    # the fitted threshold is one scalar: applied as a literal (JOIN-3)
    t = M.best_f1_threshold(df, LABEL, SCORE).first()["threshold"]
    return df.withColumn("predicted", M.predict_label(SCORE, float(t)))


@query(
    "confusion",
    f"""{_PR} SELECT v.actual, v.predicted, CAST(COALESCE(n.n_rows, 0) AS BIGINT) AS n_rows
    FROM (VALUES (0,0),(0,1),(1,0),(1,1)) v(actual, predicted)
    LEFT JOIN (SELECT actual, predicted, COUNT(*) AS n_rows FROM pred GROUP BY ALL) n
    ON n.actual=v.actual AND n.predicted=v.predicted""",
)
def q_confusion(spark, sf_dir):
    return M.confusion(_predicted(spark, sf_dir), LABEL, "predicted")


def _report_sql(pred_cte: str) -> str:
    def safe(num, den):
        return f"CASE WHEN {den}>0 THEN CAST({num} AS DOUBLE)/({den}) ELSE 0.0e0 END"

    p0, r0, f0 = safe("c00", "c00+c10"), safe("c00", "c00+c01"), safe("2*c00", "2*c00+c10+c01")
    p1, r1, f1 = safe("c11", "c11+c01"), safe("c11", "c11+c10"), safe("2*c11", "2*c11+c01+c10")
    n = "(c00+c01+c10+c11)"
    w = lambda a, b: f"CASE WHEN {n}>0 THEN (({a})*(c00+c01)+({b})*(c11+c10))/{n} ELSE 0.0e0 END"
    return f"""{pred_cte}, cm AS (SELECT COUNT(*) FILTER (WHERE actual=0 AND predicted=0) AS c00,
      COUNT(*) FILTER (WHERE actual=0 AND predicted=1) AS c01, COUNT(*) FILTER (WHERE actual=1 AND predicted=0) AS c10,
      COUNT(*) FILTER (WHERE actual=1 AND predicted=1) AS c11 FROM pred)
    SELECT '0' AS class, {p0} AS precision, {r0} AS recall, {f0} AS f1, c00+c01 AS support FROM cm
    UNION ALL SELECT '1', {p1}, {r1}, {f1}, c11+c10 FROM cm
    UNION ALL SELECT 'accuracy', NULL, NULL, {safe('c00+c11', n)}, {n} FROM cm
    UNION ALL SELECT 'macro avg', ({p0}+{p1})/2, ({r0}+{r1})/2, ({f0}+{f1})/2, {n} FROM cm
    UNION ALL SELECT 'weighted avg', {w(p0, p1)}, {w(r0, r1)}, {w(f0, f1)}, {n} FROM cm"""


@query("class_report", _report_sql(_PR))
def q_class_report(spark, sf_dir):
    return M.class_report(_predicted(spark, sf_dir), LABEL, "predicted")


_HALF = (
    f"{W2}, pred AS (SELECT default_next_4_weeks AS actual, "
    "CAST(COALESCE(unified_stress_index > 0.5e0, FALSE) AS INT) AS predicted FROM stress_statement)"
)


@query("class_report_at_half", _report_sql(_HALF))
def q_class_report_half(spark, sf_dir):
    df = stress_statement(spark, sf_dir).withColumn("predicted", M.predict_label(SCORE, 0.5, strict=True))
    return M.class_report(df, LABEL, "predicted")


@query(
    "recall_at_threshold",
    f"""{_PR} SELECT CASE WHEN COUNT(*) FILTER (WHERE actual=1)>0 THEN
      CAST(COUNT(*) FILTER (WHERE actual=1 AND predicted=1) AS DOUBLE)/COUNT(*) FILTER (WHERE actual=1) ELSE 0.0e0 END AS recall,
      COUNT(*) FILTER (WHERE actual=1) AS support FROM pred""",
)
def q_recall(spark, sf_dir):
    return M.recall_of(_predicted(spark, sf_dir), LABEL, "predicted")


# Fold and split sizes are a pure function of the per-label counts: fold f of
# a label with n rows holds (n - f + k - 1) div k rows.
@query(
    "stratified_fold_counts",
    f"""{W2}, n AS (SELECT default_next_4_weeks, COUNT(*) AS n FROM stress_statement GROUP BY 1)
    SELECT default_next_4_weeks, CAST(f.fold AS INT) AS fold, CAST((n - f.fold + 4) // 5 AS BIGINT) AS n_rows
    FROM n CROSS JOIN (SELECT range AS fold FROM range(5)) f""",
)
def q_fold_counts(spark, sf_dir):
    folds = stratified_folds(stress_statement(spark, sf_dir), LABEL, "statement_id", k=5, seed=42)
    return folds.groupBy(LABEL, "fold").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "stratified_folds",
    f"{W2}, r AS (SELECT statement_id, default_next_4_weeks, ROW_NUMBER() OVER (PARTITION BY default_next_4_weeks "
    "ORDER BY SUBSTR(MD5(CAST(statement_id AS VARCHAR) || '|42'), 1, 15), statement_id) AS k FROM stress_statement) "
    "SELECT statement_id, default_next_4_weeks, CAST((k - 1) % 5 AS INT) AS fold FROM r",
)
def q_folds(spark, sf_dir):
    return stratified_folds(stress_statement(spark, sf_dir), LABEL, "statement_id", k=5, seed=42).select(
        "statement_id", LABEL, "fold"
    )


@query(
    "stratified_split_counts",
    f"""{W1}, n AS (SELECT default_next_30_days, COUNT(*) AS n FROM risk_customer GROUP BY 1)
    SELECT default_next_30_days, t.is_test,
      CAST(CASE WHEN t.is_test=1 THEN FLOOR(0.2e0*n+0.5e0) ELSE n-FLOOR(0.2e0*n+0.5e0) END AS BIGINT) AS n_rows
    FROM n CROSS JOIN (VALUES (0),(1)) t(is_test)""",
)
def q_split_counts(spark, sf_dir):
    split = stratified_split(risk_customer(spark, sf_dir), TARGET_V1, "customer_id", 0.2, 42)
    return split.groupBy(TARGET_V1, "is_test").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "stratified_split",
    f"{W1}, r AS (SELECT customer_id, default_next_30_days, ROW_NUMBER() OVER (PARTITION BY default_next_30_days "
    "ORDER BY SUBSTR(MD5(CAST(customer_id AS VARCHAR) || '|42'), 1, 15), customer_id) AS k, "
    "COUNT(*) OVER (PARTITION BY default_next_30_days) AS n FROM risk_customer) "
    "SELECT customer_id, default_next_30_days, CAST(CASE WHEN k <= FLOOR(0.2e0*n + 0.5e0) THEN 1 ELSE 0 END AS INT) AS is_test FROM r",
)
def q_split(spark, sf_dir):
    return stratified_split(risk_customer(spark, sf_dir), TARGET_V1, "customer_id", 0.2, 42).select(
        "customer_id", TARGET_V1, "is_test"
    )


# Model-free stand-in scores in [0, 1] for the vote operators (MOD-13, MOD-14).
_VOTE_COLS = {
    "p_stress": "unified_stress_index",
    "p_shock": "behavioral_shock_index",
    "p_decline": "savings_decline_pct",
    "p_momentum": "(stress_momentum_score+1)/2",
    "p_liquidity": "1-liquidity_ratio/4",
}
_VOTE_WEIGHTS = (3, 2, 2, 1, 1)


def _vote_frame(spark, sf_dir):
    df = stress_statement(spark, sf_dir)
    return df.select(
        "statement_id",
        F.col("unified_stress_index").alias("p_stress"),
        F.col("behavioral_shock_index").alias("p_shock"),
        F.col("savings_decline_pct").alias("p_decline"),
        ((F.col("stress_momentum_score") + 1) / 2).alias("p_momentum"),
        (1 - F.col("liquidity_ratio") / 4).alias("p_liquidity"),
    )


def _vote_sql(weights) -> str:
    num = " + ".join(f"({w}*({e}))" for w, e in zip(weights, _VOTE_COLS.values()))
    return f"{W2} SELECT statement_id, ({num})/{float(sum(weights))}e0 AS probability FROM stress_statement"


@query("soft_vote", _vote_sql(_VOTE_WEIGHTS))
def q_soft_vote(spark, sf_dir):
    return soft_vote(_vote_frame(spark, sf_dir), list(_VOTE_COLS), list(_VOTE_WEIGHTS)).select("statement_id", "probability")


@query(
    "mean_vote",
    f"{W2} SELECT statement_id, (unified_stress_index + behavioral_shock_index)/2 AS probability FROM stress_statement",
)
def q_mean_vote(spark, sf_dir):
    return soft_vote(_vote_frame(spark, sf_dir), ["p_stress", "p_shock"]).select("statement_id", "probability")
