"""Queries: risk tiers, calibration, factors, verdicts, actions, scenarios.

Model-free base probability: ``unified_stress_index`` (a 0..1 stress score),
so every rule is checked exactly against SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stressframe.operators import policy as P
from stressframe.operators.features import add_features
from stressframe.plans import sql_features as S
from stressframe.plans.registry import query
from stressframe.plans.sql_fixtures import with_tables
from stressframe.sources.derive import stress_statement

W2 = with_tables("stress_statement")
BASE = "unified_stress_index"


def scored(spark, sf_dir):
    """Statements with v2 features and the full policy assessment."""
    return P.assess(add_features(stress_statement(spark, sf_dir), "v2"), BASE)


# The SQL below writes out every cut, impact, text and scenario value itself; none comes
# from the code under test.
def _tier(x: str) -> str:
    return f"CASE WHEN {x} < 0.3e0 THEN 'Low' WHEN {x} < 0.6e0 THEN 'Medium' WHEN {x} < 0.8e0 THEN 'High' ELSE 'Critical' END"


def _status(x: str) -> str:
    return f"CASE WHEN {x} < 0.3e0 THEN 'Low Risk' WHEN {x} < 0.7e0 THEN 'Monitor Closely' ELSE 'CRITICAL ALERT' END"


_PEN = "CASE WHEN liquidity_ratio < 1.5e0 THEN (1.5e0-liquidity_ratio)*(1.5e0-liquidity_ratio) ELSE 0.0e0 END"
_M = "(savings_balance/(total_spend+1.0e0))"
_DAMP = f"CASE WHEN {_M} < 1.0e0 THEN 1.0e0+(1.0e0-{_M}) WHEN {_M} > 3.0e0 THEN 0.5e0 ELSE 1.0e0 END"
_RAW = f"(({BASE} + ({_PEN}*0.8e0)*({_DAMP})) + unified_stress_index*0.15e0)"
_LOW = f"CASE WHEN {_RAW} < 0.0e0 THEN 0.0e0 ELSE {_RAW} END"
_FINAL = f"CASE WHEN ({_LOW}) > 0.99e0 THEN 0.99e0 ELSE ({_LOW}) END"
_SCORED = f"{W2}, s AS (SELECT *, {S.select_list(S.V2)}, {_FINAL} AS final_probability FROM stress_statement)"


@query(
    "risk_tier",
    f"{W2} SELECT statement_id, {BASE} AS base_probability, {_tier(BASE)} AS risk_tier FROM stress_statement",
)
def q_risk_tier(spark, sf_dir):
    df = stress_statement(spark, sf_dir)
    return df.select("statement_id", F.col(BASE).alias("base_probability"), P.risk_tier(BASE).alias("risk_tier"))


@query(
    "calibrated_probability",
    f"""{_SCORED} SELECT statement_id, {_PEN} AS liquidity_penalty, {_DAMP} AS savings_dampener,
    final_probability, {_status('final_probability')} AS status,
    CASE WHEN final_probability*100 < 30 THEN 'lightgreen' WHEN final_probability*100 < 70 THEN 'yellow' ELSE 'red' END AS gauge_band,
    COALESCE(final_probability*100 >= 70, FALSE) AS gauge_alarm FROM s""",
)
def q_calibrated(spark, sf_dir):
    df = stress_statement(spark, sf_dir)
    out = df.select(
        "statement_id",
        P.liquidity_penalty().alias("liquidity_penalty"),
        P.savings_dampener().alias("savings_dampener"),
        P.calibrated_probability(BASE).alias("final_probability"),
    )
    return out.select(
        "*",
        P.status("final_probability").alias("status"),
        P.gauge_band("final_probability").alias("gauge_band"),
        P.gauge_alarm("final_probability").alias("gauge_alarm"),
    )


@query(
    "risk_tier_counts",
    f"{_SCORED} SELECT {_tier('final_probability')} AS risk_tier, COUNT(*) AS n_rows FROM s GROUP BY 1",
)
def q_tier_counts(spark, sf_dir):
    return scored(spark, sf_dir).groupBy("risk_tier").agg(F.count(F.lit(1)).alias("n_rows"))


_RULES_SQL = (  # name, impact, rule, in declared order
    ("High Financial Stress", 30, "unified_stress_index > 0.5e0"),
    ("Gambling Activity", 50, "gambling_ratio > 0.05e0"),
    ("Delayed Salary Crunch", 25, "delayed_liquidity_crunch > 1.0e0"),
    ("Overspending (Deficit)", 20, "total_spend > monthly_income"),
    ("Missed Auto-Debits", 40, "failed_autodebit_count > 0"),
    ("Strong Liquidity Buffer", -40, "liquidity_ratio > 2.0e0"),
    ("Healthy Savings", -20, "savings_balance > 3000"),
    ("Low Credit Utilization", -15, "credit_utilization_ratio < 0.3e0"),
)
_FIRED = " UNION ALL ".join(
    f"SELECT statement_id, '{name}' AS factor, {impact} AS impact, {i} AS ord FROM s WHERE COALESCE({rule}, FALSE)"
    for i, (name, impact, rule) in enumerate(_RULES_SQL)
)
_FACTORS = f"""{_SCORED}, fired AS ({_FIRED}),
ranked AS (SELECT statement_id, factor, impact,
  CAST(ROW_NUMBER() OVER (PARTITION BY statement_id ORDER BY ABS(impact) DESC, ord) AS INT) AS factor_rank FROM fired)"""


@query(
    "risk_factors",
    f"""{_FACTORS} SELECT s.statement_id, r.factor_rank, r.factor, r.impact
    FROM s LEFT JOIN ranked r ON r.statement_id=s.statement_id""",
)
def q_risk_factors(spark, sf_dir):
    df = scored(spark, sf_dir).select("statement_id", "factors")
    return df.select("statement_id", F.posexplode_outer("factors").alias("pos", "f")).select(
        "statement_id",
        F.when(F.col("f").isNotNull(), (F.col("pos") + 1)).cast("int").alias("factor_rank"),
        F.col("f.factor").alias("factor"),
        F.col("f.impact").alias("impact"),
    )


_VERDICT = f"""CASE WHEN final_probability > 0.5e0 THEN 'High Risk Detected'
  WHEN EXISTS (SELECT 1 FROM fired f WHERE f.statement_id=s.statement_id AND f.impact > 0) THEN 'Watchlist: Risk is low, but issues detected.'
  ELSE 'Healthy Profile: User is financially stable.' END"""


@query(
    "verdict",
    f"{_FACTORS} SELECT statement_id, final_probability, {_tier('final_probability')} AS risk_tier, "
    f"{_VERDICT} AS verdict FROM s",
)
def q_verdict(spark, sf_dir):
    return scored(spark, sf_dir).select("statement_id", "final_probability", "risk_tier", "verdict")


_ACTIONS_SQL = """SELECT statement_id, 0 AS ord, 'Urgent: Gambling is driving risk. Block merchant codes.' AS action FROM fired WHERE factor='Gambling Activity'
UNION ALL SELECT statement_id, 1, 'Urgent: Immediate funds needed to prevent delinquency.' FROM fired WHERE factor='Missed Auto-Debits'
UNION ALL SELECT statement_id, 2, 'Action: Salary is delayed. Suggest temporary overdraft protection.' FROM fired WHERE factor='Delayed Salary Crunch'
UNION ALL SELECT statement_id, 3, 'Advice: Reduce discretionary spend to close monthly deficit.' FROM fired WHERE factor='Overspending (Deficit)'"""


@query(
    "actions",
    f"""{_FACTORS}, a AS ({_ACTIONS_SQL})
    SELECT statement_id, CAST(ROW_NUMBER() OVER (PARTITION BY statement_id ORDER BY ord) AS INT) AS action_rank, action FROM a""",
)
def q_actions(spark, sf_dir):
    df = scored(spark, sf_dir).select("statement_id", "actions")
    return df.select("statement_id", F.posexplode("actions").alias("pos", "action")).select(
        "statement_id", (F.col("pos") + 1).cast("int").alias("action_rank"), "action"
    )


def _scenario_sql() -> str:
    cols = ["monthly_income", "total_spend", "liquidity_ratio", "unified_stress_index", "stress_momentum_score",
            "behavioral_shock_index", "gambling_spend", "salary_delay_days", "failed_autodebit_count", "savings_balance"]
    rows = (
        "('Safe', 8000e0, 3000e0, 4.0e0, 0.1e0, -0.5e0, 0.0e0, 0e0, 0, 0, 15000e0, 0.3e0), "
        "('Risky', 5000e0, 4900e0, 1.1e0, 0.65e0, 0.4e0, 0.5e0, 400e0, 4, 2, 800e0, 0.3e0), "
        "('Crisis', 4000e0, 6000e0, 0.6e0, 0.95e0, 0.9e0, 0.9e0, 2500e0, 20, 6, 0e0, 0.3e0)"
    )
    scen = (
        f"scen_raw AS (SELECT * FROM (VALUES {rows}) t(profile, {', '.join(cols)}, credit_utilization_ratio)), "
        f"scen AS (SELECT *, {S.V2['gambling_ratio']} AS gambling_ratio, {_FINAL} AS final_probability FROM scen_raw)"
    )
    return (
        f"{_SCORED}, {scen} SELECT profile, final_probability, {_tier('final_probability')} AS risk_tier, "
        "(SELECT COUNT(*) FROM s WHERE s.final_probability > scen.final_probability) AS n_riskier FROM scen"
    )


@query("scenario_scores", _scenario_sql())
def q_scenarios(spark, sf_dir):
    """Each preset scenario's calibrated probability and how many real
    statements score above it (SRC-7, SRC-8, POL-8)."""
    scen = P.assess(add_features(P.scenarios(spark), "v2"), BASE).select("profile", "final_probability", "risk_tier")
    probs = [(r["profile"], r["final_probability"]) for r in scen.collect()]  # three rows
    stmts = scored(spark, sf_dir)
    counts = stmts.agg(
        *[F.count_if(F.col("final_probability") > F.lit(p)).alias(f"n{i}") for i, (_, p) in enumerate(probs)]
    ).first()
    riskier = spark.createDataFrame(
        [(name, int(counts[f"n{i}"])) for i, (name, _) in enumerate(probs)], "profile string, n_riskier long"
    )
    return scen.join(riskier, "profile")


def _stream_sql() -> str:
    from stressframe.plans.q_features import _T2_SELECT, _T2_SQL

    final = _FINAL
    rules = " OR ".join(f"COALESCE({r}, FALSE)" for _, impact, r in _RULES_SQL if impact > 0)
    return (
        f"{_T2_SQL}, t AS (SELECT {_T2_SELECT} FROM feat), "
        f"s AS (SELECT *, {final} AS final_probability FROM t) "
        f"SELECT statement_id, final_probability, {_tier('final_probability')} AS risk_tier, "
        f"CASE WHEN final_probability > 0.5e0 THEN 'High Risk Detected' WHEN {rules} THEN 'Watchlist: Risk is low, but issues detected.' "
        f"ELSE 'Healthy Profile: User is financially stable.' END AS verdict FROM s"
    )


@query("stream_scored_statements", _stream_sql())
def q_stream_scored(spark, sf_dir):
    """The stateless path run as a Structured Streaming query: clean ->
    features -> caps frozen from the batch table -> policy (§2.15)."""
    from stressframe.operators.clean import clean
    from stressframe.operators.features import CLIP_V2, ClipLimits
    from stressframe.schemas import TARGET_V2
    from stressframe.session import ensure_checkpoint_dir
    from stressframe.streaming.stream import stream_scored_statements

    raw = stress_statement(spark, sf_dir)
    caps = ClipLimits(inputCols=list(CLIP_V2)).fit(add_features(clean(raw, TARGET_V2), "v2"))
    out = stream_scored_statements(spark, raw, caps, ensure_checkpoint_dir(spark))
    return out.select("statement_id", "final_probability", "risk_tier", "verdict")
