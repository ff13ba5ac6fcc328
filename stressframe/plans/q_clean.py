"""Queries: derived tables, stress flags, cleaning, record checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from stressframe.functions.predicates import high_stress, perfect_record, terrible_record, volatile_decline
from stressframe.operators.clean import audit_list, cleaning_report, split_contradictions
from stressframe.operators.profile import rate_by_flag
from stressframe.plans.registry import query
from stressframe.plans.sql_fixtures import with_tables
from stressframe.schemas import TARGET_V1, TARGET_V2
from stressframe.sources.derive import risk_customer, stress_statement

V1 = with_tables("risk_customer")
V2 = with_tables("stress_statement")


@query("risk_customer", f"{V1} SELECT * FROM risk_customer")
def q_risk_customer(spark, sf_dir):
    return risk_customer(spark, sf_dir)


@query("stress_statement", f"{V2} SELECT * FROM stress_statement")
def q_stress_statement(spark, sf_dir):
    return stress_statement(spark, sf_dir)


@query(
    "high_stress_default_rate",
    f"""{V1} SELECT high_stress, AVG(default_next_30_days) AS default_rate, COUNT(*) AS n_rows
    FROM (SELECT default_next_30_days, CAST(COALESCE(credit_utilization_ratio>0.7 AND emi_to_income_ratio>0.4, FALSE) AS INT) AS high_stress
          FROM risk_customer) GROUP BY high_stress""",
)
def q_high_stress(spark, sf_dir):
    df = risk_customer(spark, sf_dir).withColumn("high_stress", high_stress())
    return rate_by_flag(df, "high_stress", TARGET_V1)


@query(
    "volatile_decline_default_rate",
    f"""{V1} SELECT volatile_decline, AVG(default_next_30_days) AS default_rate, COUNT(*) AS n_rows
    FROM (SELECT default_next_30_days, CAST(COALESCE(savings_decline_pct>0.1 AND balance_volatility_30d>0.2, FALSE) AS INT) AS volatile_decline
          FROM risk_customer) GROUP BY volatile_decline""",
)
def q_volatile_decline(spark, sf_dir):
    df = risk_customer(spark, sf_dir).withColumn("volatile_decline", volatile_decline())
    return rate_by_flag(df, "volatile_decline", TARGET_V1)


_V1_MASK = "COALESCE(default_next_30_days=1 AND missed_payments_last_6m=0 AND failed_autodebit_count=0 AND credit_score>700, FALSE)"
_V2_MASK = "COALESCE(default_next_4_weeks=1 AND liquidity_ratio>2.0 AND unified_stress_index<0.2, FALSE)"


@query("contradictions_v1", f"{V1} SELECT * FROM risk_customer WHERE {_V1_MASK}")
def q_contradictions_v1(spark, sf_dir):
    return split_contradictions(risk_customer(spark, sf_dir), TARGET_V1)[0]


@query("contradictions_v2", f"{V2} SELECT * FROM stress_statement WHERE {_V2_MASK}")
def q_contradictions_v2(spark, sf_dir):
    return split_contradictions(stress_statement(spark, sf_dir), TARGET_V2)[0]


@query("clean_v2", f"{V2} SELECT * FROM stress_statement WHERE NOT {_V2_MASK}")
def q_clean_v2(spark, sf_dir):
    return split_contradictions(stress_statement(spark, sf_dir), TARGET_V2)[1]


def _report_sql(prefix: str, table: str, mask: str) -> str:
    return f"""{prefix} SELECT COUNT(*) AS initial_rows, COUNT(*) FILTER (WHERE {mask}) AS removed_rows,
    CAST(COUNT(*) FILTER (WHERE {mask}) AS DOUBLE)/COUNT(*) AS removed_share,
    COUNT(*) - COUNT(*) FILTER (WHERE {mask}) AS final_rows FROM {table}"""


@query("cleaning_report_v1", _report_sql(V1, "risk_customer", _V1_MASK))
def q_cleaning_report_v1(spark, sf_dir):
    return cleaning_report(risk_customer(spark, sf_dir), TARGET_V1)


@query("cleaning_report_v2", _report_sql(V2, "stress_statement", _V2_MASK))
def q_cleaning_report_v2(spark, sf_dir):
    return cleaning_report(stress_statement(spark, sf_dir), TARGET_V2)


@query(
    "audit_list",
    f"{V1} SELECT customer_id, credit_score, income_drop_pct FROM risk_customer WHERE {_V1_MASK}",
)
def q_audit_list(spark, sf_dir):
    return audit_list(risk_customer(spark, sf_dir), TARGET_V1)


@query(
    "perfect_record_labels",
    f"""{V1} SELECT default_next_30_days, COUNT(*) AS n_rows FROM risk_customer
    WHERE COALESCE(missed_payments_last_6m=0 AND failed_autodebit_count=0 AND credit_score>700, FALSE)
    GROUP BY default_next_30_days""",
)
def q_perfect_record_labels(spark, sf_dir):
    df = risk_customer(spark, sf_dir)
    return df.where(perfect_record()).groupBy(TARGET_V1).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "terrible_record_labels",
    f"""{V1} SELECT default_next_30_days, COUNT(*) AS n_rows FROM risk_customer
    WHERE COALESCE(missed_payments_last_6m>2 AND failed_autodebit_count>2, FALSE)
    GROUP BY default_next_30_days""",
)
def q_terrible_record_labels(spark, sf_dir):
    df = risk_customer(spark, sf_dir)
    return df.where(terrible_record()).groupBy(TARGET_V1).agg(F.count(F.lit(1)).alias("n_rows"))
