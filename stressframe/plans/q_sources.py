"""Queries that land files and publish runs, and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stressframe.operators.policy import risk_tier
from stressframe.plans.registry import query
from stressframe.plans.sql_fixtures import with_tables
from stressframe.schemas import V1
from stressframe.session import ensure_checkpoint_dir
from stressframe.sources.derive import risk_customer, stress_statement
from stressframe.sources.landing import read_landing
from stressframe.sources.publish import Publication

W1, W2 = with_tables("risk_customer"), with_tables("stress_statement")


def _shared(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def land_customers(spark, sf_dir, path: str) -> None:
    """The customer table as CSV files with three headers: all columns; all columns in
    reverse; without two columns, with one of its own.  Some scores are no numbers."""
    df = risk_customer(spark, sf_dir)
    names, third = df.columns, F.pmod("customer_id", F.lit(3))
    spoiled = F.when(F.pmod("customer_id", F.lit(50)) == 7, F.lit("n/a")).otherwise(F.col("credit_score").cast("string"))
    text = df.withColumn("credit_score", spoiled).withColumn("branch", F.concat(F.lit("b"), F.pmod("customer_id", F.lit(4))))
    fewer = [c for c in names if c not in ("savings_decline_trend", "salary_delay_days")]
    for k, columns in enumerate((names, names[::-1], [*fewer, "branch"])):
        part = text.where(third == k).select(*columns)
        part.write.mode("append").option("header", True).csv(path)


_LANDED = (
    "SELECT * EXCLUDE (credit_score, savings_decline_trend, salary_delay_days), "
    "CASE WHEN customer_id % 50 = 7 THEN NULL ELSE credit_score END AS credit_score, "
    "CASE WHEN customer_id % 3 = 2 THEN NULL ELSE savings_decline_trend END AS savings_decline_trend, "
    "CASE WHEN customer_id % 3 = 2 THEN NULL ELSE salary_delay_days END AS salary_delay_days, "
    "CASE WHEN customer_id % 3 = 2 THEN 'b' || (customer_id % 4) END AS branch FROM risk_customer"
)


@query("landed_customers", f"{W1} {_LANDED}")
def q_landed_customers(spark, sf_dir):
    """All customers read back from files with three headers and cells of the wrong type."""
    path = _shared(spark, "landing")
    land_customers(spark, sf_dir, path)
    return read_landing(spark, path, V1)[0].drop("source_file")


@query("landing_quarantine", f"{W1} SELECT customer_id, 'credit_score' AS column_name, 'n/a' AS value FROM risk_customer WHERE customer_id % 50 = 7")
def q_landing_quarantine(spark, sf_dir):
    """Every cell that its column cannot read, with the customer of its row."""
    path = _shared(spark, "landing")
    land_customers(spark, sf_dir, path)
    bad = read_landing(spark, path, V1)[1]
    return bad.select(F.get_json_object("row", "$.customer_id").cast("long").alias("customer_id"), F.col("column").alias("column_name"), "value")


@query(
    "published_scores",
    f"""{W2} SELECT statement_id, unified_stress_index AS risk_probability,
    CASE WHEN unified_stress_index < 0.3e0 THEN 'Low' WHEN unified_stress_index < 0.6e0 THEN 'Medium'
         WHEN unified_stress_index < 0.8e0 THEN 'High' ELSE 'Critical' END AS risk_category, 2 AS published_runs,
    (SELECT COUNT(*) FROM stress_statement) AS run_rows FROM stress_statement""",
)
def q_published_scores(spark, sf_dir):
    """A run is published, a second one breaks off before its manifest, a third is
    published and repeated: readers see the third, whole and once."""
    pub = Publication(spark, _shared(spark, "published"))
    s = stress_statement(spark, sf_dir).select("statement_id", F.col("unified_stress_index").alias("risk_probability"))
    scored = s.withColumn("risk_category", risk_tier(F.col("risk_probability")))
    n = float(s.count())
    pub.publish("week_1", {"scored": scored.where("risk_probability < 0.5")}, metrics={"rows": -1.0})
    pub.write("week_2", {"scored": scored.where("risk_probability >= 0.5")})  # no manifest
    pub.publish("week_3", {"scored": scored}, metrics={"rows": n})
    pub.publish("week_3", {"scored": scored.limit(0)}, metrics={"rows": 0.0})
    return pub.table("scored").withColumn("published_runs", F.lit(len(pub.runs()))).withColumn("run_rows", F.lit(int(pub.metrics()["rows"])).cast("long"))
