"""SQL text of the derived tables, for the DuckDB oracle.

Deliberately a different plan from ``sources.derive`` (join first, aggregate
per customer afterwards) with the same exact integer arithmetic, so the oracle
checks the pre-aggregated Spark plan instead of restating it.
"""

from __future__ import annotations

from stressframe.functions.exact import sql_ratio6 as r6

_LINES = (
    "SELECT l_orderkey, l_returnflag, l_linestatus, CAST(l_linenumber AS BIGINT) AS lno, "
    "CAST(ROUND(l_tax*100) AS BIGINT) AS tc, CAST(ROUND(l_discount*100) AS BIGINT) AS dc, "
    "CAST(ROUND(l_extendedprice*100) AS BIGINT) AS pc, CAST(ROUND(l_quantity) AS BIGINT) AS q "
    "FROM lineitem"
)

RISK_CUSTOMER = f"""
rc_oo AS (
 SELECT o_custkey,
  CAST(SUM(CASE WHEN o_orderstatus='F' AND o_orderpriority='1-URGENT' THEN 1 ELSE 0 END) AS INT) AS missed_payments_last_6m,
  CAST(SUM(CASE WHEN o_orderstatus='P' AND o_orderpriority='5-LOW' THEN 1 ELSE 0 END) AS INT) AS failed_autodebit_count,
  CAST(MAX(CASE WHEN o_orderstatus='P' AND o_orderpriority='5-LOW' AND o_orderdate>=TIMESTAMP '2000-01-01 00:00:00' THEN 1 ELSE 0 END) AS INT) AS recent_failed_autodebit_flag,
  COUNT(*) AS n_orders,
  SUM(CASE WHEN o_orderstatus='O' THEN 1 ELSE 0 END) AS n_open,
  SUM(CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END) AS n_final
 FROM orders GROUP BY o_custkey),
rc_ll AS (
 SELECT o_custkey, COUNT(*) AS n, SUM(tc) AS tax_c, SUM(q) AS qty, SUM(q*q) AS qty2,
  SUM(CASE WHEN dc>=9 THEN pc ELSE 0 END) AS gamble_c, SUM(pc) AS price_c,
  SUM(CASE WHEN l_returnflag='N' THEN 1 ELSE 0 END) AS n_flag_n, SUM(dc) AS disc_c,
  SUM(CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END) AS n_flag_r,
  CAST(SUM(CASE WHEN l_returnflag='R' AND l_linestatus='O' THEN 3 ELSE 0 END) AS INT) AS utility_payment_delay_days,
  CAST(SUM(CASE WHEN l_linestatus='O' AND tc>=7 THEN 1 ELSE 0 END) AS INT) AS salary_delay_days
 FROM orders JOIN ({_LINES}) li ON li.l_orderkey=o_orderkey GROUP BY o_custkey),
risk_customer AS (
 SELECT c.c_custkey AS customer_id,
  c.c_mktsegment AS employment_type,
  CAST(300 + ((CAST(ROUND(c.c_acctbal*100) AS BIGINT)+100000)*600) // 1100000 AS INT) AS credit_score,
  oo.missed_payments_last_6m,
  oo.failed_autodebit_count,
  oo.recent_failed_autodebit_flag,
  ll.utility_payment_delay_days,
  {r6('ll.tax_c', '8*ll.n')} AS emi_to_income_ratio,
  {r6('ll.qty', '30*ll.n')} AS credit_utilization_ratio,
  {r6('ll.gamble_c', 'll.price_c')} AS gambling_spend_increase_pct,
  {r6('ll.n_flag_n', 'll.n')} AS discretionary_spend_drop_pct,
  {r6('(ll.disc_c-4*ll.n)', '5*ll.n')} AS savings_decline_pct,
  {r6('(ll.tax_c-4*ll.n)', '10*ll.n')} AS savings_decline_trend,
  {r6('(20*oo.n_open-3*oo.n_orders)', '20*oo.n_orders')} AS income_drop_pct,
  CASE WHEN ll.n>1 THEN ROUND(SQRT(CAST(ll.n*ll.qty2-ll.qty*ll.qty AS DOUBLE)/CAST(ll.n*(ll.n-1) AS DOUBLE))
       / (CAST(ll.qty AS DOUBLE)/CAST(ll.n AS DOUBLE)), 6) END AS balance_volatility_30d,
  {r6('(10*ll.n_flag_r-3*ll.n)', '10*ll.n')} AS risk_momentum_score,
  ll.salary_delay_days,
  CASE WHEN oo.n_final>=5 THEN 1 ELSE 0 END AS default_next_30_days
 FROM customer c JOIN rc_oo oo ON oo.o_custkey=c.c_custkey JOIN rc_ll ll ON ll.o_custkey=c.c_custkey)"""

STRESS_STATEMENT = f"""
ss_li AS (
 SELECT l_orderkey,
  SUM(pc*(100-dc)) AS spend4, SUM(pc*tc) AS emi4,
  SUM(CASE WHEN l_linestatus='O' THEN pc*(100-dc) ELSE 0 END) AS essential4,
  SUM(CASE WHEN l_linestatus='F' THEN pc*(100-dc) ELSE 0 END) AS discretionary4,
  SUM(CASE WHEN l_returnflag='R' AND dc>=8 THEN pc*(100-dc) ELSE 0 END) AS gamble4,
  MAX(dc) AS max_dc, SUM(q) AS qty,
  SUM(CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END) AS n_flag_r,
  COUNT(*) AS n, SUM(tc) AS tax_c, SUM(lno) AS lno, SUM(dc) AS disc_c, MIN(q) AS min_q
 FROM ({_LINES}) l GROUP BY l_orderkey),
stress_statement AS (
 SELECT o.o_orderkey AS statement_id,
  o.o_custkey AS customer_id,
  CAST((YEAR(o.o_orderdate)-1995)*52 + (DAYOFYEAR(o.o_orderdate)-1)//7 AS INT) AS week_number,
  c.c_mktsegment AS employment_type,
  o.o_totalprice AS monthly_income,
  CAST(li.emi4 AS DOUBLE)/1e4 AS emi_amount,
  CAST(GREATEST(CAST(ROUND(c.c_acctbal*100) AS BIGINT),0)*10+1000000 AS DOUBLE)/100.0e0 AS credit_limit,
  CAST(GREATEST(li.min_q-10,0) AS INT) AS salary_delay_days,
  CAST(li.spend4 AS DOUBLE)/1e4 AS total_spend,
  CAST(li.essential4 AS DOUBLE)/1e4 AS essential_spend,
  CAST(li.discretionary4 AS DOUBLE)/1e4 AS discretionary_spend,
  CAST(li.gamble4 AS DOUBLE)/1e4 AS gambling_spend,
  CAST(GREATEST(CAST(ROUND(c.c_acctbal*100) AS BIGINT),0) AS DOUBLE)/100.0e0 AS savings_balance,
  CAST(li.max_dc AS DOUBLE)/10.0e0 AS savings_decline_pct,
  CAST(GREATEST(CAST(ROUND(c.c_acctbal*100) AS BIGINT),0) AS DOUBLE)/250000.0e0 AS liquidity_ratio,
  {r6('li.qty', '120')} AS credit_utilization_ratio,
  CAST(li.n_flag_r AS INT) AS failed_autodebit_count,
  CAST(li.n AS INT) AS lending_app_txn_count,
  {r6('(li.tax_c-4*li.n)', '4*li.n')} AS stress_momentum_score,
  {r6('li.lno', '7*li.n')} AS behavioral_shock_index,
  {r6('li.disc_c', '10*li.n')} AS unified_stress_index,
  CASE WHEN (o.o_orderstatus='F' AND li.n_flag_r>=1) OR li.n_flag_r>=4
            OR (o.o_orderstatus='F' AND CAST(ROUND(c.c_acctbal*100) AS BIGINT)>800000) THEN 1 ELSE 0 END AS default_next_4_weeks
 FROM orders o JOIN customer c ON o.o_custkey=c.c_custkey JOIN ss_li li ON li.l_orderkey=o.o_orderkey)"""


def with_tables(*names: str) -> str:
    """WITH-clause prefix defining the requested derived tables."""
    parts = []
    if "risk_customer" in names:
        parts.append(RISK_CUSTOMER)
    if "stress_statement" in names:
        parts.append(STRESS_STATEMENT)
    return "WITH " + ",".join(parts)
