"""Queries: ordered target statistics, extremely random trees, contributions, patience."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from stressframe.operators import contributions as C
from stressframe.operators.metrics import roc_auc
from stressframe.operators.quantile import exact_quantiles
from stressframe.operators.random_trees import fit_extra_trees
from stressframe.operators.split import stratified_split
from stressframe.operators.staged import chosen_rounds, fit_staged, staged_curve, staged_loss, with_patience
from stressframe.operators.target_stats import fit_target_statistics, ordered_target_statistics
from stressframe.plans.registry import query, stored
from stressframe.plans.sql_fixtures import with_tables
from stressframe.schemas import TARGET_V2
from stressframe.session import cut_lineage
from stressframe.sources.derive import stress_statement

W2 = with_tables("stress_statement")
NOMINAL = ["employment_type", "customer_id"]
#: First week that is scored, not fitted on.
SCORE_FROM = 300
TREE_FEATURES = [
    "monthly_income", "emi_amount", "credit_limit", "salary_delay_days", "total_spend", "essential_spend", "discretionary_spend",
    "gambling_spend", "savings_balance", "savings_decline_pct", "liquidity_ratio", "credit_utilization_ratio", "failed_autodebit_count",
    "lending_app_txn_count", "stress_momentum_score", "behavioral_shock_index", "unified_stress_index",
]

# --- target statistics (MOD-3) ---------------------------------------------------

_ORDERED = ", ".join(
    f"(CAST(COALESCE(SUM(default_next_4_weeks) OVER {c}_w, 0) AS DOUBLE) + prior) / (CAST(COUNT(default_next_4_weeks) OVER {c}_w AS DOUBLE) + 1.0e0) AS {c}_ts"
    for c in ("employment_type", "customer_id")
)
_WINDOWS = ", ".join(
    f"{c}_w AS (PARTITION BY {c} ORDER BY h, statement_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)" for c in ("employment_type", "customer_id")
)


@query(
    "ordered_target_stats",
    f"""{W2}, p AS (SELECT CAST(SUM(default_next_4_weeks) AS DOUBLE) / CAST(COUNT(default_next_4_weeks) AS DOUBLE) AS prior FROM stress_statement),
    o AS (SELECT *, CAST('0x' || substr(md5(CAST(statement_id AS VARCHAR) || '|42'), 1, 15) AS BIGINT) AS h FROM stress_statement, p)
    SELECT statement_id, {_ORDERED} FROM o WINDOW {_WINDOWS}""",
)
def q_ordered_target_stats(spark, sf_dir):
    """Nominal columns of the training rows: a short list of levels and one as long as
    the customer table; buckets small enough that every level is split."""
    s = cut_lineage(stress_statement(spark, sf_dir).select("statement_id", *NOMINAL, TARGET_V2))
    out, _ = ordered_target_statistics(s, NOMINAL, TARGET_V2, "statement_id", rows_per_bucket=1 << 12)
    return out.select("statement_id", *[f"{c}_ts" for c in NOMINAL])


_LEVELS = ", ".join(f"t_{c} AS (SELECT {c}, COUNT(*) AS n, SUM(default_next_4_weeks) AS s FROM fit GROUP BY {c})" for c in ("employment_type", "customer_id"))


@query(
    "target_stats_scored",
    f"""{W2}, fit AS (SELECT * FROM stress_statement WHERE week_number < 300),
    p AS (SELECT CAST(SUM(default_next_4_weeks) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS prior FROM fit), {_LEVELS}
    SELECT x.statement_id,
      (CAST(COALESCE(e.s, 0) AS DOUBLE) + prior) / (CAST(COALESCE(e.n, 0) AS DOUBLE) + 1.0e0) AS employment_type_ts,
      (CAST(COALESCE(c.s, 0) AS DOUBLE) + prior) / (CAST(COALESCE(c.n, 0) AS DOUBLE) + 1.0e0) AS customer_id_ts
    FROM stress_statement x CROSS JOIN p
    LEFT JOIN t_employment_type e ON e.employment_type IS NOT DISTINCT FROM x.employment_type
    LEFT JOIN t_customer_id c ON c.customer_id IS NOT DISTINCT FROM x.customer_id WHERE x.week_number >= 300""",
)
def q_target_stats_scored(spark, sf_dir):
    """Later weeks scored with the statistics of the earlier ones; new customers get the prior."""
    s = stress_statement(spark, sf_dir)
    fitted = fit_target_statistics(s.where(F.col("week_number") < SCORE_FROM), NOMINAL, TARGET_V2)
    return fitted.transform(s.where(F.col("week_number") >= SCORE_FROM)).select("statement_id", *[f"{c}_ts" for c in NOMINAL])


# --- extremely random trees (MOD-6) ----------------------------------------------


@stored
def _forest(spark, sf_dir):
    """The preset of the five-model vote (300 trees, depth 10, 4 rows a leaf, balanced),
    fitted on the earlier weeks."""
    s = stress_statement(spark, sf_dir)
    return fit_extra_trees(s.where(F.col("week_number") < SCORE_FROM), TARGET_V2, TREE_FEATURES, trees=300, depth=10, min_leaf=4, seed=42)


_SQL_FEATURES = (
    "monthly_income emi_amount credit_limit salary_delay_days total_spend essential_spend discretionary_spend gambling_spend savings_balance "
    "savings_decline_pct liquidity_ratio credit_utilization_ratio failed_autodebit_count lending_app_txn_count stress_momentum_score "
    "behavioral_shock_index unified_stress_index"
).split()
_LONG = (
    f"SELECT default_next_4_weeks AS y, unnest([{', '.join(f'CAST({c} AS DOUBLE)' for c in _SQL_FEATURES)}]) AS v, "
    f"unnest(range({len(_SQL_FEATURES)})) AS feature FROM fit"
)
_NAMES = ", ".join(f"({i}, '{c}')" for i, c in enumerate(_SQL_FEATURES))
_HEX = ", ".join(f"CAST('0x' || substr(m, {8 * i + 1}, 8) AS BIGINT) % 2147483647 AS h{i}" for i in range(4))


@query(
    "extra_trees_first_splits",
    f"""{W2}, fit AS (SELECT * FROM stress_statement WHERE week_number < 300),
    w AS (SELECT CAST(COUNT(*) AS DOUBLE) / (2.0e0 * COUNT(*) FILTER (default_next_4_weeks = 0)) AS w0,
                 CAST(COUNT(*) AS DOUBLE) / (2.0e0 * COUNT(*) FILTER (default_next_4_weeks = 1)) AS w1 FROM fit),
    h AS (SELECT tree, {_HEX} FROM (SELECT tree, md5('42|' || tree || '|1') AS m FROM (SELECT unnest(range(300)) AS tree))),
    c AS (SELECT tree, feature, name, (h0 + (feature + 1) * h1) % 2147483647 AS k,
                 CAST((h2 + (feature + 1) * h3) % 2147483647 AS DOUBLE) / 2147483647.0e0 AS u FROM h, (VALUES {_NAMES}) f(feature, name)),
    d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY k, feature) AS r FROM c) WHERE r <= 4),
    long AS ({_LONG}), g AS (SELECT feature, MIN(v) AS lo, MAX(v) AS hi FROM long GROUP BY feature),
    t AS (SELECT tree, d.feature, name, r, lo + (hi - lo) * u AS cut FROM d JOIN g ON g.feature = d.feature WHERE lo < hi),
    s AS (SELECT tree, name, r, cut, COUNT(*) FILTER (y = 0 AND v <= cut) AS l0, COUNT(*) FILTER (y = 1 AND v <= cut) AS l1,
                 COUNT(*) FILTER (y = 0 AND v > cut) AS r0, COUNT(*) FILTER (y = 1 AND v > cut) AS r1
          FROM t JOIN long ON long.feature = t.feature GROUP BY tree, name, r, cut),
    x AS (SELECT tree, name, r, cut, l0 + l1 AS left_rows, r0 + r1 AS right_rows,
                 ((l0 * w0) * (l0 * w0) + (l1 * w1) * (l1 * w1)) / (l0 * w0 + l1 * w1)
                 + ((r0 * w0) * (r0 * w0) + (r1 * w1) * (r1 * w1)) / (r0 * w0 + r1 * w1) AS score FROM s, w WHERE l0 + l1 >= 4 AND r0 + r1 >= 4)
    SELECT CAST(tree AS INT) AS tree, name AS feature, cut, score, left_rows, right_rows
    FROM (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY score DESC, r) AS b FROM x) WHERE b = 1""",
)
def q_extra_trees_first_splits(spark, sf_dir):
    """Drawn feature, drawn cut, impurity score and sides of every tree's first split."""
    forest = _forest(spark, sf_dir)
    t = forest.table(spark)
    size = F.col("n0") + F.col("n1")
    names = F.array(*[F.lit(c) for c in forest.names])
    root = t.where("node = 1 AND feature IS NOT NULL").select("tree", F.element_at(names, F.col("feature") + 1).alias("feature"), "cut", "score")
    left, right = (t.where(f"node = {k}").select("tree", size.alias(name)) for k, name in ((2, "left_rows"), (3, "right_rows")))
    return root.join(left, "tree").join(right, "tree")


@query(
    "extra_trees_check",
    f"""{W2}, n AS (SELECT COUNT(*) FILTER (default_next_4_weeks = 0) AS rows0, COUNT(*) FILTER (default_next_4_weeks = 1) AS rows1
      FROM stress_statement WHERE week_number < 300)
    SELECT CAST(tree AS INT) AS tree, rows0, rows1, TRUE AS children_add_up, TRUE AS small_leaves_only_at_the_root FROM n, (SELECT unnest(range(300)) AS tree)""",
)
def q_extra_trees_check(spark, sf_dir):
    """Every tree's leaves hold all fitted rows, every split's children its rows, no leaf
    of a split has fewer rows than asked for."""
    t = _forest(spark, sf_dir).table(spark)
    leaves = t.where("feature IS NULL").groupBy("tree").agg(
        F.sum("n0").alias("rows0"), F.sum("n1").alias("rows1"), F.min(F.when(F.col("node") > 1, F.col("n0") + F.col("n1"))).alias("_least")
    )
    child = t.select("tree", F.shiftright("node", 1).alias("node"), F.col("n0").alias("c0"), F.col("n1").alias("c1")).groupBy("tree", "node").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
    splits = t.where("feature IS NOT NULL").join(child, ["tree", "node"], "left")
    sums = splits.groupBy("tree").agg(F.bool_and((F.col("n0") == F.col("c0")) & (F.col("n1") == F.col("c1"))).alias("children_add_up"))
    both = leaves.join(sums, "tree", "left")
    return both.select("tree", "rows0", "rows1", F.coalesce("children_add_up", F.lit(True)).alias("children_add_up"),
                       F.coalesce(F.col("_least") >= 4, F.lit(True)).alias("small_leaves_only_at_the_root"))


@query("extra_trees_auc")
def q_extra_trees_auc(spark, sf_dir):
    """Area under the curve on the later weeks."""
    later = stress_statement(spark, sf_dir).where(F.col("week_number") >= SCORE_FROM)
    return roc_auc(_forest(spark, sf_dir).transform(later), TARGET_V2, "probability")


# --- contributions (EXP-3) --------------------------------------------------------

_SHOCK = ["unified_stress_index", "stress_momentum_score", "behavioral_shock_index"]


def _shock_score(df):
    """Sum of the two interaction features of the v2 catalogue."""
    u, m, b = (F.col(c) for c in _SHOCK)
    return df.withColumn("probability", u * m + b * (F.lit(1) + m))


def _shapley_sql() -> str:
    x = ["unified_stress_index", "stress_momentum_score", "behavioral_shock_index"]

    def f(u: str, m: str, b: str) -> str:
        return f"({u}*{m} + {b}*(1+{m}))"

    hashes = ", ".join(f"md5(CAST(statement_id AS VARCHAR) || '|{r}|42|{c}') AS h{r}_{i}" for r in range(2) for i, c in enumerate(x))

    def change(r: int, i: int) -> str:
        before = [f"(CASE WHEN h{r}_{k} < h{r}_{i} THEN {c} ELSE b{k} END)" for k, c in enumerate(x)]
        on, off = list(before), list(before)
        on[i], off[i] = x[i], f"b{i}"
        return f"({f(*on)} - {f(*off)})"

    means = ", ".join(f"({change(0, i)} + {change(1, i)}) / 2 AS d_{c}" for i, c in enumerate(x))
    base = ", ".join(f"MIN({c}) AS b{i}" for i, c in enumerate(x))
    return (
        f"{W2}, b AS (SELECT {base} FROM stress_statement), h AS (SELECT *, {hashes} FROM stress_statement, b) "
        f"SELECT statement_id, {f(*x)} AS score, {f('b0', 'b1', 'b2')} AS base_score, {means}, TRUE AS adds_up FROM h"
    )


@query("shapley_shock", _shapley_sql())
def q_shapley_shock(spark, sf_dir):
    """Sampled Shapley values of a score with interactions, every statement, two orders."""
    s = cut_lineage(stress_statement(spark, sf_dir).select("statement_id", *_SHOCK))
    low = s.agg(*[F.min(c).alias(c) for c in _SHOCK]).first()
    out = C.shapley_values(s, _shock_score, _SHOCK, "statement_id", {c: low[c] for c in _SHOCK}, orders=2)
    return out.select("statement_id", "score", "base_score", *[F.col("contributions")[c].alias(f"d_{c}") for c in _SHOCK], C.adds_up().alias("adds_up"))


@stored
def _tree_contributions(spark, sf_dir):
    """Contributions of the forest's score, all statements of the later weeks, from the medians."""
    s = cut_lineage(stress_statement(spark, sf_dir).select("statement_id", "week_number", *TREE_FEATURES))
    medians = {r["column"]: float(r["value"]) for r in exact_quantiles(s, TREE_FEATURES, [0.5]).collect()}
    later = s.where(F.col("week_number") >= SCORE_FROM)
    return cut_lineage(C.shapley_values(later, _forest(spark, sf_dir).transform, TREE_FEATURES, "statement_id", medians, orders=2))


@query("tree_contributions")
def q_tree_contributions(spark, sf_dir):
    """Mean absolute contribution of every feature of the forest, largest first."""
    return C.mean_absolute(_tree_contributions(spark, sf_dir))


@query("tree_contributions_check", f"{W2} SELECT statement_id, 17 AS features, TRUE AS adds_up FROM stress_statement WHERE week_number >= 300")
def q_tree_contributions_check(spark, sf_dir):
    """Every later statement is explained, by all features, and contributions add up."""
    return _tree_contributions(spark, sf_dir).select("statement_id", F.size("contributions").alias("features"), C.adds_up().alias("adds_up"))


@query("linear_contributions_check", f"{W2} SELECT statement_id, 17 AS features, TRUE AS adds_up, TRUE AS centred FROM stress_statement")
def q_linear_contributions_check(spark, sf_dir):
    """coefficient * (x - mean) of a logistic model: with the margin at the means they add
    up to every row's margin, and each feature's mean over all rows is zero."""
    s = stress_statement(spark, sf_dir).select("statement_id", TARGET_V2, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in TREE_FEATURES])
    s = cut_lineage(s)
    lr = LogisticRegression(labelCol=TARGET_V2, featuresCol="features", maxIter=50, regParam=0.01, rawPredictionCol="raw")
    model = Pipeline(stages=[VectorAssembler(inputCols=TREE_FEATURES, outputCol="features"), lr]).fit(s)
    fitted = model.stages[-1]
    row = s.agg(*[F.avg(c).alias(c) for c in TREE_FEATURES]).first()
    means, coefs = [row[c] for c in TREE_FEATURES], [float(w) for w in fitted.coefficients]
    scored = cut_lineage(model.transform(s).select("statement_id", "features", "raw"))
    own = cut_lineage(C.linear_values(scored, coefs, TREE_FEATURES, means, "statement_id"))
    at_means = float(fitted.intercept) + sum(w * m for w, m in zip(coefs, means))
    both = own.join(scored.select("statement_id", C.vector_to_array("raw")[1].alias("margin")), "statement_id")
    whole = F.aggregate(F.map_values("contributions"), F.lit(at_means), lambda a, x: a + x)
    largest = C.mean_absolute(own).agg(F.max(F.abs("mean")).alias("m")).first().m or 0.0
    close = F.abs(whole - F.col("margin")) <= 1e-6 * (1 + F.abs("margin"))
    return both.select("statement_id", F.size("contributions").alias("features"), close.alias("adds_up"), F.lit(largest < 1e-6).alias("centred"))


# --- patience as data (MOD-5, MOD-10) ----------------------------------------------

#: The gradient boosting of the five-model vote: rounds, rate, depth,
#: share held out for patience, rounds of patience.
GB = dict(rounds=200, rate=0.05, depth=5, held_out=0.1, patience=10)


@stored
def _boosted(spark, sf_dir):
    """Boosted trees like Spark ML's with all rounds on the earlier weeks less a stratified tenth;
    staged margins of that tenth; the curve of its loss."""
    s = stress_statement(spark, sf_dir).where(F.col("week_number") < SCORE_FROM)
    s = s.select("statement_id", TARGET_V2, *[F.coalesce(F.col(c).cast("double"), F.lit(-1.0e9)).alias(c) for c in TREE_FEATURES])
    s = cut_lineage(stratified_split(s, TARGET_V2, "statement_id", GB["held_out"]))
    trees = fit_staged(s.where("is_test = 0"), TARGET_V2, TREE_FEATURES, GB["rounds"], GB["rate"], GB["depth"])
    staged = cut_lineage(trees.staged(s.where("is_test = 1").select("statement_id", TARGET_V2, *TREE_FEATURES)))
    return trees, staged, cut_lineage(staged_loss(staged, TARGET_V2))


@query("patience_curve")
def q_patience_curve(spark, sf_dir):
    """Loss and area under the curve of the held-out tenth after every round, the best
    round so far, and whether training with patience reaches the round."""
    _, staged, loss = _boosted(spark, sf_dir)
    area = staged_curve(staged, TARGET_V2).select("round", F.col("metric").alias("auc"))
    return with_patience(loss, GB["patience"]).join(area, "round").select("round", (-F.col("metric")).alias("loss"), "auc", "best_round", "trained")


@query(
    "patience_check",
    f"""{W2}, f AS (SELECT default_next_4_weeks AS y, COUNT(*) AS n FROM stress_statement WHERE week_number < 300 GROUP BY 1)
    SELECT CAST(200 AS BIGINT) AS rounds, CAST(SUM(floor(0.1e0 * n + 0.5e0)) AS BIGINT) AS held_out, TRUE AS chosen_is_best, TRUE AS waited, TRUE AS cut_agrees FROM f""",
)
def q_patience_check(spark, sf_dir):
    """The chosen round is the best one reached, training went on for the patience after it
    (or to the last round), and the model cut there gives the staged scores of that round."""
    trees, staged, loss = _boosted(spark, sf_dir)
    end = chosen_rounds(loss, GB["patience"]).first()
    reached = loss.where(F.col("round") <= end.trained_rounds)
    top = reached.agg(F.max(F.struct("metric", (-F.col("round")).alias("r"))).alias("b")).first().b
    waited = end.trained_rounds in (end.chosen_round + GB["patience"], GB["rounds"])
    cut = trees.cut(end.chosen_round).staged(staged.drop("margins"), "last")
    both = cut.select("statement_id", F.element_at("last", -1).alias("a")).join(staged.select("statement_id", F.element_at("margins", end.chosen_round).alias("b")), "statement_id")
    return both.agg(
        F.lit(trees.rounds()).cast("long").alias("rounds"),
        F.count("*").alias("held_out"),
        F.lit(-top.r == end.chosen_round).alias("chosen_is_best"),
        F.lit(waited).alias("waited"),
        F.bool_and(F.abs(F.col("a") - F.col("b")) < 1e-12).alias("cut_agrees"),
    )


@query("patience_auc")
def q_patience_auc(spark, sf_dir):
    """Area under the curve on the later weeks: all rounds, and cut where patience ends."""
    trees, _, loss = _boosted(spark, sf_dir)
    end = chosen_rounds(loss, GB["patience"]).first()
    later = stress_statement(spark, sf_dir).where(F.col("week_number") >= SCORE_FROM)
    later = later.select(TARGET_V2, *[F.coalesce(F.col(c).cast("double"), F.lit(-1.0e9)).alias(c) for c in TREE_FEATURES])
    parts = [roc_auc(t.transform(later), TARGET_V2, "probability").withColumn("rounds", F.lit(t.rounds())) for t in (trees, trees.cut(end.chosen_round))]
    return parts[0].unionAll(parts[1])
