"""Queries: label, null, range, correlation and distribution profiles; encodings."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stressframe.operators import profile as P
from stressframe.operators.encode import ImputeScale, OneHot, fill_non_finite
from stressframe.operators.features import add_features
from stressframe.operators.states import MomentStore, QuantileStore
from stressframe.plans import sql_features as S
from stressframe.plans.registry import query, stored
from stressframe.plans.sql_fixtures import with_tables
from stressframe.schemas import TARGET_V1, TARGET_V2, V1 as V1_SCHEMA, numeric_columns
from stressframe.session import cut_lineage, ensure_checkpoint_dir
from stressframe.sources.derive import risk_customer, stress_statement

W1, W2 = with_tables("risk_customer"), with_tables("stress_statement")
BASE_COLS = list(S.BASE)
# The features compared across classes (AGG-8, AGG-10) and described (AGG-11).
HIGH_IMPACT = (
    "credit_score", "emi_to_income_ratio", "credit_utilization_ratio",
    "missed_payments_last_6m", "savings_decline_pct", "risk_momentum_score",
)
OVERLAP = ("missed_payments_last_6m", "failed_autodebit_count", "risk_momentum_score")


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column (aggregates of doubles depend on summation order)."""
    return df.select(
        *[F.round(F.col(f.name), places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
          for f in df.schema.fields]
    )


@query(
    "label_distribution",
    f"""{W1} SELECT default_next_30_days, COUNT(*) AS n_rows, COUNT(*)/SUM(COUNT(*)) OVER () AS share
    FROM risk_customer WHERE default_next_30_days IS NOT NULL GROUP BY default_next_30_days""",
)
def q_label_distribution(spark, sf_dir):
    return P.label_distribution(risk_customer(spark, sf_dir), TARGET_V1)


@query(
    "class_ratio",
    f"""{W1} SELECT negatives, positives, CASE WHEN positives>0 THEN negatives/positives ELSE 1.0e0 END AS ratio
    FROM (SELECT COUNT(*) FILTER (WHERE default_next_30_days=0) AS negatives,
                 COUNT(*) FILTER (WHERE default_next_30_days=1) AS positives FROM risk_customer)""",
)
def q_class_ratio(spark, sf_dir):
    return P.class_ratio(risk_customer(spark, sf_dir), TARGET_V1)


def with_gaps(df: DataFrame) -> DataFrame:
    """Customers with NULL, NaN and infinite cells put in by a rule on the key, so that
    the rules for missing values have work at every size."""
    k = F.col("customer_id")
    gap = lambda c, n: F.when(k % n != 0, F.col(c)).alias(c)
    odd = lambda c, n: (
        F.when(k % n == 1, F.lit(float("nan"))).when(k % n == 2, F.lit(float("inf"))).when(k % n == 3, F.lit(float("-inf")))
        .when(k % n != 4, F.col(c)).alias(c)
    )
    new = {"credit_score": gap("credit_score", 7), "employment_type": gap("employment_type", 11), "missed_payments_last_6m": gap("missed_payments_last_6m", 13),
           "emi_to_income_ratio": odd("emi_to_income_ratio", 17), "savings_decline_pct": odd("savings_decline_pct", 19)}
    return df.select(*[new.get(c, F.col(c)) for c in df.columns])


def _gap_sql() -> str:
    def odd(c, n):
        return (f"CASE WHEN customer_id % {n} = 1 THEN CAST('NaN' AS DOUBLE) WHEN customer_id % {n} = 2 THEN CAST('Infinity' AS DOUBLE) "
                f"WHEN customer_id % {n} = 3 THEN CAST('-Infinity' AS DOUBLE) WHEN customer_id % {n} <> 4 THEN {c} END AS {c}")

    def gap(c, n):
        return f"CASE WHEN customer_id % {n} <> 0 THEN {c} END AS {c}"

    new = [gap("credit_score", 7), gap("employment_type", 11), gap("missed_payments_last_6m", 13), odd("emi_to_income_ratio", 17), odd("savings_decline_pct", 19)]
    return f"{W1}, gaps AS (SELECT * REPLACE ({', '.join(new)}) FROM risk_customer)"


@query("row_count", f"{W1} SELECT COUNT(*) AS n_rows, CAST(18 AS INT) AS n_columns FROM risk_customer")
def q_row_count(spark, sf_dir):
    """Rows and columns of the customer table (AGG-1)."""
    return P.row_count(risk_customer(spark, sf_dir))


@query(
    "null_profile_nonzero",
    _gap_sql() + " SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{f.name}' AS column, COUNT(*) FILTER (WHERE {f.name} IS NULL"
        + (f" OR isnan({f.name})" if isinstance(f.dataType, T.DoubleType) else "")
        + ") AS null_count FROM gaps"
        for f in V1_SCHEMA.fields
    ) + ") WHERE null_count > 0",
)
def q_null_profile_nonzero(spark, sf_dir):
    """Columns with missing cells only, on customers with gaps (AGG-5, FLT-8)."""
    return P.null_profile(with_gaps(risk_customer(spark, sf_dir)))


_GAPPED = ("credit_score", "emi_to_income_ratio", "savings_decline_pct", "missed_payments_last_6m")


@query(
    "range_profile_gaps",
    _gap_sql() + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS column, MIN(CASE WHEN NOT isnan(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END) AS min, "
        f"MAX(CASE WHEN NOT isnan(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END) AS max, "
        f"COUNT(*) FILTER (WHERE {c} IS NULL OR isnan(CAST({c} AS DOUBLE))) AS nan_count, "
        f"COUNT(*) FILTER (WHERE isinf(CAST({c} AS DOUBLE))) AS inf_count FROM gaps"
        for c in _GAPPED
    ),
)
def q_range_profile_gaps(spark, sf_dir):
    """Ranges, missing and infinite counts on customers with gaps (AGG-6)."""
    return P.range_profile(with_gaps(risk_customer(spark, sf_dir)), list(_GAPPED))


@query(
    "fill_non_finite_gaps",
    _gap_sql() + " SELECT customer_id, COALESCE(credit_score, 0) AS credit_score, COALESCE(missed_payments_last_6m, 0) AS missed_payments_last_6m, "
    + ", ".join(f"CASE WHEN {c} IS NULL OR isnan({c}) OR isinf({c}) THEN 0.0e0 ELSE {c} END AS {c}" for c in ("emi_to_income_ratio", "savings_decline_pct"))
    + " FROM gaps",
)
def q_fill_non_finite_gaps(spark, sf_dir):
    """NULL, NaN and infinite cells to 0 on customers with gaps (ENC-4, SCL-12..14)."""
    return fill_non_finite(with_gaps(risk_customer(spark, sf_dir)).select("customer_id", *_GAPPED), 0.0, list(_GAPPED))


_IMPUTED = ("credit_score", "missed_payments_last_6m")


@query(
    "impute_scale_gaps",
    _gap_sql() + ", " + ", ".join(
        f"m{i} AS (SELECT MEDIAN(CAST({c} AS DOUBLE)) AS m FROM gaps), f{i} AS (SELECT customer_id, COALESCE(CAST({c} AS DOUBLE), (SELECT m FROM m{i})) AS v FROM gaps)"
        for i, c in enumerate(_IMPUTED)
    )
    + " SELECT a.customer_id, ROUND((a.v - (SELECT AVG(v) FROM f0)) / (SELECT STDDEV_POP(v) FROM f0), 6) AS credit_score, "
    "ROUND((b.v - (SELECT AVG(v) FROM f1)) / (SELECT STDDEV_POP(v) FROM f1), 6) AS missed_payments_last_6m "
    "FROM f0 a JOIN f1 b ON a.customer_id = b.customer_id",
)
def q_impute_scale_gaps(spark, sf_dir):
    """Median imputation and scaling where a seventh of the scores is missing (AGG-17, ENC-5)."""
    df = with_gaps(risk_customer(spark, sf_dir)).select("customer_id", *_IMPUTED)
    return round_doubles(ImputeScale(inputCols=list(_IMPUTED)).fit(df).transform(df))


def _null_sql(f: T.StructField) -> str:
    miss = f"{f.name} IS NULL" + (f" OR isnan({f.name})" if isinstance(f.dataType, T.DoubleType) else "")
    return f"SELECT '{f.name}' AS column, COUNT(*) FILTER (WHERE {miss}) AS null_count FROM risk_customer"


@query("null_profile", f"{W1} " + " UNION ALL ".join(_null_sql(f) for f in V1_SCHEMA.fields))
def q_null_profile(spark, sf_dir):
    return P.null_profile(risk_customer(spark, sf_dir), nonzero_only=False)


def _range_sql(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return (
        f"SELECT '{c}' AS column, MIN(CASE WHEN NOT isnan({x}) THEN {x} END) AS min, "
        f"MAX(CASE WHEN NOT isnan({x}) THEN {x} END) AS max, "
        f"COUNT(*) FILTER (WHERE {x} IS NULL OR isnan({x})) AS nan_count, "
        f"COUNT(*) FILTER (WHERE isinf({x})) AS inf_count FROM f"
    )


@query(
    "range_profile",
    f"{W1}, f AS (SELECT *, {S.select_list(S.BASE)} FROM risk_customer) "
    + " UNION ALL ".join(_range_sql(c) for c in BASE_COLS),
)
def q_range_profile(spark, sf_dir):
    return P.range_profile(add_features(risk_customer(spark, sf_dir), "base"), BASE_COLS)


_CORR_COLS = [
    f.name for f in V1_SCHEMA.fields if isinstance(f.dataType, (T.IntegerType, T.LongType, T.DoubleType))
] + BASE_COLS
_CORR_COLS = list(dict.fromkeys(_CORR_COLS))


def _corr_sql(c: str) -> str:
    x, y = f"CAST({c} AS DOUBLE)", "CAST(default_next_30_days AS DOUBLE)"
    return f"SELECT '{c}' AS column, ROUND(COVAR_POP({x},{y})/(STDDEV_POP({x})*STDDEV_POP({y})), 6) AS correlation FROM f"


@query(
    "target_correlation",
    f"{W1}, f AS (SELECT *, {S.select_list(S.BASE)} FROM risk_customer) "
    + " UNION ALL ".join(_corr_sql(c) for c in _CORR_COLS),
)
def q_target_correlation(spark, sf_dir):
    df = add_features(risk_customer(spark, sf_dir), "base")
    cols = [c for c in numeric_columns(df) if c in _CORR_COLS]
    return round_doubles(P.target_correlation(df, TARGET_V1, cols))


@query(
    "feature_means_by_label",
    f"{W1} SELECT default_next_30_days, "
    + ", ".join(f"ROUND(AVG({c}), 6) AS {c}" for c in HIGH_IMPACT)
    + " FROM risk_customer GROUP BY default_next_30_days",
)
def q_feature_means_by_label(spark, sf_dir):
    return round_doubles(P.means_by(risk_customer(spark, sf_dir), TARGET_V1, list(HIGH_IMPACT)))


@query(
    "feature_stats_by_label",
    f"{W1} "
    + " UNION ALL ".join(
        f"SELECT default_next_30_days, '{c}' AS feature, ROUND(AVG({c}), 6) AS mean, ROUND(STDDEV_SAMP({c}), 6) AS std, "
        f"CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max FROM risk_customer GROUP BY default_next_30_days"
        for c in OVERLAP
    ),
)
def q_feature_stats_by_label(spark, sf_dir):
    return round_doubles(P.stats_by(risk_customer(spark, sf_dir), TARGET_V1, list(OVERLAP)))


_DESCRIBE = ("credit_score", "emi_to_income_ratio", "risk_momentum_score")


@query(
    "describe_exact",
    f"{W1}, {S.quantile_table('risk_customer', list(_DESCRIBE), [0.25, 0.5, 0.75])} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column, COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean, ROUND(STDDEV_SAMP({c}), 6) AS std, "
        f"CAST(MIN({c}) AS DOUBLE) AS min, "
        f"(SELECT ROUND(value, 6) FROM qt WHERE column_name='{c}' AND prob=0.25) AS p25, "
        f"(SELECT ROUND(value, 6) FROM qt WHERE column_name='{c}' AND prob=0.5) AS p50, "
        f"(SELECT ROUND(value, 6) FROM qt WHERE column_name='{c}' AND prob=0.75) AS p75, "
        f"CAST(MAX({c}) AS DOUBLE) AS max FROM risk_customer"
        for c in _DESCRIBE
    ),
)
def q_describe_exact(spark, sf_dir):
    return round_doubles(P.describe_exact(risk_customer(spark, sf_dir), list(_DESCRIBE)))


# The category levels of employment_type in the derived tables
# (only the oracle SQL needs them spelled out; the estimator fits them).
_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query(
    "one_hot_employment",
    f"{W1} SELECT customer_id, "
    + ", ".join(f"CASE WHEN employment_type='{s}' THEN 1 ELSE 0 END AS employment_type_{s}" for s in _SEGMENTS[1:])
    + f", {TARGET_V1} FROM risk_customer",
)
def q_one_hot_employment(spark, sf_dir):
    df = risk_customer(spark, sf_dir).select("customer_id", "employment_type", TARGET_V1)
    return OneHot(inputCols=["employment_type"]).fit(df).transform(df)


_SCALED = ("credit_score", "emi_to_income_ratio", "credit_utilization_ratio", "savings_decline_pct")


def _scaled_sql() -> str:
    med = {c: f"(SELECT value FROM qt WHERE column_name='{c}')" for c in _SCALED}
    filled = ", ".join(f"COALESCE(CAST({c} AS DOUBLE), {med[c]}) AS {c}" for c in _SCALED)
    scaled = ", ".join(
        f"ROUND(({c} - AVG({c}) OVER ()) / CASE WHEN STDDEV_POP({c}) OVER () = 0 THEN 1.0e0 ELSE STDDEV_POP({c}) OVER () END, 6) AS {c}"
        for c in _SCALED
    )
    return (
        f"{W1}, {S.quantile_table('risk_customer', list(_SCALED), [0.5])}, "
        f"filled AS (SELECT customer_id, {filled} FROM risk_customer) SELECT customer_id, {scaled} FROM filled"
    )


@query("impute_scale", _scaled_sql())
def q_impute_scale(spark, sf_dir):
    df = risk_customer(spark, sf_dir).select("customer_id", *_SCALED)
    return round_doubles(ImputeScale(inputCols=list(_SCALED)).fit(df).transform(df))


def _fill_sql() -> str:
    exprs = []
    for c in BASE_COLS:
        if c in ("total_delinquency_events", "recent_payment_trouble"):
            exprs.append(f"COALESCE({c}, 0) AS {c}")
        else:
            exprs.append(f"CASE WHEN {c} IS NULL OR isnan({c}) OR isinf({c}) THEN 0.0e0 ELSE {c} END AS {c}")
    return f"{W1}, f AS (SELECT customer_id, {S.select_list(S.BASE)} FROM risk_customer) SELECT customer_id, {', '.join(exprs)} FROM f"


@query("fill_non_finite", _fill_sql())
def q_fill_non_finite(spark, sf_dir):
    df = add_features(risk_customer(spark, sf_dir), "base").select("customer_id", *BASE_COLS)
    return fill_non_finite(df, 0.0, BASE_COLS)


def _kinds_sql() -> str:
    def kind(f):
        if isinstance(f.dataType, (T.IntegerType, T.LongType, T.DoubleType)):
            return "numeric"
        return "categorical" if isinstance(f.dataType, (T.StringType, T.BooleanType)) else "other"

    return f"{W1} " + " UNION ALL ".join(
        f"SELECT '{f.name}' AS column, '{kind(f)}' AS kind, COUNT({f.name}) AS non_null FROM risk_customer"
        for f in V1_SCHEMA.fields
    )


@query("selected_types", _kinds_sql())
def q_selected_types(spark, sf_dir):
    return P.column_kinds(risk_customer(spark, sf_dir))


@query(
    "first_rows_by_key",
    f"{W1} SELECT * FROM risk_customer ORDER BY customer_id LIMIT 5",
)
def q_first_rows(spark, sf_dir):
    """First five customers in key order (SRT-4): a top-n report, the limit is the feature."""
    return P.head_by_key(risk_customer(spark, sf_dir), "customer_id", 5)


# --- states per week, merged (AGG-7, AGG-8, AGG-10, AGG-12, FEA-27) ---------------

_STATE_COLS = ["monthly_income", "savings_decline_pct", "credit_utilization_ratio", "failed_autodebit_count", "unified_stress_index"]
_STATE_WEEKS = ((0, 120), (120, 260), (260, 1 << 30))


def _by_weeks(spark, sf_dir, store, columns):
    """The statements added in three lots of weeks, the middle one twice."""
    s = cut_lineage(stress_statement(spark, sf_dir).select("week_number", TARGET_V2, *columns))
    for lo, hi in (_STATE_WEEKS[0], _STATE_WEEKS[1], _STATE_WEEKS[1], _STATE_WEEKS[2]):
        store.add(s.where((F.col("week_number") >= lo) & (F.col("week_number") < hi)))
    return s


def _store_path(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/states-{uuid.uuid4().hex}"


@stored
def _moments(spark, sf_dir):
    store = MomentStore(spark, _store_path(spark), _STATE_COLS, TARGET_V2)
    _by_weeks(spark, sf_dir, store, _STATE_COLS)
    return store


@query(
    "merged_stats_by_label",
    f"{W2} "
    + " UNION ALL ".join(
        f"SELECT default_next_4_weeks AS label, '{c}' AS feature, COUNT({c}) AS n, ROUND(AVG({c}), 6) AS mean, ROUND(STDDEV_SAMP({c}), 6) AS std, "
        f"CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max FROM stress_statement GROUP BY default_next_4_weeks"
        for c in ("monthly_income", "savings_decline_pct", "credit_utilization_ratio", "failed_autodebit_count", "unified_stress_index")
    ),
)
def q_merged_stats_by_label(spark, sf_dir):
    """Means, deviations and ranges by label from the merged weekly states (AGG-8, AGG-10)."""
    out = _moments(spark, sf_dir).stats()
    return out.select("label", "feature", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", "max")


@query(
    "merged_target_correlation",
    f"{W2} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, ROUND(CORR(CAST({c} AS DOUBLE), CAST(default_next_4_weeks AS DOUBLE)), 6) AS correlation FROM stress_statement"
        for c in ("monthly_income", "savings_decline_pct", "credit_utilization_ratio", "failed_autodebit_count", "unified_stress_index")
    ),
)
def q_merged_target_correlation(spark, sf_dir):
    """Correlations with the label from the merged weekly states (AGG-7)."""
    out = _moments(spark, sf_dir).correlations()
    return out.select(F.col("column").alias("column_name"), F.round("correlation", 6).alias("correlation"))


@query(
    "incremental_clip_limits",
    f"{W2}, {S.quantile_caps('stress_statement', ['unified_stress_index', 'gambling_spend', 'total_spend'], 0.99)} SELECT column_name, cap FROM caps",
)
def q_incremental_clip_limits(spark, sf_dir):
    """The caps of ``clip_limits_v2`` from weekly sketches and one exact pass (AGG-12, FEA-27)."""
    columns = ["unified_stress_index", "gambling_spend", "total_spend"]
    store = QuantileStore(spark, _store_path(spark), columns)
    s = _by_weeks(spark, sf_dir, store, columns)
    return store.quantiles(s, [0.99]).select(F.col("column").alias("column_name"), F.col("value").alias("cap"))
