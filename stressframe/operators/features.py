"""Feature catalogue (FEA-1..26), p99 clip estimator (FEA-27), alignment (PRJ-6..8).

A feature is a named Column expression with the input columns it needs. A
feature set is an ordered list; ``add_features`` keeps the features whose
inputs exist (schema-adaptive, as the v2 transformer) and emits all of them in
one projection, so Catalyst fuses them into a single codegen stage.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stressframe.functions.columns import clip_lower, clip_upper, flag, ratio, right_closed_bins
from stressframe.operators.quantile import quantile_rows

# The epsilon guards, thresholds and bins of the feature formulas.
EPS = 1e-5
PANIC_CUTBACK = 0.3
HEADROOM_FLOOR_V1 = 0.01
DELAY_BIN_EDGES = (-1, 0, 15, 30, 1000)
DELAY_BIN_LABELS = (0, 1, 3, 5)
STORM_INCOME_DROP = 0.15
STORM_SAVINGS_DECLINE = 0.3
LIQUIDITY_OFFSET = 0.1
# Columns capped at their 0.99 quantile, per feature set.
CLIP_V1 = ("income_drop_pct", "savings_decline_pct", "gambling_spend_increase_pct")
CLIP_V2 = ("unified_stress_index", "gambling_spend", "total_spend", "income_drop_pct")
CLIP_QUANTILE = 0.99
# Model input order of the v2 stack (raw, then derived).
V2_MODEL_COLUMNS = (
    "employment_type", "monthly_income", "emi_amount", "credit_limit",
    "salary_delay_days", "total_spend", "essential_spend",
    "discretionary_spend", "gambling_spend", "savings_balance",
    "savings_decline_pct", "liquidity_ratio", "credit_utilization_ratio",
    "failed_autodebit_count", "lending_app_txn_count",
    "stress_momentum_score", "behavioral_shock_index", "unified_stress_index",
    "stress_acceleration", "shock_amplification",
    "income_utilization", "gambling_ratio", "delayed_liquidity_crunch",
    "savings_income_strain", "utilization_headroom", "total_delinquency_events",
)
# The six-feature selection of the simplified model (PRJ-3).
CORE_FEATURES = (
    "missed_payments_last_6m", "failed_autodebit_count", "risk_momentum_score",
    "credit_utilization_ratio", "adjusted_obligation_burden", "gambling_spend_increase_pct",
)


@dataclass(frozen=True)
class Feature:
    name: str
    requires: tuple[str, ...]
    build: Callable[[], Column]
    unless: tuple[str, ...] = ()  # only when all of these columns are absent


def c(name: str) -> Column:
    return F.col(name)


def _per_credit_tier(x: str) -> Column:
    return ratio(c(x), c("credit_score") / 100 + EPS)


def _headroom(floor: float) -> Column:
    return clip_lower(1 - c("credit_utilization_ratio"), floor)


_STRESS_GATE = ("unified_stress_index", "stress_momentum_score")

V1 = [
    Feature("gambling_stress_interaction", ("gambling_spend_increase_pct", "emi_to_income_ratio"),
            lambda: c("gambling_spend_increase_pct") * c("emi_to_income_ratio")),
    Feature("panic_cutback_flag", ("discretionary_spend_drop_pct",),
            lambda: flag(c("discretionary_spend_drop_pct") > PANIC_CUTBACK)),
    Feature("savings_cushion_erosion", ("savings_decline_pct", "income_drop_pct"),
            lambda: c("savings_decline_pct") * c("income_drop_pct")),
    # v1 assigns headroom twice; the second definition (floor 0.01) is final
    Feature("utilization_headroom", ("credit_utilization_ratio",), lambda: _headroom(HEADROOM_FLOOR_V1)),
    Feature("recent_delinquency_intensity", ("missed_payments_last_6m", "recent_failed_autodebit_flag"),
            lambda: c("missed_payments_last_6m") * c("recent_failed_autodebit_flag")),
    Feature("utility_delay_severity", ("utility_payment_delay_days",),
            lambda: right_closed_bins("utility_payment_delay_days", DELAY_BIN_EDGES, DELAY_BIN_LABELS)),
    Feature("total_delinquency_events", ("missed_payments_last_6m", "failed_autodebit_count"),
            lambda: c("missed_payments_last_6m") + c("failed_autodebit_count")),
    Feature("failed_autodebit_count_per_credit_tier", ("failed_autodebit_count", "credit_score"),
            lambda: _per_credit_tier("failed_autodebit_count")),
    Feature("utility_payment_delay_days_per_credit_tier", ("utility_payment_delay_days", "credit_score"),
            lambda: _per_credit_tier("utility_payment_delay_days")),
    Feature("income_drop_pct_per_credit_tier", ("income_drop_pct", "credit_score"),
            lambda: _per_credit_tier("income_drop_pct")),
    Feature("stress_concentration", ("emi_to_income_ratio", "credit_utilization_ratio"),
            lambda: ratio(c("emi_to_income_ratio"), _headroom(HEADROOM_FLOOR_V1))),
    Feature("perfect_storm", ("income_drop_pct", "savings_decline_pct", "missed_payments_last_6m"),
            lambda: flag((c("income_drop_pct") > STORM_INCOME_DROP)
                         & (c("savings_decline_pct") > STORM_SAVINGS_DECLINE)
                         & (c("missed_payments_last_6m") > 0))),
    Feature("adjusted_obligation_burden", ("emi_to_income_ratio", "savings_decline_pct"),
            lambda: c("emi_to_income_ratio") * (1 + clip_lower("savings_decline_pct", 0.0))),
    Feature("risk_velocity", ("risk_momentum_score", "credit_score"),
            lambda: ratio(c("risk_momentum_score"), c("credit_score") + EPS)),
    Feature("volatility_risk_factor", ("balance_volatility_30d", "savings_decline_pct"),
            lambda: c("balance_volatility_30d") * c("savings_decline_pct")),
]

BASE = [
    Feature("debt_stress_index", ("emi_to_income_ratio", "credit_utilization_ratio"),
            lambda: c("emi_to_income_ratio") * c("credit_utilization_ratio")),
    Feature("income_stability_shock", ("salary_delay_days", "income_drop_pct"),
            lambda: c("salary_delay_days") * c("income_drop_pct")),
    Feature("total_delinquency_events", ("missed_payments_last_6m", "failed_autodebit_count"),
            lambda: c("missed_payments_last_6m") + c("failed_autodebit_count")),
    Feature("financial_retrenchment", ("discretionary_spend_drop_pct", "savings_decline_pct"),
            lambda: c("discretionary_spend_drop_pct") * c("savings_decline_pct")),
    Feature("recent_payment_trouble", ("recent_failed_autodebit_flag", "utility_payment_delay_days"),
            lambda: c("recent_failed_autodebit_flag") * c("utility_payment_delay_days")),
    Feature("risk_velocity", ("risk_momentum_score", "credit_score"),
            lambda: ratio(c("risk_momentum_score"), c("credit_score") + EPS)),
    Feature("volatility_impact", ("balance_volatility_30d", "savings_decline_trend"),
            lambda: c("balance_volatility_30d") * c("savings_decline_trend")),
]

V2 = [
    Feature("stress_acceleration", _STRESS_GATE,
            lambda: c("unified_stress_index") * c("stress_momentum_score")),
    Feature("shock_amplification", (*_STRESS_GATE, "behavioral_shock_index"),
            lambda: c("behavioral_shock_index") * (1 + c("stress_momentum_score"))),
    Feature("income_utilization", (*_STRESS_GATE, "monthly_income", "total_spend"),
            lambda: ratio(c("total_spend"), c("monthly_income") + EPS)),
    Feature("gambling_ratio", (*_STRESS_GATE, "gambling_spend", "monthly_income"),
            lambda: ratio(c("gambling_spend"), c("monthly_income") + EPS)),
    Feature("delayed_liquidity_crunch", (*_STRESS_GATE, "salary_delay_days", "liquidity_ratio"),
            lambda: ratio(c("salary_delay_days"), c("liquidity_ratio") + LIQUIDITY_OFFSET)),
    Feature("gambling_stress_interaction", ("gambling_spend_increase_pct", "emi_to_income_ratio"),
            lambda: c("gambling_spend_increase_pct") * c("emi_to_income_ratio")),
    Feature("panic_cutback_flag", ("discretionary_spend_drop_pct",),
            lambda: flag(c("discretionary_spend_drop_pct") > PANIC_CUTBACK)),
    Feature("savings_cushion_erosion", ("savings_decline_pct", "income_drop_pct"),
            lambda: c("savings_decline_pct") * c("income_drop_pct")),
    Feature("savings_income_strain", ("savings_decline_pct", "monthly_income"),
            lambda: c("savings_decline_pct") * F.log1p(c("monthly_income")),
            unless=("income_drop_pct",)),
    Feature("utilization_headroom", ("credit_utilization_ratio",), lambda: _headroom(0.0)),
    Feature("recent_delinquency_intensity", ("missed_payments_last_6m", "recent_failed_autodebit_flag"),
            lambda: c("missed_payments_last_6m") * c("recent_failed_autodebit_flag")),
    Feature("total_delinquency_events", ("missed_payments_last_6m", "failed_autodebit_count"),
            lambda: c("missed_payments_last_6m") + c("failed_autodebit_count")),
    Feature("total_delinquency_events", ("failed_autodebit_count",),
            lambda: c("failed_autodebit_count"), unless=("missed_payments_last_6m",)),
]

FEATURE_SETS = {"v1": V1, "base": BASE, "v2": V2}


def applicable(columns: list[str], feature_set: str) -> list[Feature]:
    present = set(columns)
    out, seen = [], set()
    for f in FEATURE_SETS[feature_set]:
        if f.name in seen:
            continue
        if present.issuperset(f.requires) and not present.intersection(f.unless):
            out.append(f)
            seen.add(f.name)
    return out


def add_features(df: DataFrame, feature_set: str = "v2", strict: bool = False) -> DataFrame:
    """Append the feature set's columns in one projection.

    Non-strict (default): features whose inputs are absent are skipped. Strict:
    an absent input raises, as the non-adaptive v1 transformer would. An input
    column with a feature's name is replaced in place.
    """
    feats = applicable(df.columns, feature_set)
    if strict:
        missing = {n for f in FEATURE_SETS[feature_set] if not f.unless for n in f.requires} - set(df.columns)
        if missing:
            raise ValueError(f"missing inputs for feature set {feature_set}: {sorted(missing)}")
    exprs = {f.name: f.build().alias(f.name) for f in feats}
    kept = [exprs.pop(name) if name in exprs else F.col(name) for name in df.columns]
    return df.select(*kept, *exprs.values())


def added_columns(before: list[str], after: list[str]) -> list[str]:
    """Names present after and not before, in order (PRJ-7)."""
    old = set(before)
    return [c for c in after if c not in old]


def align(df: DataFrame, columns: list[str] | tuple[str, ...], fill=0, keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly ``keep + columns`` in that order; absent columns become ``fill`` (PRJ-6)."""
    present = set(df.columns)
    return df.select(
        *keep, *[F.col(c) if c in present else F.lit(fill).alias(c) for c in columns]
    )


def drop_ids(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Drop the named columns that exist (PRJ-2)."""
    return df.drop(*[n for n in names if n in df.columns])


class _ClipParams(HasInputCols):
    quantile = Param(Params._dummy(), "quantile", "upper quantile used as the cap", TypeConverters.toFloat)
    relativeError = Param(
        Params._dummy(), "relativeError",
        "0 for exact interpolated quantiles; > 0 switches to percentile_approx", TypeConverters.toFloat,
    )

    def __init__(self):
        super().__init__()
        self._setDefault(quantile=CLIP_QUANTILE, relativeError=0.0)


class ClipLimits(Estimator, _ClipParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fit per-column caps at a quantile (FEA-27); absent columns are ignored."""

    @keyword_only
    def __init__(self, *, inputCols=None, quantile=CLIP_QUANTILE, relativeError=0.0):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ClipLimitsModel":
        cols = [c for c in self.getInputCols() if c in df.columns]
        q = self.getOrDefault(self.quantile)
        rel = self.getOrDefault(self.relativeError)
        limits: dict[str, float] = {}
        if cols and rel > 0:
            acc = max(1, int(1.0 / rel))
            row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), q, acc).alias(c) for c in cols]).first()
            limits = {c: row[c] for c in cols if row[c] is not None}
        elif cols:
            for r in quantile_rows(df, cols, [q]):  # one row per column
                if r["value"] is not None:
                    limits[r["column"]] = r["value"]
        names = [c for c in cols if c in limits]
        return ClipLimitsModel(limitCols=names, limitValues=[float(limits[c]) for c in names])


class ClipLimitsModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    limitCols = Param(Params._dummy(), "limitCols", "capped columns", TypeConverters.toListString)
    limitValues = Param(Params._dummy(), "limitValues", "caps, aligned with limitCols", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, limitCols=None, limitValues=None):
        super().__init__()
        self._setDefault(limitCols=[], limitValues=[])
        self._set(**self._input_kwargs)

    def limits(self) -> dict[str, float]:
        return dict(zip(self.getOrDefault(self.limitCols), self.getOrDefault(self.limitValues)))

    def _transform(self, df: DataFrame) -> DataFrame:
        caps = self.limits()
        return df.select(*[clip_upper(c, caps[c]).alias(c) if c in caps else F.col(c) for c in df.columns])


def clip_quantile(df: DataFrame, cols: tuple[str, ...], q: float = CLIP_QUANTILE) -> DataFrame:
    """Reference behaviour: caps re-estimated from the frame being transformed."""
    return ClipLimits(inputCols=list(cols), quantile=q).fit(df).transform(df)
