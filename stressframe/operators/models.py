"""Model fitting on Spark ML: learners, out-of-fold scoring, stacking, search
(MOD-1..18, SPL-3, SET-1, JOIN-2).

* The boosting libraries map to presets of ``operators/boost.py``, the forests to
  ``operators/forest.py``, the linear models to ``LogisticRegression`` with
  scikit-learn's C mapped to ``regParam = 1 / (C * sum(weights))``.
* Out-of-fold (OOF) scores come from k x m fits on one cached, assembled frame;
  each fold's held-out rows are scored by chaining that fold's models on the
  same rows (no join of prediction vectors), and folds are unioned.
* Fits run concurrently from driver threads (Spark schedules their jobs
  together); only fitted models and metric rows reach the driver.
* The final stack is one persistable ``PipelineModel``: indexer, assembler,
  base models, a slicer taking P(class 1) of each, and the logistic meta model.
"""

from __future__ import annotations

import functools
import json
import math
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stressframe.operators.boost import Boost, FitBins, fit_bins, fit_boost, labelled_rows
from stressframe.operators.encode import ImputeScale
from stressframe.operators.forest import fit_forest

SEED = 42
#: Of a fit input; the count of partitions follows from the rows alone: small parts up to
#: MANY_PARTITIONS of them, then full ones, as every pass of a learner pays for each part.
ROWS_PER_PARTITION, FULL_PARTITION, MANY_PARTITIONS = 10_000, 250_000, 32
KEPT_ROWS = 2_000_000  # of a fit input that is kept in memory
# Learner presets of the reference's models: rounds, rates and controls as given there.
PRESETS = {
    # LightGBM, tuned (weight 2.475; the two-model recipe gives 2.4752)
    "lgbm": dict(family="boost", rounds=1351, rate=0.031, depth=3, leaves=40, min_rows=71, row_rate=0.956, col_rate=0.837,
                 l1=7e-05, l2=0.0008, pos_weight=2.475, patience=50),
    # the same with the digits of the two-model recipe
    "lgbm_final": dict(family="boost", rounds=1351, rate=0.03118, depth=3, leaves=40, min_rows=71, row_rate=0.9558, col_rate=0.8371,
                       l1=7e-05, l2=0.0008, pos_weight=2.4752, patience=50),
    # LightGBM of the optimized recipe: 31 leaves, no depth limit (weight: per-fold neg/pos)
    "lgbm_optimized": dict(family="boost", rounds=1000, rate=0.03, leaves=31, min_rows=20, row_rate=0.8, col_rate=0.8, patience=50),
    # LightGBM of the simplified recipe (weight: per-fold neg/pos)
    "lgbm_simple": dict(family="boost", rounds=500, rate=0.05, depth=4, leaves=15, min_rows=50, l1=1.0, l2=1.0, patience=50),
    # XGBoost (library defaults: L2 1, child weight 1)
    "xgb": dict(family="boost", rounds=1000, rate=0.03, depth=4, row_rate=0.8, col_rate=0.8, l2=1.0, min_weight=1.0, pos_weight=2.5, patience=50),
    # XGBoost with library defaults (weight: neg/pos); also the base of the random search
    "xgb_default": dict(family="boost", rounds=100, rate=0.3, depth=6, l2=1.0, min_weight=1.0),
    # XGBoost of the five-model vote (weight: neg/pos of the training rows)
    "xgb_vote": dict(family="boost", rounds=300, rate=0.05, depth=6, row_rate=0.8, col_rate=0.8, l2=1.0, min_weight=1.0),
    # CatBoost of the stacks (library default L2 3)
    "cat": dict(family="boost", rounds=1000, rate=0.03, depth=6, l2=3.0, pos_weight=2.5, patience=50),
    # CatBoost alone (weight: per-fold neg/pos)
    "cat_alone": dict(family="boost", rounds=2000, rate=0.02, depth=6, l2=3.0, patience=100),
    # LightGBM of the ceiling check: library defaults but 500 rounds
    "ceiling": dict(family="boost", rounds=500, rate=0.1, leaves=31, min_rows=20),
    # LightGBM defaults: the base of the range study
    "lgbm_default": dict(family="boost", rounds=100, rate=0.1, leaves=31, min_rows=20, patience=50),
    # scikit-learn's gradient boosting: 10% validation, patience 10 on the loss
    "gb": dict(family="boost", rounds=200, rate=0.05, depth=5, patience=10, metric="loss", validation_fraction=0.1),
    # RandomForest with library defaults, balanced (no depth limit: the largest depth of Spark ML's forests)
    "rf_default": dict(family="rf", trees=100, depth=30, min_rows=1, balanced=True),
    # RandomForest, balanced: 300 trees, depth 10, min leaf 4
    "rf": dict(family="rf", trees=300, depth=10, min_rows=4, balanced=True),
    # ExtraTrees, balanced: 300 trees, no bootstrap, coarse random-like splits
    "et": dict(family="rf", trees=300, depth=10, min_rows=4, bootstrap=False, max_bins=8, balanced=True),
    # LogisticRegression on imputed + scaled input, balanced, C = 0.1
    "lr": dict(family="lr", C=0.1, balanced=True, scaled=True),
    # meta learner: LogisticRegression defaults, C = 1
    "meta": dict(family="lr", C=1.0),
}


def fit_partitions(n: int) -> int:
    """Partitions of a fit input of ``n`` rows."""
    return max(1, min(math.ceil(n / ROWS_PER_PARTITION), MANY_PARTITIONS), math.ceil(n / FULL_PARTITION))


def materialize(df: DataFrame, full: bool = False) -> DataFrame:
    """Write an iterative-fit input to the checkpoint folder (lineage cut: fits and
    executor loss never recompute the derivation). The number of partitions follows
    from the row count and each row's place from the hash of its values, so what a
    learner samples per partition does not depend on the cluster's cores. ``full``:
    only full partitions, for tables that many fits pass over side by side."""
    from stressframe.session import checkpoint_path, cut_lineage, drop_stored

    df = cut_lineage(df)  # counted and dealt out: what gives the rows runs once
    n = df.count()
    parts = max(1, math.ceil(n / FULL_PARTITION)) if full else fit_partitions(n)
    scalars = [c for c, t in df.dtypes if not t.startswith(("vector", "map"))]
    dealt = cut_lineage(df.repartition(parts, F.xxhash64(*scalars)).sortWithinPartitions(F.xxhash64(*scalars)))
    drop_stored(df.sparkSession, checkpoint_path(df))
    return dealt


@dataclass
class Prepared:
    data: DataFrame           # key, label, fold?, features (vector)
    feature_names: list[str]
    prep_model: PipelineModel  # indexers, missing-value fill, assembler


MISSING_SENTINEL = -1.0e9  # below every real value: trees route missing inputs to one side


def prepare(
    df: DataFrame, label: str, features: list[str], categorical: list[str] = (), keep: tuple[str, ...] = (),
    missing: float | None = MISSING_SENTINEL,
) -> Prepared:
    """Index categoricals (fitted levels, unseen -> extra index, ENC-2), map
    missing numeric inputs to ``missing`` (the boosting libraries take NaN
    natively; Spark's trees reject it) and assemble one vector ``features``.
    Every step is a pipeline stage, so a saved model scores raw rows."""
    stages = []
    cols = []
    types = {f.name: f.dataType for f in df.schema.fields}
    fills = []
    for c in features:
        if c in categorical:
            stages.append(StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep",
                                        stringOrderType="alphabetAsc"))
            cols.append(f"{c}__idx")
        elif missing is not None:
            x = f"nanvl(`{c}`, NULL)" if types[c].typeName() in ("double", "float") else f"`{c}`"
            fills.append(f"CAST(coalesce({x}, {missing!r}) AS DOUBLE) AS `{c}__f`")
            cols.append(f"{c}__f")
        else:
            cols.append(c)
    if fills:
        stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(fills)} FROM __THIS__"))
    stages.append(VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep"))
    model = Pipeline(stages=stages).fit(df)
    data = model.transform(df).select(*keep, label, "features")
    return Prepared(data, list(features), model)


def ratio_weight(neg: int, pos: int) -> float:
    """Weight of positives that balances the classes; 1 without positives."""
    return neg / pos if pos else 1.0


def class_weights(df: DataFrame, label: str, scheme: str | float) -> tuple[float, float]:
    """(w0, w1): 'balanced' = n / (2 n_c); 'ratio' = (1, neg/pos); a number = (1, number)."""
    if isinstance(scheme, (int, float)):
        return 1.0, float(scheme)
    row = df.agg(F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")).first()
    neg, pos = row["neg"], row["pos"]
    if scheme == "balanced":
        n = neg + pos
        return (n / (2.0 * neg) if neg else 1.0), (n / (2.0 * pos) if pos else 1.0)
    if scheme == "ratio":
        return 1.0, ratio_weight(neg, pos)
    raise ValueError(scheme)


def weight_column(label: str, w0: float, w1: float) -> Column:
    return F.when(F.col(label) == 1, F.lit(w1)).otherwise(F.lit(w0))


def make_learner(kind: str, label: str, name: str | None = None, weight_col: str | None = None, reg_param: float = 0.0, **overrides):
    """A Spark ML classifier for a linear preset; output columns are suffixed by
    ``name`` so several models can score the same frame."""
    p = {**PRESETS[kind], **overrides}
    name = name or kind
    if p["family"] != "lr":
        raise ValueError(kind)
    est = LogisticRegression(
        labelCol=label, featuresCol=p.get("featuresCol", "features"), maxIter=p.get("maxIter", 1000),
        regParam=reg_param, elasticNetParam=0.0, standardization=False,
    )
    est.setProbabilityCol(f"pv_{name}").setRawPredictionCol(f"rp_{name}").setPredictionCol(f"pd_{name}")
    if weight_col:
        est.setWeightCol(weight_col)
    return est


def prob1(name: str) -> Column:
    """P(class 1) of a model scored with ``make_learner(..., name=name)``."""
    return vector_to_array(F.col(f"pv_{name}"))[1]


def fit_concurrency(df: DataFrame, requested: int | None = None) -> int:
    """How many fits run at a time: a boosted fit is one task, so one per core."""
    return max(1, requested or df.sparkSession.sparkContext.defaultParallelism)


@dataclass
class FoldFit:
    name: str
    fold: int
    model: object


@dataclass
class OOFResult:
    oof: DataFrame                     # key, label, fold, prob_<name> ...
    fits: list[FoldFit] = field(default_factory=list)


def boost_params(kind: str, weight: float | None = None, early_stop: bool = True, **overrides) -> Boost:
    """The preset's boosting parameters with ``weight`` for positives (None: the
    preset's), without entries that do not belong to ``Boost``; ``overrides`` win."""
    own = {} if weight is None else {"pos_weight": weight}
    p = {k: v for k, v in {**PRESETS[kind], **own, **overrides}.items() if k in Boost.__dataclass_fields__}
    if not early_stop:
        p["patience"] = 0
    return Boost(**p)


def fit_one(
    train: DataFrame, kind: str, name: str, label: str, weighting=None, early_stop_on: DataFrame | None = None, bins: FitBins | None = None,
):
    """Fit one learner on ``train``. ``weighting`` (None: the preset's own) is a
    scheme of ``class_weights``. A boosted preset with patience stops on
    ``early_stop_on`` (the reference stops on the fold it scores) or, where the
    preset names a validation fraction, on that share of its own rows; without
    either it runs all its rounds.  ``bins``: ``fit_bins`` of ``train``, shared by several
    boosted fits."""
    p = PRESETS[kind]
    scheme = weighting if weighting is not None else ("balanced" if p.get("balanced") else p.get("pos_weight", None))
    if p["family"] == "boost":
        share = p.get("validation_fraction", 0.0)
        w1 = class_weights(train, label, scheme)[1] if scheme is not None else None
        params = boost_params(kind, w1, early_stop=early_stop_on is not None or bool(share))
        return fit_boost(train, label, name, params, early_stop_on, valid_share=share, bins=bins)
    if p["family"] == "rf":
        weights = class_weights(train, label, scheme) if scheme is not None else (1.0, 1.0)
        controls = {k: v for k, v in p.items() if k in ("trees", "depth", "min_rows", "bootstrap", "max_bins")}
        return fit_forest(train, label, name, weights=weights, seed=SEED, **controls)
    data, wcol = train, None
    if scheme is not None:
        w0, w1 = class_weights(train, label, scheme)
        data, wcol = data.withColumn("_w", weight_column(label, w0, w1)), "_w"
    n_w = data.agg(F.sum(F.col(wcol)) if wcol else F.count(F.lit(1))).first()[0]
    reg = 1.0 / (p["C"] * float(n_w))
    return make_learner(kind, label, name=name, weight_col=wcol, reg_param=reg).fit(data)


def _kept(df: DataFrame, n: int) -> DataFrame:
    """``df`` kept in memory for many fits; a large one is read again from where it is stored,
    as most of the copy would go to the local disks."""
    return df.persist(StorageLevel.MEMORY_AND_DISK) if n <= KEPT_ROWS else df


def out_of_fold(
    prepared: DataFrame,
    learners: dict[str, str],
    label: str,
    key: str,
    fold_col: str = "fold",
    k: int = 5,
    weighting=None,
    early_stopping: bool = True,
    parallelism: int | None = None,
) -> OOFResult:
    """k x m fits; returns one OOF row per input row with ``prob_<name>``
    columns (MOD-11, SET-1). ``learners`` maps output name -> preset kind."""
    from stressframe.session import cut_lineage

    # one pass serves the class weights of all fits
    counts = {(r[fold_col], r[label]): r["count"] for r in prepared.groupBy(fold_col, label).count().collect()}
    data = _kept(prepared, sum(counts.values()))
    try:
        def weight(f, kind):
            scheme = weighting if weighting is not None else ("balanced" if PRESETS[kind].get("balanced") else PRESETS[kind].get("pos_weight"))
            neg, pos = (sum(n for (g, y), n in counts.items() if g != f and y == c) for c in (0, 1))
            return ratio_weight(neg, pos) if scheme == "ratio" else scheme

        boosted = any(PRESETS[kind]["family"] == "boost" for kind in learners.values())

        def run(job):
            f, name, kind = job
            own = data.where(F.col(fold_col) != f)
            if PRESETS[kind]["family"] != "boost":
                return FoldFit(name, f, fit_one(own, kind, name, label, weight(f, kind)))
            held = data.where(F.col(fold_col) == f) if early_stopping else None
            return FoldFit(name, f, fit_one(own, kind, name, label, weight(f, kind), held, bins[f]))

        with ThreadPoolExecutor(max_workers=fit_concurrency(data, parallelism)) as pool:
            bins = list(pool.map(lambda f: fit_bins(labelled_rows(data.where(F.col(fold_col) != f), label)), range(k))) if boosted else []
            fits = list(pool.map(run, [(f, name, kind) for f in range(k) for name, kind in learners.items()]))
        parts = []
        for f in range(k):
            scored = data.where(F.col(fold_col) == f)
            for fit in fits:
                if fit.fold == f:
                    scored = fit.model.transform(scored).withColumn(f"prob_{fit.name}", prob1(fit.name))
            parts.append(scored.select(key, label, fold_col, *[f"prob_{n}" for n in learners]))
        # small (one row per input row, a few doubles), but its lineage holds k x m model applications
        whole = functools.reduce(DataFrame.unionByName, parts)
        return OOFResult(cut_lineage(whole.coalesce(fit_partitions(sum(counts.values())))), fits)
    finally:
        data.unpersist()


@dataclass
class StackResult:
    oof: DataFrame             # key, label, fold, prob_<base>..., prob_meta
    meta_coefficients: DataFrame  # fold, feature, coefficient
    model: PipelineModel | None


def _meta_fit(train: DataFrame, cols: list[str], label: str):
    asm = VectorAssembler(inputCols=cols, outputCol="level2")
    data = asm.transform(train)
    n = data.count()
    lr = make_learner("meta", label, name="meta", reg_param=1.0 / max(1, n), featuresCol="level2")
    return asm, lr.fit(data)


def stack(
    prep: Prepared,
    bases: dict[str, str],
    label: str,
    key: str,
    fold_col: str = "fold",
    k: int = 5,
    refit: bool = True,
    parallelism: int | None = None,
) -> StackResult:
    """Two-level stack (MOD-12): base OOF scores, meta CV on the same folds
    (SPL-3), then bases refit on all rows and the meta model on all OOF rows."""
    from stressframe.session import cut_lineage

    res = out_of_fold(prep.data, bases, label, key, fold_col, k, parallelism=parallelism)
    oof = res.oof
    cols = [f"prob_{n}" for n in bases]
    metas, coef_rows = [], []
    for f in range(k):
        asm, m = _meta_fit(oof.where(F.col(fold_col) != f), cols, label)
        held = asm.transform(oof.where(F.col(fold_col) == f))
        metas.append(m.transform(held).select(*oof.columns, prob1("meta").alias("prob_meta")))
        coef_rows += [(f, c, float(v)) for c, v in zip(cols, m.coefficients.toArray())]
    meta_oof = metas[0]
    for p in metas[1:]:
        meta_oof = meta_oof.unionByName(p)
    spark = oof.sparkSession
    coefs = spark.createDataFrame(coef_rows, "fold int, feature string, coefficient double")
    model = None
    if refit:
        model = _refit_stack(prep, bases, label, oof, cols, parallelism)
    return StackResult(cut_lineage(meta_oof.coalesce(fit_partitions(oof.count()))), coefs, model)


def _refit_stack(prep: Prepared, bases: dict[str, str], label: str, oof: DataFrame, cols, parallelism):
    """Bases on all rows (no early stopping), meta on all OOF rows, as one PipelineModel."""
    data = prep.data
    bins = fit_bins(labelled_rows(data, label)) if any(PRESETS[kind]["family"] == "boost" for kind in bases.values()) else None

    def run(item):
        name, kind = item
        return fit_one(data, kind, name, label, bins=bins)

    with ThreadPoolExecutor(max_workers=fit_concurrency(data, parallelism)) as pool:
        base_models = list(pool.map(run, bases.items()))
    # level-2 input: [p0, p1] of each base; the slicer keeps the p1 entries
    asm2 = VectorAssembler(inputCols=[f"pv_{n}" for n in bases], outputCol="level2_all")
    slicer = VectorSlicer(inputCol="level2_all", outputCol="level2", indices=[2 * i + 1 for i in range(len(bases))])
    meta_asm = VectorAssembler(inputCols=cols, outputCol="level2")
    meta_data = meta_asm.transform(oof)
    n = meta_data.count()
    meta = make_learner("meta", label, name="meta", reg_param=1.0 / max(1, n), featuresCol="level2").fit(meta_data)
    return PipelineModel(stages=[*prep.prep_model.stages, *base_models, asm2, slicer, meta])


def score_stack(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """Chained scoring of a stack on one frame (POL-2)."""
    out = model.transform(df)
    bases = [c[3:] for c in out.columns if c.startswith("pv_") and c != "pv_meta"]
    return out.select(*keep, *[prob1(b).alias(f"prob_{b}") for b in bases], prob1("meta").alias("probability"))


def fold_auc_table(oof: DataFrame, label: str, models: list[str], fold_col: str = "fold") -> DataFrame:
    """AUC per (model, fold) and overall, exact (MET-2)."""
    from stressframe.operators.metrics import roc_auc

    long = oof.select(
        fold_col, label, F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"prob_{m}").alias("score")) for m in models]))
    )
    per_fold = roc_auc(long, label, "score", by=("model", fold_col))
    overall = roc_auc(long, label, "score", by=("model",)).withColumn(fold_col, F.lit(None).cast("int"))
    return per_fold.unionByName(overall)


def draw_params(space: dict[str, tuple], trials: int, seed: int = SEED) -> list[dict]:
    """Random draws from discrete lists or ranges: ('int', lo, hi), ('float', lo, hi),
    ('log', lo, hi), or a list of choices (MOD-15, MOD-16)."""
    rng = random.Random(seed)
    out = []
    for _ in range(trials):
        p = {}
        for k, spec in space.items():
            if isinstance(spec, list):
                p[k] = rng.choice(spec)
            elif spec[0] == "int":
                p[k] = rng.randint(spec[1], spec[2])
            elif spec[0] == "float":
                p[k] = rng.uniform(spec[1], spec[2])
            elif spec[0] == "log":
                p[k] = math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2])))
        out.append(p)
    return out


def random_search(
    prepared: DataFrame,
    kind: str,
    space: dict[str, tuple],
    label: str,
    fold_col: str = "fold",
    k: int = 3,
    trials: int = 20,
    seed: int = SEED,
    parallelism: int | None = None,
    pos_weight: float | None = None,
    early_stopping: bool = False,
):
    """Trials x folds boosted fits of a preset with drawn parameters; returns the
    table (trial, params, fold, auc, rounds) and the parameters with the best mean.
    ``pos_weight`` is one number for all fits (None: the preset's or the draw's)."""
    from stressframe.operators.metrics import roc_auc

    draws = draw_params(space, trials, seed)
    data = _kept(prepared, prepared.count())
    try:
        labelled = labelled_rows(data, label, (fold_col,))

        def run(job):
            t, f = job
            params = boost_params(kind, pos_weight, early_stopping, **draws[t])
            held = labelled.where(F.col(fold_col) == f) if early_stopping else None
            return t, f, fit_boost(labelled.where(F.col(fold_col) != f), label, "s", params, held, bins=bins[f])

        with ThreadPoolExecutor(max_workers=fit_concurrency(data, parallelism)) as pool:
            bins = list(pool.map(lambda f: fit_bins(labelled.where(F.col(fold_col) != f)), range(k)))
            fits = list(pool.map(run, [(t, f) for t in range(trials) for f in range(k)]))
        scored = None
        for f in range(k):  # one pass over a fold's rows for all its models
            part = data.where(F.col(fold_col) == f)
            for t, g, m in fits:
                if g == f:
                    part = m.copy({m.name: f"t{t}"}).transform(part)
            structs = [F.struct(F.lit(t).alias("trial"), prob1(f"t{t}").alias("score")) for t in range(trials)]
            part = part.select(F.lit(f).alias(fold_col), label, F.inline(F.array(*structs)))
            scored = part if scored is None else scored.unionByName(part)
        aucs = roc_auc(scored, label, "score", by=("trial", fold_col))
        spark = prepared.sparkSession
        rows = [(t, json.dumps(draws[t], sort_keys=True), f, m.rounds) for t, f, m in fits]
        known = spark.createDataFrame(rows, f"trial int, params string, {fold_col} int, rounds int")
        from stressframe.session import cut_lineage

        table = cut_lineage(aucs.join(known, ["trial", fold_col]).select("trial", "params", fold_col, "auc", "rounds"))
    finally:
        data.unpersist()
    means = table.groupBy("trial").agg(F.avg("auc").alias("mean_auc")).orderBy(F.col("mean_auc").desc(), "trial").first()
    return table, draws[means["trial"]]


def scaled_frames(train: DataFrame, apply_to: DataFrame, numeric: list[str], label: str, keep: tuple[str, ...]):
    """Imputed + scaled numeric vectors for the linear learner (ENC-5): the
    imputer / scaler is fitted on ``train`` only and applied to both frames."""
    scaler = ImputeScale(inputCols=numeric).fit(train)
    asm = VectorAssembler(inputCols=numeric, outputCol="features", handleInvalid="keep")

    def build(df):
        return asm.transform(scaler.transform(df)).select(*keep, label, "features")

    return build(train), build(apply_to), scaler


class Predictor:
    """Scoring facade (UDF-4, POL-1, POL-2): feature set + frozen caps + stack
    ``PipelineModel``; saved as one folder, applied as chained transforms."""

    def __init__(self, feature_set: str, stack_model: PipelineModel, caps=None):
        self.feature_set = feature_set
        self.stack_model = stack_model
        self.caps = caps

    def features(self, df: DataFrame) -> DataFrame:
        from stressframe.operators.features import add_features

        out = add_features(df, self.feature_set)
        return self.caps.transform(out) if self.caps is not None else out

    def predict(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` columns, per-base probabilities and the stacked ``probability``."""
        return score_stack(self.stack_model, self.features(df), keep)

    def save(self, path: str) -> None:
        self.stack_model.write().overwrite().save(f"{path}/stack")
        if self.caps is not None:
            self.caps.write().overwrite().save(f"{path}/caps")
        from pyspark.sql import SparkSession

        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(self.feature_set, self.caps is not None)], "feature_set string, has_caps boolean") \
            .coalesce(1).write.mode("overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, path: str) -> "Predictor":
        from pyspark.sql import SparkSession

        from stressframe.operators.features import ClipLimitsModel

        spark = SparkSession.getActiveSession()
        meta = spark.read.json(f"{path}/meta").first()
        caps = ClipLimitsModel.load(f"{path}/caps") if meta["has_caps"] else None
        return cls(meta["feature_set"], PipelineModel.load(f"{path}/stack"), caps)
