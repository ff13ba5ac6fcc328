"""Queries: out-of-fold stacks, fold AUCs, searches, ceiling, importances,
permutation importance, voting ensembles.

Learned numbers have no SQL form. Beside each group of them stands a ``*_check``
query with facts that SQL computes exactly: which rows are scored, in which
fold, how many values lie in 0..1 and whether votes and tiers follow from the
stored scores. Recipes that share fits read one stored result (``stored``).
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import functions as F

from stressframe.operators import models as MD
from stressframe.operators.clean import clean, split_contradictions
from stressframe.operators.encode import OneHot, fill_non_finite
from stressframe.operators.explain import fold_importances, mean_coefficients, permutation_importance
from stressframe.operators.features import CLIP_V2, CORE_FEATURES, V2_MODEL_COLUMNS, ClipLimits, add_features, drop_ids
from stressframe.operators.metrics import (
    CEILING_GOAL_AUC, GOAL_AUC, best_f1_threshold, class_report, confusion, goal_met, predict_label, recall_of, roc_auc,
)
from stressframe.operators.policy import assess, risk_tier
from stressframe.operators.split import stratified_folds, stratified_split
from stressframe.operators.vote import soft_vote
from stressframe.plans.q_features import transform_v1, transform_v2
from stressframe.plans.registry import query, stored
from stressframe.plans.sql_fixtures import with_tables
from stressframe.schemas import ID_COLUMNS, TARGET_V1, TARGET_V2, categorical_columns, numeric_columns
from stressframe.session import cut_lineage, ensure_checkpoint_dir
from stressframe.sources.derive import risk_customer, stress_statement

BASES = {"lgbm": "lgbm", "xgb": "xgb", "cat": "cat"}
KEY1, KEY2 = "customer_id", "statement_id"
W1, W2 = with_tables("risk_customer"), with_tables("stress_statement")


# --- v2 stack ------------------------------------------------------------------

def stack_input(spark, sf_dir, k: int = 5):
    t = MD.materialize(stratified_folds(transform_v2(spark, sf_dir), TARGET_V2, KEY2, k=k, seed=MD.SEED))
    cats = [c for c in V2_MODEL_COLUMNS if c in categorical_columns(t)]
    return MD.prepare(t, TARGET_V2, list(V2_MODEL_COLUMNS), cats, keep=(KEY2, "fold"))


@stored
def v2_stack(spark, sf_dir):
    return MD.stack(stack_input(spark, sf_dir), BASES, TARGET_V2, KEY2, refit=False)


@query("oof_stack")
def q_oof_stack(spark, sf_dir):
    """Level-1 OOF scores of three boosted presets and the level-2 meta OOF (MOD-11, MOD-12)."""
    return v2_stack(spark, sf_dir).oof


_CLEAN_V1 = ("(SELECT * FROM risk_customer WHERE NOT COALESCE(default_next_30_days=1 AND missed_payments_last_6m=0 "
             "AND failed_autodebit_count=0 AND credit_score>700, FALSE)) s")
_CLEAN_V2 = ("(SELECT * FROM stress_statement WHERE NOT COALESCE(default_next_4_weeks=1 AND liquidity_ratio>2.0 "
             "AND unified_stress_index<0.2, FALSE)) s")


def _fold_counts(oof, key, label, probs):
    """Rows per fold and label, distinct keys, and rows with all probabilities in 0..1."""
    good = functools.reduce(lambda a, b: a & b, [F.col(p).between(0.0, 1.0) for p in probs])
    return oof.groupBy("fold", label).agg(
        F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys"), F.count_if(good).alias("n_scored")
    )


def _fold_sql(tables: str, source: str, key: str, label: str, k: int = 5) -> str:
    return (
        f"{tables}, r AS (SELECT {key}, {label}, ROW_NUMBER() OVER (PARTITION BY {label} ORDER BY "
        f"SUBSTR(MD5(CAST({key} AS VARCHAR) || '|42'), 1, 15), {key}) AS k FROM {source}) "
        f"SELECT CAST((k - 1) % {k} AS INT) AS fold, {label}, COUNT(*) AS n_rows, COUNT(DISTINCT {key}) AS n_keys, "
        f"COUNT(*) AS n_scored FROM r GROUP BY 1, 2"
    )


@query("oof_stack_check", _fold_sql(W2, _CLEAN_V2, KEY2, TARGET_V2))
def q_oof_stack_check(spark, sf_dir):
    """Every cleaned statement once, in its fold, with all four probabilities in 0..1 (MOD-11, SPL-2, SPL-3)."""
    return _fold_counts(v2_stack(spark, sf_dir).oof, KEY2, TARGET_V2, [f"prob_{b}" for b in (*BASES, "meta")])


@query("stack_auc")
def q_stack_auc(spark, sf_dir):
    """Exact AUC per (model, fold) and overall for bases and meta (MET-2), with the goal test (MET-9)."""
    return MD.fold_auc_table(v2_stack(spark, sf_dir).oof, TARGET_V2, [*BASES, "meta"])


@query("meta_weights")
def q_meta_weights(spark, sf_dir):
    """Meta-learner coefficient per base model, averaged over folds (EXP-2, AGG-15)."""
    return mean_coefficients(v2_stack(spark, sf_dir).meta_coefficients)


def _stack_labels(spark, sf_dir):
    oof = v2_stack(spark, sf_dir).oof
    return oof.withColumn("predicted", predict_label("prob_meta", 0.5, strict=True))


@query("stack_report")
def q_stack_report(spark, sf_dir):
    """Class report of the stack's own OOF scores, labelled where they exceed 0.5 (MET-5, MET-7)."""
    return class_report(_stack_labels(spark, sf_dir), TARGET_V2, "predicted")


@query("stack_confusion")
def q_stack_confusion(spark, sf_dir):
    """Confusion cells of the stack's own OOF scores at > 0.5 (MET-6)."""
    return confusion(_stack_labels(spark, sf_dir), TARGET_V2, "predicted")


# --- v1 recipes ----------------------------------------------------------------

def _v1_model_input(spark, sf_dir, k: int, cleaned: bool = True, features=None):
    t = transform_v1(spark, sf_dir, cleaned=cleaned)
    if features is not None:
        t = t.select(KEY1, *features, TARGET_V1)
    t = MD.materialize(stratified_folds(t, TARGET_V1, KEY1, k=k, seed=MD.SEED))
    feats = [c for c in t.columns if c not in (TARGET_V1, KEY1, "fold")]
    return MD.prepare(t, TARGET_V1, feats, categorical_columns(t), keep=(KEY1, "fold")), feats


@stored
def v1_stack(spark, sf_dir):
    """Stack on the cleaned v1 table, refit on all rows as one pipeline (MOD-12, MOD-17)."""
    prep, _ = _v1_model_input(spark, sf_dir, 5)
    return MD.stack(prep, BASES, TARGET_V1, KEY1, refit=True)


@query("v1_stack_auc")
def q_v1_stack_auc(spark, sf_dir):
    """v1 stack: AUC per (model, fold) and overall (MOD-11, MOD-12, MET-2)."""
    return MD.fold_auc_table(v1_stack(spark, sf_dir).oof, TARGET_V1, [*BASES, "meta"])


@query("v1_stack_weights")
def q_v1_stack_weights(spark, sf_dir):
    """v1 stack: mean meta coefficient per base model (EXP-2)."""
    return mean_coefficients(v1_stack(spark, sf_dir).meta_coefficients)


@query("v1_stack_scored")
def q_v1_stack_scored(spark, sf_dir):
    """v1 stack applied to rows without a label: features, then base probabilities
    and the stacked probability (POL-1, POL-2, POL-14)."""
    rows = transform_v1(spark, sf_dir, cleaned=False).drop(TARGET_V1)
    return MD.score_stack(v1_stack(spark, sf_dir).model, rows, [KEY1])


@stored
def two_models(spark, sf_dir):
    """LightGBM and XGBoost with their fixed weights, out of fold on cleaned v1."""
    prep, _ = _v1_model_input(spark, sf_dir, 5)
    res = MD.out_of_fold(prep.data, {"lgbm": "lgbm_final", "xgb": "xgb"}, TARGET_V1, KEY1)
    return cut_lineage(soft_vote(res.oof, ["prob_lgbm", "prob_xgb"], out="prob_ensemble"))


@query("oof_two_model_mean")
def q_oof_two_model_mean(spark, sf_dir):
    """LightGBM + XGBoost presets out of fold on cleaned v1 and their mean (MOD-11, MOD-14)."""
    return two_models(spark, sf_dir)


@query("two_model_check", _fold_sql(W1, _CLEAN_V1, KEY1, TARGET_V1))
def q_two_model_check(spark, sf_dir):
    """Every cleaned customer once, in its fold, with both probabilities in 0..1 (MOD-11, SPL-2)."""
    return _fold_counts(two_models(spark, sf_dir), KEY1, TARGET_V1, ["prob_lgbm", "prob_xgb"])


@query("v1_stack_check", _fold_sql(W1, _CLEAN_V1, KEY1, TARGET_V1))
def q_v1_stack_check(spark, sf_dir):
    """Every cleaned customer once, in its fold, with all probabilities of the v1 stack in 0..1 (MOD-12)."""
    return _fold_counts(v1_stack(spark, sf_dir).oof, KEY1, TARGET_V1, [f"prob_{b}" for b in (*BASES, "meta")])


@query("two_model_auc")
def q_two_model_auc(spark, sf_dir):
    """AUC per fold and overall of both models and of their mean, with the goal (MET-2, MET-9)."""
    return MD.fold_auc_table(two_models(spark, sf_dir), TARGET_V1, ["lgbm", "xgb", "ensemble"])


@query(
    "two_model_vote_check",
    f"{W1} SELECT COUNT(*) AS n_rows, COUNT(*) AS n_mean, COUNT(*) AS n_in_range FROM {_CLEAN_V1}",
)
def q_two_model_vote_check(spark, sf_dir):
    """The stored mean equals the mean of the stored scores on every row (MOD-14)."""
    t = two_models(spark, sf_dir)
    same = F.abs(F.col("prob_ensemble") - (F.col("prob_lgbm") + F.col("prob_xgb")) / 2) < 1e-12
    return t.agg(F.count("*").alias("n_rows"), F.count_if(same).alias("n_mean"), F.count_if(F.col("prob_ensemble").between(0, 1)).alias("n_in_range"))


def _oof_single(spark, sf_dir, kind: str, features=None, cleaned: bool = True):
    """OOF scores and fits of one preset on the v1 table with per-fold class ratio."""
    prep, feats = _v1_model_input(spark, sf_dir, 5, cleaned, features)
    return MD.out_of_fold(prep.data, {kind: kind}, TARGET_V1, KEY1, weighting="ratio"), feats


@query("simplified_oof_auc")
def q_simplified_oof_auc(spark, sf_dir):
    """Six selected features on the uncleaned v1 table, per-fold class ratio, five
    folds: OOF AUC and goal (recipe of the simplified model: PRJ-3, MOD-2, MOD-9,
    MOD-11, MET-1, MET-9)."""
    res, _ = _oof_single(spark, sf_dir, "lgbm_simple", features=list(CORE_FEATURES), cleaned=False)
    return roc_auc(res.oof, TARGET_V1, "prob_lgbm_simple")


@stored
def optimized(spark, sf_dir):
    res, feats = _oof_single(spark, sf_dir, "lgbm_optimized")
    rows = [(f.fold, n, float(v)) for f in res.fits for n, v in zip(feats, f.model.featureImportances.toArray())]
    return cut_lineage(res.oof), rows


@query("importances")
def q_importances(spark, sf_dir):
    """Gain importance of the optimized recipe averaged over five fold fits, top 10 (EXP-1, AGG-16, SRT-2)."""
    return fold_importances(optimized(spark, sf_dir)[1], spark, 5).limit(10)


@query("optimized_oof_report")
def q_optimized_oof_report(spark, sf_dir):
    """Optimized recipe, cleaned v1, per-fold class ratio: OOF predictions labelled at
    the best-F1 threshold, class report rows plus the OOF AUC and threshold on every
    row (MOD-11, MET-1,3..7)."""
    oof = optimized(spark, sf_dir)[0]
    score = "prob_lgbm_optimized"
    auc = roc_auc(oof, TARGET_V1, score).first()["auc"]
    best = best_f1_threshold(oof, TARGET_V1, score).first()
    labelled = oof.withColumn("predicted", predict_label(score, float(best["threshold"])))
    return class_report(labelled, TARGET_V1, "predicted").select(
        "*", F.lit(auc).alias("oof_auc"), F.lit(float(best["threshold"])).alias("threshold")
    )


@query("catboost_oof_auc")
def q_catboost_oof_auc(spark, sf_dir):
    """CatBoost recipe (2,000 rounds, patience 100), cleaned v1, per-fold class ratio,
    early stopping on the scored fold: OOF AUC, the 0.70 goal, and whether a model
    was saved for it (MOD-3, MOD-10, SNK-5: the last fold's model, as the recipe does)."""
    from stressframe.sources.sinks import save_if_goal

    res, _ = _oof_single(spark, sf_dir, "cat_alone")
    auc = roc_auc(res.oof, TARGET_V1, "prob_cat_alone")
    path = f"{ensure_checkpoint_dir(spark)}/models-{uuid.uuid4().hex}/cat"
    saved = save_if_goal(res.fits[-1].model, path, auc.first()["auc"], GOAL_AUC)
    return auc.withColumn("saved", F.lit(saved))


@query("ceiling_auc")
def q_ceiling_auc(spark, sf_dir):
    """Refit on the contradiction-free rows only; AUC per fold, the fold mean
    and the 0.75 ceiling goal (FLT-3, MOD-18, AGG-14, MET-9)."""
    _, clean_rows = split_contradictions(risk_customer(spark, sf_dir), TARGET_V1)
    t = MD.materialize(stratified_folds(clean_rows, TARGET_V1, KEY1, k=5, seed=MD.SEED))
    feats = [c for c in clean_rows.columns if c not in (TARGET_V1,)]
    prep = MD.prepare(t, TARGET_V1, feats, categorical_columns(clean_rows), keep=(KEY1, "fold"))
    res = MD.out_of_fold(prep.data, {"ceiling": "ceiling"}, TARGET_V1, KEY1, early_stopping=False)
    per_fold = roc_auc(res.oof, TARGET_V1, "prob_ceiling", by=("fold",), goal=CEILING_GOAL_AUC)
    mean = per_fold.agg(F.avg("auc").alias("auc")).select(
        F.lit(None).cast("int").alias("fold"), "auc", goal_met(F.col("auc"), CEILING_GOAL_AUC).alias("goal_met")
    )
    return per_fold.select("fold", "auc", "goal_met").unionByName(mean)


# --- searches ------------------------------------------------------------------

# The discrete lists of the randomized search (MOD-15).
SEARCH_SPACE = {
    "rounds": [100, 200, 300, 500],
    "depth": [3, 4, 5, 6, 8, 10],
    "rate": [0.01, 0.05, 0.1, 0.2],
    "row_rate": [0.6, 0.7, 0.8, 0.9, 1.0],
    "col_rate": [0.6, 0.7, 0.8, 0.9, 1.0],
    "gain": [0.0, 0.1, 0.2, 0.5],
}
# The ranges of the 30-trial study (MOD-16).
TUNE_SPACE = {
    "rounds": ("int", 500, 2000),
    "rate": ("log", 0.005, 0.1),
    "leaves": ("int", 20, 150),
    "depth": ("int", 3, 12),
    "min_rows": ("int", 10, 100),
    "row_rate": ("float", 0.6, 1.0),
    "col_rate": ("float", 0.6, 1.0),
    "l1": ("log", 1e-8, 10.0),
    "l2": ("log", 1e-8, 10.0),
    "pos_weight": ("float", 1.0, 10.0),
}


def _vote_split(spark, sf_dir):
    """Raw v1 table, one-hot (drop first), 80/20 stratified split: (encoder, rows, features)."""
    raw = cut_lineage(risk_customer(spark, sf_dir))  # derived once for encoder, split and rows
    onehot = OneHot(inputCols=["employment_type"]).fit(raw)
    encoded = onehot.transform(raw)
    rows = MD.materialize(stratified_split(encoded, TARGET_V1, KEY1, 0.2, MD.SEED))
    return onehot, rows, [c for c in numeric_columns(encoded) if c not in (TARGET_V1, KEY1)]


@stored
def searched(spark, sf_dir):
    """Twenty draws x three folds on the raw one-hot training rows, one class weight."""
    _, rows, feats = _vote_split(spark, sf_dir)
    train = rows.where("is_test = 0").drop("is_test")
    weight = MD.class_weights(train, TARGET_V1, "ratio")[1]
    train = MD.materialize(stratified_folds(train, TARGET_V1, KEY1, k=3, seed=MD.SEED))
    prep = MD.prepare(train, TARGET_V1, feats, [], keep=(KEY1, "fold"))
    return MD.random_search(prep.data, "xgb_default", SEARCH_SPACE, TARGET_V1, k=3, trials=20, pos_weight=weight)


@query("random_search")
def q_random_search(spark, sf_dir):
    """Randomized search table: trial, parameters, fold, exact AUC, rounds (MOD-15)."""
    return searched(spark, sf_dir)[0]


@query("range_study")
def q_range_study(spark, sf_dir):
    """Thirty trials over ranges x five folds with patience 50 on cleaned, featured v1
    (MOD-16; random draws in place of a model-based sampler)."""
    prep, _ = _v1_model_input(spark, sf_dir, 5)
    return MD.random_search(prep.data, "lgbm_default", TUNE_SPACE, TARGET_V1, k=5, trials=30, early_stopping=True)[0]


@query(
    "random_search_check",
    "SELECT CAST(t AS INT) AS trial, CAST(3 AS BIGINT) AS n_folds, CAST(3 AS BIGINT) AS n_auc FROM range(20) r(t), "
    "(SELECT COUNT(*) AS n FROM customer) c WHERE c.n > 0",
)
def q_random_search_check(spark, sf_dir):
    """Every trial has three folds with an AUC in 0..1 and its drawn number of rounds."""
    t = searched(spark, sf_dir)[0]
    drawn = F.get_json_object("params", "$.rounds").cast("int") == F.col("rounds")
    return t.groupBy("trial").agg(F.count_distinct("fold").alias("n_folds"), F.count_if(F.col("auc").between(0, 1) & drawn).alias("n_auc"))


# --- equal vote: searched XGBoost + forest --------------------------------------

@stored
def vote_models(spark, sf_dir):
    """The searched XGBoost and a default forest on the training rows, as one
    pipeline that scores raw customer rows (pv_xgb, pv_rf)."""
    from pyspark.ml import PipelineModel

    from stressframe.operators.boost import fit_boost

    _, best = searched(spark, sf_dir)
    onehot, rows, feats = _vote_split(spark, sf_dir)
    prep = MD.prepare(rows, TARGET_V1, feats, [], keep=(KEY1, "is_test"))
    train = prep.data.where("is_test = 0")
    weight = MD.class_weights(train, TARGET_V1, "ratio")[1]
    xgb = fit_boost(train, TARGET_V1, "xgb", MD.boost_params("xgb_default", weight, False, **best))
    rf = MD.fit_one(train, "rf_default", "rf", TARGET_V1)
    return PipelineModel(stages=[onehot, *prep.prep_model.stages, xgb, rf]), feats


def _vote_holdout(spark, sf_dir, model):
    # the split is a pure function of (key, seed): re-creating it gives the same hold-out rows
    again = stratified_split(risk_customer(spark, sf_dir), TARGET_V1, KEY1, 0.2, MD.SEED).where("is_test = 1")
    scored = model.transform(again).select(KEY1, TARGET_V1, MD.prob1("xgb").alias("prob_xgb"), MD.prob1("rf").alias("prob_rf"))
    return cut_lineage(soft_vote(scored, ["prob_xgb", "prob_rf"]))


@stored
def vote_holdout(spark, sf_dir):
    return _vote_holdout(spark, sf_dir, vote_models(spark, sf_dir)[0])


def _summary(spark, voted, score="probability"):
    auc = roc_auc(voted, TARGET_V1, score).first()
    best = best_f1_threshold(voted, TARGET_V1, score).first()
    pred = voted.withColumn("predicted", predict_label(score, float(best["threshold"])))
    rec = recall_of(pred, TARGET_V1, "predicted").first()
    return spark.createDataFrame(
        [(auc["auc"], auc["positives"], auc["negatives"], best["threshold"], best["f1"], rec["recall"])],
        "auc double, positives long, negatives long, threshold double, f1 double, recall double",
    ), pred


@query("vote_summary")
def q_vote_summary(spark, sf_dir):
    """Equal vote on the hold-out rows: AUC, best-F1 threshold, recall (MOD-13, MET-1, MET-4, MET-8)."""
    return _summary(spark, vote_holdout(spark, sf_dir))[0]


@query("vote_report")
def q_vote_report(spark, sf_dir):
    """Class report of the equal vote at its best-F1 threshold (MET-7)."""
    return class_report(_summary(spark, vote_holdout(spark, sf_dir))[1], TARGET_V1, "predicted")


@query("vote_confusion")
def q_vote_confusion(spark, sf_dir):
    """Confusion cells of the equal vote at its best-F1 threshold (MET-6)."""
    return confusion(_summary(spark, vote_holdout(spark, sf_dir))[1], TARGET_V1, "predicted")


@query("vote_top_features")
def q_vote_top_features(spark, sf_dir):
    """Top 15 features of the searched XGBoost by gain share (EXP-1, SRT-3)."""
    model, feats = vote_models(spark, sf_dir)
    gains = model.stages[-2].featureImportances.toArray()
    total = float(gains.sum()) or 1.0
    rows = sorted(((n, float(g) / total) for n, g in zip(feats, gains)), key=lambda r: (-r[1], r[0]))[:15]
    return spark.createDataFrame(rows, "feature string, importance double")


@query("scored_customers")
def q_scored_customers(spark, sf_dir):
    """Every customer scored by the equal vote: original columns + risk_probability +
    risk_category (SNK-2 table, POL-1, POL-3)."""
    raw = risk_customer(spark, sf_dir)
    # the encoder consumes employment_type (as get_dummies does): carry a copy through
    scored = vote_models(spark, sf_dir)[0].transform(raw.withColumn("_segment", F.col("employment_type")))
    prob = ((MD.prob1("xgb") + MD.prob1("rf")) / 2).alias("risk_probability")
    cols = [F.col("_segment").alias(c) if c == "employment_type" else F.col(c) for c in raw.columns]
    return scored.select(*cols, prob).withColumn("risk_category", risk_tier("risk_probability"))


@query(
    "scored_customers_check",
    f"{W1} SELECT *, TRUE AS in_range, TRUE AS tier_follows FROM risk_customer",
)
def q_scored_customers_check(spark, sf_dir):
    """Original columns untouched, probability in 0..1, category equal to the tier rule written out here (POL-3)."""
    t = q_scored_customers(spark, sf_dir)
    p = F.col("risk_probability")
    tier = F.when(p < 0.3, "Low").when(p < 0.6, "Medium").when(p < 0.8, "High").otherwise("Critical")
    return t.select("*", p.between(0, 1).alias("in_range"), (F.col("risk_category") == tier).alias("tier_follows")).drop(
        "risk_probability", "risk_category"
    )


@query("rescore_saved_model")
def q_rescore_saved_model(spark, sf_dir):
    """Save the vote pipeline (encoder included), load it back, re-create the split
    and score the hold-out rows (SPL-1, ENC-1, MOD-13, SNK-4, SRC-6, POL-1, MET-1,4,5,8)."""
    from stressframe.sources.files import load_model
    from stressframe.sources.sinks import save_model

    path = f"{ensure_checkpoint_dir(spark)}/models-{uuid.uuid4().hex}/vote"
    save_model(vote_models(spark, sf_dir)[0], path)
    return _summary(spark, _vote_holdout(spark, sf_dir, load_model(path)))[0]


@query("rescore_check", "SELECT COUNT(*) > 0 AS same_rows, TRUE AS same_scores FROM customer")
def q_rescore_check(spark, sf_dir):
    """A saved and loaded vote gives the same probability on every hold-out row."""
    from stressframe.sources.files import load_model
    from stressframe.sources.sinks import save_model

    path = f"{ensure_checkpoint_dir(spark)}/models-{uuid.uuid4().hex}/vote"
    save_model(vote_models(spark, sf_dir)[0], path)
    a = vote_holdout(spark, sf_dir).select(KEY1, "probability")
    b = _vote_holdout(spark, sf_dir, load_model(path)).select(KEY1, F.col("probability").alias("again"))
    both = a.join(b, KEY1, "full")
    return both.agg(
        (F.count_if(F.col("probability").isNull() | F.col("again").isNull()) == 0).alias("same_rows"),
        F.coalesce(F.max(F.abs(F.col("probability") - F.col("again"))) < 1e-12, F.lit(False)).alias("same_scores"),
    )


# --- five-model vote ------------------------------------------------------------

# Soft-vote weights of the five-model ensemble (MOD-13).
VOTE_MODELS = {"xgb": 3, "gb": 2, "rf": 2, "et": 1, "lr": 1}


@stored
def five_models(spark, sf_dir):
    """Base features, one-hot, non-finite fill, stratified 80/20 split, five learners,
    weighted soft vote on the hold-out rows; and the forest's importances."""
    df = cut_lineage(add_features(risk_customer(spark, sf_dir), "base"))  # derived once
    df = OneHot(inputCols=["employment_type"]).fit(df).transform(df)
    df = fill_non_finite(df, 0.0)
    split = MD.materialize(stratified_split(df, TARGET_V1, KEY1, 0.2, MD.SEED))
    feats = [c for c in numeric_columns(df) if c not in (TARGET_V1, KEY1)]
    train, test = (MD.prepare(split.where(f"is_test = {k}"), TARGET_V1, feats, [], keep=(KEY1, *feats)).data for k in (0, 1))
    scored = test
    for name, kind in (("xgb", "xgb_vote"), ("gb", "gb"), ("rf", "rf"), ("et", "et")):
        model = MD.fit_one(train, kind, name, TARGET_V1, "ratio" if name == "xgb" else None)
        scored = model.transform(scored).withColumn(f"prob_{name}", MD.prob1(name))
        if name == "rf":
            gains = [(n, float(v)) for n, v in zip(feats, model.featureImportances.toArray())]
    scaled, _, scaler = MD.scaled_frames(split.where("is_test = 0"), split.where("is_test = 1"), feats, TARGET_V1, (KEY1,))
    lr = MD.fit_one(scaled, "lr", "lr", TARGET_V1)
    # the linear model scores the same rows, scaled in place: no join
    linear = scored.select(KEY1, TARGET_V1, *feats, *[f"prob_{n}" for n in ("xgb", "gb", "rf", "et")])
    linear = MD.VectorAssembler(inputCols=feats, outputCol="features").transform(scaler.transform(linear))
    scored = lr.transform(linear).withColumn("prob_lr", MD.prob1("lr"))
    voted = soft_vote(scored, [f"prob_{n}" for n in VOTE_MODELS], list(VOTE_MODELS.values()))
    return cut_lineage(voted.select(KEY1, TARGET_V1, *[f"prob_{n}" for n in VOTE_MODELS], "probability")), gains


@query("vote_ensemble")
def q_vote_ensemble(spark, sf_dir):
    """Hold-out AUC, best-F1 threshold and recall of the five-model vote (MOD-1,4..7,9,13; MET-1,3..5,8)."""
    return _summary(spark, five_models(spark, sf_dir)[0])[0]


@query("vote_ensemble_report")
def q_vote_ensemble_report(spark, sf_dir):
    """Class report of the five-model vote at its best-F1 threshold (MET-7)."""
    return class_report(_summary(spark, five_models(spark, sf_dir)[0])[1], TARGET_V1, "predicted")


@query("vote_ensemble_confusion")
def q_vote_ensemble_confusion(spark, sf_dir):
    """Confusion cells of the five-model vote at its best-F1 threshold (MET-6)."""
    return confusion(_summary(spark, five_models(spark, sf_dir)[0])[1], TARGET_V1, "predicted")


@query("vote_ensemble_top_features")
def q_vote_ensemble_top_features(spark, sf_dir):
    """Top 15 features of the five-model vote's forest (EXP-1, SRT-3)."""
    rows = sorted(five_models(spark, sf_dir)[1], key=lambda r: (-r[1], r[0]))[:15]
    return spark.createDataFrame(rows, "feature string, importance double")


@query(
    "vote_ensemble_check",
    f"{W1}, r AS (SELECT customer_id, default_next_30_days, ROW_NUMBER() OVER (PARTITION BY default_next_30_days ORDER BY "
    "SUBSTR(MD5(CAST(customer_id AS VARCHAR) || '|42'), 1, 15), customer_id) AS k, COUNT(*) OVER (PARTITION BY default_next_30_days) AS n "
    "FROM risk_customer) SELECT customer_id, default_next_30_days, TRUE AS vote_follows FROM r WHERE k <= FLOOR(0.2e0*n + 0.5e0)",
)
def q_vote_ensemble_check(spark, sf_dir):
    """Exactly the hold-out rows are scored and the vote is (3 xgb + 2 gb + 2 rf + et + lr) / 9 (MOD-13, SPL-1)."""
    t = five_models(spark, sf_dir)[0]
    c = F.col
    vote = (3 * c("prob_xgb") + 2 * c("prob_gb") + 2 * c("prob_rf") + c("prob_et") + c("prob_lr")) / 9
    return t.select(KEY1, TARGET_V1, (F.abs(c("probability") - vote) < 1e-12).alias("vote_follows"))


# --- explanation and decisions --------------------------------------------------

@query("permutation_importance")
def q_permutation_importance(spark, sf_dir):
    """AUC drop when each model feature is permuted, XGBoost preset with all its rounds on v2 (EXP-3)."""
    t = MD.materialize(transform_v2(spark, sf_dir))
    cats = [c for c in V2_MODEL_COLUMNS if c in categorical_columns(t)]
    prep = MD.prepare(t, TARGET_V2, list(V2_MODEL_COLUMNS), cats, keep=(KEY2,))
    model = MD.fit_boost(prep.data, TARGET_V2, "xgb", MD.boost_params("xgb", early_stop=False))

    def score(df):
        return model.transform(prep.prep_model.transform(df)).withColumn("probability", MD.prob1("xgb"))

    def score_swapped(pairs):
        own = prep.prep_model.transform(pairs).select(TARGET_V2, F.col("features").alias("_own"), *[F.col(f"_p_{c}").alias(c) for c in V2_MODEL_COLUMNS])
        return model.swapped(prep.prep_model.transform(own).select(TARGET_V2, "_own", "features"), "_own", "features", "swapped")

    return permutation_importance(t, score, list(V2_MODEL_COLUMNS), TARGET_V2, KEY2, score_swapped=score_swapped)


@stored
def v2_predictor(spark, sf_dir):
    """clean -> features -> caps -> stack refit on all rows, as one Predictor."""
    raw = MD.materialize(drop_ids(clean(stress_statement(spark, sf_dir), TARGET_V2), ID_COLUMNS))
    caps = ClipLimits(inputCols=list(CLIP_V2)).fit(add_features(raw, "v2"))
    t = MD.materialize(stratified_folds(caps.transform(add_features(raw, "v2")), TARGET_V2, KEY2, k=5, seed=MD.SEED))
    cats = [c for c in V2_MODEL_COLUMNS if c in categorical_columns(t)]
    prep = MD.prepare(t, TARGET_V2, list(V2_MODEL_COLUMNS), cats, keep=(KEY2, "fold"))
    return raw, MD.Predictor("v2", MD.stack(prep, BASES, TARGET_V2, KEY2, refit=True).model, caps)


@query(
    "stack_scored_check",
    f"{W2} SELECT statement_id, default_next_4_weeks, TRUE AS in_range FROM {_CLEAN_V2}",
)
def q_stack_scored_check(spark, sf_dir):
    """Every cleaned statement is scored once with all probabilities in 0..1 (POL-1, POL-14)."""
    t = q_stack_scored(spark, sf_dir)
    good = functools.reduce(lambda a, b: a & b, [F.col(c).between(0, 1) for c in (*(f"prob_{b}" for b in BASES), "probability", "final_probability")])
    return t.select(KEY2, TARGET_V2, good.alias("in_range"))


@query("stack_scored_statements")
def q_stack_scored(spark, sf_dir):
    """Every statement scored by the refit stack: base probabilities, calibrated
    probability, tier, verdict (MOD-12, MOD-17, POL-1..14); features stay on
    their rows, no join."""
    raw, predictor = v2_predictor(spark, sf_dir)
    keep = [KEY2, TARGET_V2, "liquidity_ratio", "savings_balance", "total_spend", "monthly_income", "unified_stress_index",
            "gambling_ratio", "delayed_liquidity_crunch", "failed_autodebit_count", "credit_utilization_ratio"]
    decided = assess(predictor.predict(raw, keep), "probability")
    return decided.select(KEY2, TARGET_V2, *[f"prob_{b}" for b in BASES], "probability", "final_probability", "risk_tier", "status", "verdict")
