"""The whole batch flow: bins, gate, evidence, selection, training, evaluation, run log."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.binning import BinMap, fit_bins
from riskloom.operators.evaluation import accuracy, classification_report, roc_auc, roc_auc_trapezoid
from riskloom.operators.evidence import (
    MAX_IV,
    MAX_MISSING_RATE,
    MIN_IV,
    anova_f,
    contribution_summary,
    select_k_best,
    woe_transform,
)
from riskloom.operators.importance import permutation_importance
from riskloom.operators.profile import table_profile
from riskloom.operators.shaping import KEY, LABEL, feature_lists
from riskloom.plans.scoring import predicted_class, score_features
from riskloom.plans.store import register_scorer
from riskloom.plans.training import (
    N_ESTIMATORS,
    TRIALS,
    TreeParams,
    best_trial,
    hyper_search,
    params_dict,
    scorecard_weights,
    train_boosted_trees,
    train_scorecard,
)
from riskloom.session import settle
from riskloom.sources.writers import append_run, run_name, write_versioned


@dataclass
class Preparation:
    """What preprocessing leaves behind; the tables are transformed as they are read."""

    bins: BinMap
    selected: list[str]
    train: DataFrame
    test: DataFrame | None


@dataclass
class FlowResult:
    run_name: str
    version: int
    preparation: Preparation
    model: PipelineModel
    metrics: dict[str, float | None]
    report: DataFrame


def prepare(
    train: DataFrame,
    test: DataFrame | None,
    key: str | list[str] = KEY,
    label: str = LABEL,
    k: int | str = "auto",
    iv_band: tuple[float, float] = (MIN_IV, MAX_IV),
    max_missing: float = MAX_MISSING_RATE,
    prebins: int = 20,
    method: str = "exact",
) -> Preparation:
    """Bin every feature, keep those in the band, transform, and keep the k best.

    Bins are fitted once; the table the gate looked at and the transformed
    table come from the same map.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cat, num = feature_lists(train, keys, label)
    bins = fit_bins(train, label, cat, num, bins=prebins, method=method)

    # Counted while binning, so the gate costs no further pass.
    rows = F.col("good") + F.col("bad")
    absent = F.sum(F.when(F.col("kind") == "missing", rows).otherwise(0))
    gate = (
        bins.to_table(train.sparkSession)
        .groupBy("feature")
        .agg(F.sum("iv").alias("iv"), F.try_divide(absent, F.sum(rows)).alias("missing_rate"))
        .where(F.col("iv").between(*iv_band) & (F.col("missing_rate") <= max_missing))
        .select("feature")
        .collect()
    )
    passed = {r["feature"] for r in gate}
    survivors = [f for f in bins.features if f in passed]

    selected = survivors
    if survivors and k != "auto":
        scores = anova_f(woe_transform(train, bins.only(survivors), [label]), label, survivors)
        selected = [r["feature"] for r in select_k_best(scores, survivors, k).collect()]
    bins = bins.only(selected)
    out_train = woe_transform(train, bins, [*keys, label])
    out_test = None if test is None else woe_transform(test, bins, keys)
    return Preparation(bins, selected, out_train, out_test)


def evaluate(
    model: PipelineModel, features: DataFrame, keys: list[str], label: str
) -> tuple[dict[str, float | None], DataFrame]:
    """Accuracy, both areas and the class report, on the rows the model saw."""
    scored = settle(
        predicted_class(score_features(features, model, [*keys, label])).select(
            label, "prediction", "prob_decline"
        ),
        "evaluated",
    )
    metrics = {
        "accuracy": accuracy(scored, label, "prediction").first()[0],
        "roc_auc": roc_auc(scored, label, "prob_decline").first()[0],
        "roc_auc_trapezoid": roc_auc_trapezoid(scored, label, "prob_decline").first()[0],
    }
    return metrics, classification_report(scored, label, "prediction")


def underwriting_flow(
    train: DataFrame,
    test: DataFrame | None,
    dest: str,
    key: str | list[str] = KEY,
    label: str = LABEL,
    model_name: str = "xgb",
    version: str = "v1",
    data_version: str = "v1",
    k: int | str = "auto",
    iv_band: tuple[float, float] = (MIN_IV, MAX_IV),
    trials: int = TRIALS,
    trees: tuple[int, int] = N_ESTIMATORS,
    depth: tuple[int, int] = (2, 8),
) -> FlowResult:
    """Run every step, write the processed tables, the scorer and the run under ``dest``.

    ``model_name`` is ``xgb`` or ``lgbm`` for tuned boosted trees, or
    ``scorecard`` for logistic regression.
    """
    keys = [key] if isinstance(key, str) else list(key)
    spark = train.sparkSession
    prepared = prepare(train, test, keys, label, k, iv_band)
    if not prepared.selected:
        raise ValueError("no feature passed the gate")
    written = write_versioned(prepared.train, os.path.join(dest, "train.parquet"), data_version)
    # Trials, training and evaluation read the written table, not the raw one again.
    prepared.train = spark.read.schema(prepared.train.schema).parquet(written)
    if prepared.test is not None:
        write_versioned(prepared.test, os.path.join(dest, "test.parquet"), data_version)

    if model_name == "scorecard":
        params: dict[str, object] = {}
        model = train_scorecard(prepared.train, label, prepared.selected)
    else:
        tuned: TreeParams = best_trial(
            hyper_search(
                prepared.train, keys, label, prepared.selected, trials, trees, depth, model_name
            )
        ).params
        params = params_dict(tuned)
        model = train_boosted_trees(prepared.train, label, prepared.selected, tuned, model_name)
    metrics, report = evaluate(model, prepared.train, keys, label)

    name = run_name(version, model_name)
    number = register_scorer(spark, prepared.bins, model, dest, name)
    # what a run leaves beside its scorer: class report, contributions and the columns it saw
    left = os.path.join(dest, "outputs", name, str(number))
    report.write.parquet(os.path.join(left, "report"))
    contributions(model, prepared.train, keys, label).write.parquet(os.path.join(left, "contributions"))
    table_profile(train).write.parquet(os.path.join(left, "profile"))
    append_run(spark, os.path.join(dest, "runs"), version, model_name, params, metrics)
    return FlowResult(name, number, prepared, model, metrics, report)


def contributions(model: PipelineModel, features: DataFrame, keys: list[str], label: str) -> DataFrame:
    """(feature, mean_abs_contribution): of a scorecard its effects, of trees the accuracy that is
    lost when a feature's values are exchanged."""
    if isinstance(model.stages[-1], LogisticRegressionModel):
        return contribution_summary(features, scorecard_weights(model)[0])
    names = model.stages[0].getInputCols()
    found = permutation_importance(features, keys, label, names, model.transform)
    return found.select("feature", F.col("importance").alias("mean_abs_contribution"))
