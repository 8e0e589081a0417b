"""Scoring of tables; the same functions serve streams."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scores import (
    argmax_class,
    confidence,
    decision_label,
    entropy,
    round_score,
)
from riskloom.operators.binning import BinMap
from riskloom.operators.evidence import woe_transform
from riskloom.operators.shaping import entity_lookup, model_input


def with_scores(df: DataFrame, p_accept: Column, p_decline: Column) -> DataFrame:
    """Adds both probabilities, the decision, entropy and confidence."""
    p0, p1 = F.col("prob_accept"), F.col("prob_decline")
    return df.withColumns({"prob_accept": p_accept, "prob_decline": p_decline}).withColumns(
        {
            "result": decision_label(p0, p1),
            "entropy": entropy(p0, p1),
            "confidence": confidence(p0, p1),
        }
    )


def score_features(df: DataFrame, model: PipelineModel, keep: list[str]) -> DataFrame:
    """Scores for a table of transformed features."""
    proba = vector_to_array(F.col("probability"))
    scored = model.transform(df).select(*keep, proba.alias("_p"))
    return with_scores(scored, F.col("_p")[0], F.col("_p")[1]).drop("_p")


def batch_score(df: DataFrame, bins: BinMap, model: PipelineModel, keep: list[str]) -> DataFrame:
    """Raw applications to scores: known columns, evidence, probabilities, decision.

    A chain of narrow steps without a shuffle, so it scores a table or a stream alike.
    """
    known = model_input(df, bins.features, keep)
    return score_features(woe_transform(known, bins, keep), model, keep)


def scorecard_score(
    df: DataFrame, bins: BinMap, weights: dict[str, float], intercept: float, keep: list[str]
) -> DataFrame:
    """A linear scorecard as plain column arithmetic, without vectors."""
    logit = F.lit(float(intercept))
    for f, w in weights.items():
        logit = logit + F.lit(float(w)) * bins.woe_column(f)
    p1 = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_logit")))
    scored = df.select(*keep, logit.alias("_logit"))
    return with_scores(scored, F.lit(1.0) - p1, p1).drop("_logit")


def score_by_id(
    ids: DataFrame, table: DataFrame, bins: BinMap, model: PipelineModel, key: str
) -> DataFrame:
    """Scores of the asked-for rows; an unknown id gives one row that says so in ``error``."""
    wanted = table.join(ids.select(key).distinct(), key, "left_semi")
    return answer_by_id(ids, batch_score(wanted, bins, model, [key]), key)


def answer_by_id(ids: DataFrame, scored: DataFrame, key: str) -> DataFrame:
    """``scored`` rows of the distinct ``ids``, with ``error`` for ids that have none."""
    # requested_id is the same as the key, which is NULL where nothing was found
    return entity_lookup(ids, scored, key, key).drop(key).withColumnRenamed("requested_id", key)


def response_rows(scored: DataFrame, keep: list[str]) -> DataFrame:
    """Rows as the scoring service answers them: entropy and confidence to four decimals."""
    return scored.select(
        *keep,
        "result",
        "prob_accept",
        "prob_decline",
        round_score(F.col("entropy")).alias("entropy"),
        round_score(F.col("confidence")).alias("confidence"),
    )


def predicted_class(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "prediction", argmax_class(F.col("prob_accept"), F.col("prob_decline"))
    )
