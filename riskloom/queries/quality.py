"""Score columns and model quality, on the event log read as a score log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import bindings as B
from riskloom.functions import scores as S
from riskloom.functions.scores import rounded
from riskloom.operators import evaluation
from riskloom.operators.gauges import batch_quality_means as quality_means
from riskloom.queries import query

SCORED_SQL = """
raw AS (SELECT event_id, ts, event_type AS job, (event_type = 'error')::INT AS y,
               1 / (1 + exp(-(value - 50.0) / 25.0)) AS p1 FROM events),
scored AS (SELECT *, 1 - p1 AS p0, (p1 > 1 - p1)::INT AS pred,
                  -((1 - p1) * log2((1 - p1) + 1e-10) + p1 * log2(p1 + 1e-10)) AS entropy,
                  greatest(1 - p1, p1) AS confidence FROM raw)"""


@query(
    "decision_label",
    f"""WITH {SCORED_SQL} SELECT event_id, CASE WHEN p1 > p0 THEN 'Decline' ELSE 'Accept' END AS result
        FROM scored""",
)
def decision_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = B.scores(spark, sf_dir)
    return rows.select("event_id", S.decision_label(F.col("p0"), F.col("p1")).alias("result"))


@query(
    "prediction_entropy",
    f"WITH {SCORED_SQL} SELECT event_id, round(entropy, 6) + 0.0 AS entropy FROM scored",
)
def prediction_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = S.entropy(F.col("p0"), F.col("p1"))
    return B.scores(spark, sf_dir).select("event_id", rounded(value).alias("entropy"))


@query(
    "prediction_confidence",
    f"WITH {SCORED_SQL} SELECT event_id, round(confidence, 6) AS confidence FROM scored",
)
def prediction_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = S.confidence(F.col("p0"), F.col("p1"))
    return B.scores(spark, sf_dir).select("event_id", rounded(value).alias("confidence"))


@query("argmax_class", f"WITH {SCORED_SQL} SELECT event_id, pred FROM scored")
def argmax_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = S.argmax_class(F.col("p0"), F.col("p1"))
    return B.scores(spark, sf_dir).select("event_id", value.alias("pred"))


@query(
    "round_scores",
    f"""WITH {SCORED_SQL} SELECT event_id, round(entropy, 4) + 0.0 AS entropy,
        round(confidence, 4) + 0.0 AS confidence FROM scored""",
)
def round_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.scores(spark, sf_dir).select(
        "event_id",
        (S.round_score(F.col("entropy")) + 0.0).alias("entropy"),
        (S.round_score(F.col("confidence")) + 0.0).alias("confidence"),
    )


@query(
    "band_label",
    f"""WITH {SCORED_SQL}
        SELECT event_id, 'api_prediction_entropy' AS metric,
               CASE WHEN entropy >= 0.8 THEN 'red' WHEN entropy >= 0.5 THEN 'yellow' ELSE 'green' END AS band
        FROM scored
        UNION ALL
        SELECT event_id, 'api_avg_confidence',
               CASE WHEN confidence >= 0.9 THEN 'green' WHEN confidence >= 0.7 THEN 'yellow' ELSE 'red' END
        FROM scored""",
)
def band_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    band = S.band_label(F.col("metric"), F.col("value"))
    return B.samples(spark, sf_dir).select("event_id", "metric", band.alias("band"))


@query(
    "batch_quality_means",
    f"""WITH {SCORED_SQL} SELECT round(avg(entropy), 6) AS avg_entropy,
        round(avg(confidence), 6) AS avg_confidence FROM scored""",
)
def batch_quality_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = quality_means(B.scores(spark, sf_dir))
    return means.select(*[rounded(F.col(c)).alias(c) for c in means.columns])


@query(
    "accuracy",
    f"WITH {SCORED_SQL} SELECT round(avg((pred = y)::INT), 6) AS accuracy FROM scored",
)
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.accuracy(B.scores(spark, sf_dir), "y", "pred")
    return found.select(rounded(F.col("accuracy")).alias("accuracy"))


@query(
    "confusion_matrix",
    f"WITH {SCORED_SQL} SELECT y AS label, pred AS prediction, count(*) AS n FROM scored GROUP BY y, pred",
)
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion_matrix(B.scores(spark, sf_dir), "y", "pred")


@query(
    "classification_report",
    f"""WITH {SCORED_SQL},
        classes(c) AS (VALUES (0), (1)),
        counts AS (SELECT c, count(*) FILTER (y = c AND pred = c) AS tp, count(*) FILTER (pred = c) AS np,
                          count(*) FILTER (y = c) AS support, count(*) AS total,
                          count(*) FILTER (y = pred) AS right_ones
                   FROM scored, classes GROUP BY c),
        lines AS (SELECT c, coalesce(tp / nullif(np, 0), 0) AS p, coalesce(tp / nullif(support, 0), 0) AS r,
                         coalesce(2 * tp / nullif(np + support, 0), 0) AS f, support, total, right_ones
                  FROM counts)
        SELECT c::VARCHAR AS "row", round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support
        FROM lines
        UNION ALL SELECT 'accuracy', NULL, NULL, round(max(right_ones) / max(total), 6), max(total) FROM lines
        UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), max(total) FROM lines
        UNION ALL SELECT 'weighted avg', round(sum(p * support) / max(total), 6),
          round(sum(r * support) / max(total), 6), round(sum(f * support) / max(total), 6), max(total) FROM lines""",
)
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = evaluation.classification_report(B.scores(spark, sf_dir), "y", "pred")
    return report.withColumns({c: rounded(F.col(c)) for c in ("precision", "recall", "f1")})


_CURVE_SQL = """
steps AS (SELECT p1 AS s, sum(y) AS pos, count(*) - sum(y) AS neg FROM scored GROUP BY p1),
curve AS (SELECT s, pos, neg, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn FROM steps
          WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING)),
totals AS (SELECT sum(pos) AS p, sum(neg) AS n FROM steps)"""


@query(
    "roc_curve",
    f"""WITH {SCORED_SQL}, {_CURVE_SQL}
        SELECT round(s, 6) + 0.0 AS threshold, round(cn / n, 6) AS fpr, round(cp / p, 6) AS tpr
        FROM curve, totals""",
)
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = evaluation.roc_curve(B.scores(spark, sf_dir), "y", "p1")
    return curve.select(*[rounded(F.col(c)).alias(c) for c in ("threshold", "fpr", "tpr")])


@query(
    "roc_auc",
    f"""WITH {SCORED_SQL}, ranked AS (
          SELECT y, rank() OVER (ORDER BY p1) + (count(*) OVER (PARTITION BY p1) - 1) / 2 AS r FROM scored)
        SELECT round((sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))), 6)
               AS roc_auc FROM ranked""",
)
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.roc_auc(B.scores(spark, sf_dir), "y", "p1")
    return found.select(rounded(F.col("roc_auc")).alias("roc_auc"))


@query(
    "roc_auc_trapezoid",
    f"""WITH {SCORED_SQL}, {_CURVE_SQL},
        points AS (SELECT cn / n AS fpr, cp / p AS tpr, coalesce(lag(cn / n) OVER w, 0) AS f0,
                          coalesce(lag(cp / p) OVER w, 0) AS t0
                   FROM curve, totals WINDOW w AS (ORDER BY s DESC))
        SELECT round(sum((fpr - f0) * (tpr + t0) / 2), 6) AS roc_auc_trapezoid FROM points""",
)
def roc_auc_trapezoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.roc_auc_trapezoid(B.scores(spark, sf_dir), "y", "p1")
    return found.select(rounded(F.col("roc_auc_trapezoid")).alias("roc_auc_trapezoid"))
