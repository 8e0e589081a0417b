"""Training, scoring and the whole flow, on documents labelled by quality."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import bindings as B
from riskloom.functions.scores import rounded
from riskloom.operators.binning import BinMap, fit_bins
from riskloom.operators.evidence import woe_joined, woe_transform
from riskloom.plans import scoring, store, training
from riskloom.plans.flow import underwriting_flow as run_flow
from riskloom.queries import query
from riskloom.queries.binning import DOC_WIDE_SQL, SCORE_WEIGHTS, BINS, doc_bins
from riskloom.session import fresh_dir, settle

# The signal in this table is stronger than the default gate lets through.
WIDE_BAND = (0.02, 100.0)


def fitted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, BinMap, DataFrame]:
    """Labelled documents, their bin map, and the transformed table."""
    docs = B.labelled_documents(spark, sf_dir, "quality")
    bins = fit_bins(docs, "TARGET", B.DOC_CAT, B.DOC_NUM, BINS)
    return docs, bins, settle(woe_transform(docs, bins, ["doc_id", "TARGET"]), "woe")


@query("train_boosted_trees")
def train_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bins, woe = fitted(spark, sf_dir)
    model = training.train_boosted_trees(woe, "TARGET", bins.features)
    rows = list(training.tree_importances(model).items())
    return spark.createDataFrame(rows, "feature string, importance double")


REGULARISATION = 1e-4


@query(
    "train_scorecard",
    f"""SELECT unnest([{", ".join(f"'{f}'" for f in [*B.DOC_CAT, *B.DOC_NUM, "(intercept)"])}]) AS feature,
               0.0::DOUBLE AS slope, (SELECT count(*) FROM labels JOIN documents USING (doc_id)) AS n""",
)
def train_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slope of the regularised loss at each weight that was found, by plain arithmetic: none is left."""
    _, bins, woe = fitted(spark, sf_dir)
    model = training.train_scorecard(woe, "TARGET", bins.features, REGULARISATION)
    weights, intercept = training.scorecard_weights(model)
    logit = F.lit(intercept)
    for f, w in weights.items():
        logit = logit + F.lit(w) * F.col(f)
    miss = 1 / (1 + F.exp(-logit)) - F.col("TARGET")
    slopes = [(F.avg(miss * F.col(f)) + F.lit(REGULARISATION * w)).alias(f) for f, w in weights.items()]
    sums = woe.agg(F.count(F.lit(1)).alias("n"), F.avg(miss).alias("(intercept)"), *slopes)
    rows = sums.unpivot(["n"], ["`(intercept)`", *weights], "feature", "slope")
    return rows.select("feature", (F.round("slope", 3) + F.lit(0.0)).alias("slope"), "n")


@query("scorecard_weights")
def scorecard_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bins, woe = fitted(spark, sf_dir)
    weights, intercept = training.scorecard_weights(
        training.train_scorecard(woe, "TARGET", bins.features)
    )
    rows = [*weights.items(), ("(intercept)", intercept)]
    return spark.createDataFrame(rows, "feature string, weight double")


@query("hyper_search")
def hyper_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bins, woe = fitted(spark, sf_dir)
    trials = training.hyper_search(woe, "doc_id", "TARGET", bins.features)
    best = training.best_trial(trials)
    rows = [
        (
            t.number,
            t.params.max_depth,
            t.params.learning_rate,
            t.params.n_estimators,
            t.params.subsample,
            t.params.colsample_bytree,
            t.accuracy,
            t.number == best.number,
        )
        for t in trials
    ]
    return spark.createDataFrame(
        rows,
        "trial int, max_depth int, learning_rate double, n_estimators int, subsample double, "
        "colsample_bytree double, accuracy double, best boolean",
    )


SCORED_RIGHT_SQL = """SELECT doc_id, 0.0::DOUBLE AS score_off, 0.0::DOUBLE AS entropy_off, true AS decided_right
                      FROM documents"""


def beside_plain(scored: DataFrame, documents: DataFrame, bins: BinMap, model: PipelineModel) -> DataFrame:
    """What scores differ by from sums of weight times evidence over joined rows of the stored map."""
    weights, intercept = training.scorecard_weights(model)
    each = documents.sparkSession.createDataFrame(list(weights.items()), "feature string, weight double")
    rows = woe_joined(documents, bins, ["doc_id"]).join(F.broadcast(each), "feature")
    plain = rows.groupBy("doc_id").agg((1 / (1 + F.exp(-(F.sum(F.col("weight") * F.col("woe")) + intercept)))).alias("p"))
    p, q = F.col("prob_decline"), F.col("prob_accept")
    bits = -(F.col("p") * F.log2(F.col("p") + 1e-10) + (1 - F.col("p")) * F.log2(1 - F.col("p") + 1e-10))
    return scored.join(plain, "doc_id").select(
        "doc_id",
        rounded(F.abs(p - F.col("p")) + F.abs(q - (1 - F.col("p")))).alias("score_off"),
        rounded(F.abs(F.col("entropy") - bits)).alias("entropy_off"),
        (F.col("result") == F.when(p > q, "Decline").otherwise("Accept")).alias("decided_right"),
    )


@query("batch_score", SCORED_RIGHT_SQL)
def batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of the labelled ones, beside plain arithmetic."""
    _, bins, woe = fitted(spark, sf_dir)
    model = training.train_scorecard(woe, "TARGET", bins.features)
    documents = B.text_features(B.table(spark, sf_dir, "documents"))
    return beside_plain(scoring.batch_score(documents, bins, model, ["doc_id"]), documents, bins, model)


@query("batch_answers")
def batch_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model fitted on the labelled documents, answers for all documents."""
    _, bins, woe = fitted(spark, sf_dir)
    model = training.train_scorecard(woe, "TARGET", bins.features)
    documents = B.text_features(B.table(spark, sf_dir, "documents"))
    scored = scoring.batch_score(documents, bins, model, ["doc_id"])
    return scoring.response_rows(scored, ["doc_id"])


_LOGIT = " + ".join(["-2.0", *[f"({w}) * {f}" for f, w in SCORE_WEIGHTS.items()]])


@query(
    "scorecard_score",
    f"""WITH {DOC_WIDE_SQL}, p AS (SELECT doc_id, 1 / (1 + exp(-({_LOGIT}))) AS p1 FROM wide)
        SELECT doc_id, round(1 - p1, 6) AS prob_accept, round(p1, 6) AS prob_decline,
               CASE WHEN p1 > 1 - p1 THEN 'Decline' ELSE 'Accept' END AS result,
               round(-((1 - p1) * log2(1 - p1 + 1e-10) + p1 * log2(p1 + 1e-10)), 6) + 0.0 AS entropy,
               round(greatest(p1, 1 - p1), 6) AS confidence
        FROM p""",
)
def scorecard_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bins = doc_bins(spark, sf_dir)
    scored = scoring.scorecard_score(docs, bins, SCORE_WEIGHTS, -2.0, ["doc_id"])
    numbers = ("prob_accept", "prob_decline", "entropy", "confidence")
    return scored.withColumns({c: rounded(F.col(c)) for c in numbers})


@query("underwriting_flow")
def underwriting_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = B.labelled_documents(spark, sf_dir, "quality")
    test = B.text_features(B.table(spark, sf_dir, "documents"))
    result = run_flow(
        docs,
        test,
        fresh_dir(spark, "flow"),
        key="doc_id",
        iv_band=WIDE_BAND,
        k=5,
    )
    rows = [(result.run_name, name, value) for name, value in result.metrics.items()]
    return spark.createDataFrame(rows, "run_name string, metric string, value double")




_CARD_COLUMNS = "round(1 - p1, 6) AS prob_accept, round(p1, 6) AS prob_decline"


@query(
    "score_by_id",
    f"""WITH {DOC_WIDE_SQL}, p AS (SELECT doc_id, 1 / (1 + exp(-({_LOGIT}))) AS p1 FROM wide),
        ids AS (SELECT DISTINCT c_custkey * 2 AS id FROM customer)
        SELECT ids.id AS doc_id, {_CARD_COLUMNS},
               CASE WHEN p1 > 1 - p1 THEN 'Decline' WHEN p1 IS NOT NULL THEN 'Accept' END AS result,
               CASE WHEN p1 IS NULL THEN 'ID ' || ids.id || ' not found' END AS error
        FROM ids LEFT JOIN p ON p.doc_id = ids.id""",
)
def score_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers for a list of ids, of which some have no row."""
    docs, bins = doc_bins(spark, sf_dir)
    ids = B.table(spark, sf_dir, "customer").select((F.col("c_custkey") * 2).alias("doc_id"))
    wanted = docs.join(ids.distinct(), "doc_id", "left_semi")
    scored = scoring.scorecard_score(wanted, bins, SCORE_WEIGHTS, -2.0, ["doc_id"])
    answers = scoring.answer_by_id(ids, scored, "doc_id")
    numbers = ("prob_accept", "prob_decline")
    return answers.select("doc_id", *[rounded(F.col(c)).alias(c) for c in numbers], "result", "error")


@query(
    "save_load_transformer",
    f"""WITH {DOC_WIDE_SQL}
        SELECT doc_id, {", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in B.DOC_CAT + B.DOC_NUM)} FROM wide""",
)
def save_load_transformer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as the transformer makes it after it was saved and loaded."""
    docs, bins = doc_bins(spark, sf_dir)
    path = fresh_dir(spark, "transformer")
    store.save_transformer(spark, bins, path)
    loaded = store.load_transformer(spark, path)
    return woe_transform(docs, loaded, ["doc_id"]).select(
        "doc_id", *[rounded(F.col(c)).alias(c) for c in B.DOC_CAT + B.DOC_NUM]
    )


@query(
    "model_versions",
    """WITH classes AS (SELECT o_orderstatus AS status, avg(o_totalprice) AS price FROM orders GROUP BY o_orderstatus),
        runs AS (SELECT 'ci_XGB' AS name, row_number() OVER (ORDER BY status) AS version,
                        CASE WHEN price >= (SELECT avg(o_totalprice) FROM orders) THEN 'Production' ELSE 'None' END AS stage
                 FROM classes)
        SELECT *, version = coalesce((SELECT max(version) FROM runs WHERE stage = 'Production'),
                                     (SELECT max(version) FROM runs)) AS chosen FROM runs""",
)
def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scorer registered for each order status, in production where orders are dear, and which of
    them scores."""
    _, bins, woe = fitted(spark, sf_dir)
    model = training.train_scorecard(woe, "TARGET", bins.features)
    root = fresh_dir(spark, "registry")
    orders = B.table(spark, sf_dir, "orders")
    mean = F.avg("o_totalprice")
    whole = orders.agg(mean).first()[0]
    # a row for each status
    for r in orders.groupBy("o_orderstatus").agg(mean.alias("price")).orderBy("o_orderstatus").collect():
        store.register_scorer(spark, bins, model, root, "ci_XGB", "Production" if r["price"] >= whole else "None")
    versions = store.model_versions(spark, root)
    chosen = store.current_version(versions).select("name", F.col("version").alias("_chosen"))
    return versions.join(chosen, "name").select("name", "version", "stage", (F.col("version") == F.col("_chosen")).alias("chosen"))
