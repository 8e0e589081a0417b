import random

import pytest
from pyspark.sql import functions as F

from riskloom import bindings as B
from riskloom.operators.binning import fit_bins
from riskloom.operators.evidence import woe_transform
from riskloom.plans import flow, scoring, store, training
from riskloom.plans.flow import prepare, underwriting_flow
from riskloom.queries import models
from riskloom.session import fresh_dir, settle
from riskloom.sources import read_runs
from riskloom.sources.writers import versioned_name


@pytest.fixture(scope="module")
def fitted(spark, sf_dir):
    docs = B.labelled_documents(spark, sf_dir, "quality").cache()
    bins = fit_bins(docs, "TARGET", B.DOC_CAT, B.DOC_NUM, 5)
    woe = settle(woe_transform(docs, bins, ["doc_id", "TARGET"]), "woe")
    return docs, bins, woe, training.train_scorecard(woe, "TARGET", bins.features)


def test_scores_are_probabilities(fitted):
    docs, bins, _, model = fitted
    scored = scoring.batch_score(docs, bins, model, ["doc_id"])
    rows = scored.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["prob_accept"] + r["prob_decline"] == pytest.approx(1.0)
        assert r["result"] == ("Decline" if r["prob_decline"] > r["prob_accept"] else "Accept")
        assert r["confidence"] == max(r["prob_accept"], r["prob_decline"])


def test_a_wrong_score_shows_beside_plain_arithmetic(fitted):
    docs, bins, _, model = fitted
    scored = scoring.batch_score(docs, bins, model, ["doc_id"])
    right = models.beside_plain(scored, docs, bins, model).collect()
    assert len(right) == docs.count()
    assert {(r.score_off, r.entropy_off, r.decided_right) for r in right} == {(0.0, 0.0, True)}
    wrong = scored.withColumns({"prob_decline": F.col("prob_decline") + 0.01, "entropy": F.lit(2.0), "result": F.lit("?")})
    off = models.beside_plain(wrong, docs, bins, model).collect()
    assert all(r.score_off == pytest.approx(0.01) and r.entropy_off > 0.9 and not r.decided_right for r in off)


def test_plain_arithmetic_scores_like_the_model(fitted):
    docs, bins, _, model = fitted
    weights, intercept = training.scorecard_weights(model)
    a = {r["doc_id"]: r["prob_decline"] for r in scoring.batch_score(docs, bins, model, ["doc_id"]).collect()}
    b = {r["doc_id"]: r["prob_decline"] for r in scoring.scorecard_score(docs, bins, weights, intercept, ["doc_id"]).collect()}
    assert a == pytest.approx(b, abs=1e-9)


def test_saved_scorer_scores_the_same(spark, fitted):
    docs, bins, _, model = fitted
    path = fresh_dir(spark, "scorer")
    store.save_scorer(spark, bins, model, path)
    bins2, model2 = store.load_scorer(spark, path)
    assert bins2.rows == bins.rows
    before = scoring.batch_score(docs, bins, model, ["doc_id"])
    after = scoring.batch_score(docs, bins2, model2, ["doc_id"])
    assert before.exceptAll(after).count() == 0 and after.exceptAll(before).count() == 0


def test_scoring_by_id(spark, fitted):
    docs, bins, _, model = fitted
    some = [r["doc_id"] for r in docs.orderBy("doc_id").limit(2).collect()]
    ids = spark.createDataFrame([(i,) for i in [*some, -1]], "doc_id bigint")
    found = scoring.score_by_id(ids, docs, bins, model, "doc_id")
    rows = {r["doc_id"]: r for r in found.collect()}
    assert set(rows) == {*some, -1}
    assert rows[-1]["error"] == "ID -1 not found" and rows[-1]["result"] is None
    assert all(rows[i]["error"] is None and rows[i]["result"] for i in some)


def test_registered_versions(spark, fitted):
    _, bins, _, model = fitted
    root = fresh_dir(spark, "registry")
    stages = ["None", "Production", "Archived", "None"]
    assert [store.register_scorer(spark, bins, model, root, "m", s) for s in stages] == [1, 2, 3, 4]
    assert store.register_scorer(spark, bins, model, root, "other") == 1
    chosen = store.current_version(store.model_versions(spark, root)).collect()
    assert {(r["name"], r["version"]) for r in chosen} == {("m", 2), ("other", 1)}
    assert store.load_registered(spark, root, "m")[0].rows == bins.rows
    with pytest.raises(ValueError):
        store.load_registered(spark, root, "unknown")


def test_scoring_does_not_shuffle(fitted):
    docs, bins, woe, model = fitted
    flat = woe.sparkSession.createDataFrame([], docs.schema)
    plan = scoring.batch_score(flat, bins, model, ["doc_id"])._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def test_boosted_trees(fitted):
    _, bins, woe, _ = fitted
    small = training.TreeParams(max_depth=2, learning_rate=0.3, n_estimators=3)
    model = training.train_boosted_trees(woe, "TARGET", bins.features, small, "lgbm")
    shares = training.tree_importances(model)
    assert sum(shares.values()) == pytest.approx(1.0)
    with pytest.raises(ValueError):
        training.train_boosted_trees(woe, "TARGET", bins.features, small, "other")


def test_equal_rows_stand_together_and_none_is_lost(spark, monkeypatch):
    rows = [(i % 3 == 0, float(i % 2), float(i % 5)) for i in range(1003)]
    df = spark.createDataFrame([(int(y), a, b) for y, a, b in rows], "y int, `a b` double, c double").repartition(7)
    single = training.bunched(df, "y", ["a b", "c"]).collect()
    assert sorted(map(tuple, single)) == sorted((int(y), a, b, 1.0) for y, a, b in rows)
    assert training.bunched(df, "y", ["a b", "c"]).rdd.getNumPartitions() == 1
    monkeypatch.setattr(training, "SINGLE_ROWS", 100)
    bunches = training.bunched(df, "y", ["a b", "c"]).collect()
    kinds = {}
    for r in rows:
        kinds[r] = kinds.get(r, 0) + 1
    found = {}
    for y, a, b, w in bunches:
        assert 1 <= w <= 11
        found[bool(y), a, b] = found.get((bool(y), a, b), 0) + w
    assert found == kinds
    assert len(bunches) <= 100 + len(kinds) < len(rows)
    assert training.bunched(df.limit(0), "y", ["a b", "c"]).count() == 0


def test_trees_do_not_depend_on_how_rows_are_dealt(fitted):
    _, bins, woe, _ = fitted
    small = training.TreeParams(max_depth=3, learning_rate=0.3, n_estimators=4, subsample=0.7, colsample_bytree=0.6)
    texts = {
        training.train_boosted_trees(woe.repartition(n), "TARGET", bins.features, small).stages[-1].toDebugString.split("\n", 1)[1]
        for n in (1, 5)
    }
    assert len(texts) == 1


def test_bunches_teach_what_their_rows_teach(fitted, monkeypatch):
    _, bins, woe, _ = fitted
    many = woe.crossJoin(woe.sparkSession.range(5).select())
    whole = training.TreeParams(max_depth=3, learning_rate=0.3, n_estimators=4)
    p = {}
    for single in (100_000, 20):
        monkeypatch.setattr(training, "SINGLE_ROWS", single)
        model = training.train_boosted_trees(many, "TARGET", bins.features, whole)
        p[single] = {r.doc_id: r.probability[1] for r in model.transform(woe).collect()}
    assert p[20] == pytest.approx(p[100_000])


def test_draws_stay_inside_the_search_space():
    rng = random.Random(1)
    for _ in range(200):
        p = training.draw_params(rng)
        assert 2 <= p.max_depth <= 8 and 100 <= p.n_estimators <= 300
        assert 1e-3 <= p.learning_rate <= 0.3
        assert 0.5 <= p.subsample <= 1.0 and 0.5 <= p.colsample_bytree <= 1.0


def test_best_trial_prefers_the_earliest_tie():
    trials = [training.Trial(i, training.TreeParams(), a) for i, a in enumerate([0.7, 0.9, 0.9])]
    assert training.best_trial(trials).number == 1


def test_search_is_seeded(fitted):
    _, bins, woe, _ = fitted
    runs = [
        training.hyper_search(woe, "doc_id", "TARGET", bins.features, trials=2, trees=(2, 3), depth=(2, 2))
        for _ in range(2)
    ]
    assert runs[0] == runs[1] and len(runs[0]) == 2


def test_registered_searches_draw_the_full_number_of_trees(spark, sf_dir, monkeypatch):
    drawn = []

    def fit(df, label, features, params, engine="xgb"):
        drawn.append(params.n_estimators)
        small = training.TreeParams(2, params.learning_rate, 2)
        return one_fit(df, label, features, small, engine)

    one_fit = training.train_boosted_trees
    monkeypatch.setattr(training, "train_boosted_trees", fit)
    monkeypatch.setattr(flow, "train_boosted_trees", fit)
    trials = models.hyper_search(spark, sf_dir).collect()
    models.underwriting_flow(spark, sf_dir)
    assert len(trials) == training.TRIALS and len(drawn) == 2 * training.TRIALS + 1
    assert all(100 <= n <= 300 for n in [*drawn, *(t.n_estimators for t in trials)])


def test_gate_of_the_flow(fitted):
    docs, *_ = fitted
    prepared = prepare(docs, docs.drop("TARGET"), "doc_id", "TARGET", k=2, iv_band=(0.02, 100.0), prebins=5)
    assert len(prepared.selected) == 2
    order = [*B.DOC_CAT, *B.DOC_NUM]
    assert prepared.selected == sorted(prepared.selected, key=order.index)
    assert prepared.train.columns == ["doc_id", "TARGET", *prepared.selected]
    assert prepared.test.columns == ["doc_id", *prepared.selected]


@pytest.mark.parametrize("name", ["xgb", "scorecard"])
def test_whole_flow(spark, fitted, name):
    docs, *_ = fitted
    dest = fresh_dir(spark, "flow")
    result = underwriting_flow(
        docs, docs.drop("TARGET"), dest, "doc_id", version="ci", model_name=name,
        iv_band=(0.02, 100.0), k=3, trials=1, trees=(2, 2), depth=(2, 2),
    )
    assert result.run_name == f"ci_{name.upper()}"
    logged = read_runs(spark, f"{dest}/runs").first()
    assert logged["metrics"] == pytest.approx(result.metrics)
    assert result.metrics["roc_auc"] == pytest.approx(result.metrics["roc_auc_trapezoid"])
    test = spark.read.parquet(versioned_name(f"{dest}/test.parquet", "v1"))
    assert test.count() == docs.count()
    bins, model = store.load_registered(spark, dest, result.run_name)
    assert bins.features == result.preparation.selected
    assert result.report.where(F.col("row") == "accuracy").first()["f1"] == pytest.approx(result.metrics["accuracy"])


def test_flow_without_survivors(spark, sf_dir):
    items = B.lineitems(spark, sf_dir).drop("l_linenumber", "l_partkey", "l_suppkey")
    with pytest.raises(ValueError, match="no feature"):
        underwriting_flow(items, None, fresh_dir(spark, "flow"), "l_orderkey", iv_band=(0.4, 0.5))


def test_runs_that_register_together_get_their_own_versions(spark):
    from concurrent.futures import ThreadPoolExecutor

    from riskloom.plans import store

    root = fresh_dir(spark, "registry")
    with ThreadPoolExecutor(10) as pool:
        claimed = list(pool.map(lambda _: store.claim_version(spark, root, "ci_XGB"), range(10)))
    assert sorted(claimed) == list(range(1, 11))
    assert store.claim_version(spark, root, "other") == 1
    df = spark.createDataFrame([(i, i % 2, float(i % 5)) for i in range(40)], "id long, y int, x double")
    bins = fit_bins(df, "y", [], ["x"], 4)
    model = training.train_scorecard(woe_transform(df, bins, ["y"]), "y", ["x"])
    with ThreadPoolExecutor(4) as pool:
        made = list(pool.map(lambda _: store.register_scorer(spark, bins, model, root, "ci_XGB"), range(4)))
    assert sorted(made) == [11, 12, 13, 14]
    assert sorted(r["version"] for r in store.model_versions(spark, root).collect()) == [11, 12, 13, 14]
