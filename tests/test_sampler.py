"""The trial sampler: its densities by plain sums, and what the search draws with it."""

import math
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from riskloom.plans import sampler, training


def test_split_takes_the_best_tenth():
    scores = [0.1, 0.9, None, 0.9, 0.3, 0.2, 0.8, 0.1, 0.1, 0.1, 0.1]
    assert sampler.split(scores) == ([1, 3], [0, 2, 4, 5, 6, 7, 8, 9, 10])
    assert len(sampler.split([0.5] * 400)[0]) == 25


def test_kernels_by_hand():
    k = sampler.kernels([2.0, 8.0, 3.0], 0.0, 10.0)
    # neighbours in order: 2, 3, 5 (the middle of the range), 8
    assert k.mus == [2.0, 8.0, 3.0, 5.0] and k.sigmas == pytest.approx([2.0, 3.0, 2.0, 10.0])
    assert k.weights == [0.25] * 4
    many = sampler.kernels([1.0] * 40, 0.0, 10.0)
    assert many.weights[0] / many.weights[-1] == pytest.approx(1 / 40) and many.weights[15:] == [many.weights[-1]] * 26
    assert many.sigmas[0] == pytest.approx(10 / 42)
    alone = sampler.kernels([], 0.0, 10.0)
    assert (alone.mus, alone.sigmas) == ([5.0], [10.0])


@pytest.mark.parametrize("step", [None, 1])
def test_densities_add_up_and_draws_follow_them(step):
    k, r = sampler.kernels([2, 3, 7], 2, 8, step), random.Random(3)
    if step:
        at = list(range(2, 9))
        mass = [k.density(x) for x in at]
    else:
        at = [2 + 6 * (i + 0.5) / 600 for i in range(600)]
        mass = [k.density(x) * 6 / 600 for x in at]
    assert sum(mass) == pytest.approx(1, abs=1e-6)
    drawn = [k.draw(r) for _ in range(4000)]
    assert 2 <= min(drawn) and max(drawn) <= 8 and (not step or set(drawn) <= set(at))
    mean = sum(x * p for x, p in zip(at, mass))
    assert sum(drawn) / len(drawn) == pytest.approx(mean, abs=0.1)


def test_search_learns_from_its_trials(spark, monkeypatch):
    """Beyond the random ones, trials lie where earlier ones were good, and depend on them."""
    target = {"rate": 0.02}

    def fit(df, label, features, params, engine="xgb"):
        return SimpleNamespace(transform=lambda valid: params)

    def judge(params, label, prediction):
        off = abs(math.log(params.learning_rate / target["rate"])) + abs(params.max_depth - 4) / 3
        return SimpleNamespace(first=lambda: {"accuracy": 1 / (1 + off)})

    monkeypatch.setattr(training, "train_boosted_trees", fit)
    monkeypatch.setattr(training, "accuracy", judge)
    rows = spark.range(50).withColumn("y", F.col("id") % 2)

    def search():
        return training.hyper_search(rows, "id", "y", ["id"], trials=40, seed=5)

    one, rng = search(), random.Random(5)
    assert [t.number for t in one] == list(range(40)) and one == search()
    assert [t.params for t in one[:10]] == [training.draw_params(rng) for _ in range(10)]
    for t in one:
        p = t.params
        assert 2 <= p.max_depth <= 8 and 100 <= p.n_estimators <= 300 and 1e-3 <= p.learning_rate <= 0.3
        assert isinstance(p.max_depth, int) and isinstance(p.n_estimators, int)
        assert 0.5 <= p.subsample <= 1.0 and 0.5 <= p.colsample_bytree <= 1.0
    plain = [judge(training.draw_params(rng), "", "").first()["accuracy"] for _ in range(30)]
    assert sum(t.accuracy for t in one[10:]) / 30 > 1.2 * sum(plain) / 30
    target["rate"] = 0.2
    other = search()
    assert [t.params for t in other[:10]] == [t.params for t in one[:10]]
    assert [t.params for t in other[10:]] != [t.params for t in one[10:]]
