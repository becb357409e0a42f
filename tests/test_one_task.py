"""Fits that one task runs, against those of a job a step, and shards that several fits share."""

import numpy as np
import pytest

from ventana.models import adaboost, boosting, cv, shards, svr
from ventana.models.boosting import few_values
from ventana.models.forest import Limits, grow_forest

F3 = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.integers(0, 9, 300), rng.integers(0, 400, 300), rng.normal(size=300).round(2)]).astype(float)
    rows = [(i, *map(float, r), float(3 * r[0] + (r[1] > 99) * r[2] + rng.integers(0, 3))) for i, r in enumerate(x)]
    return spark.createDataFrame(rows * 2, "id long, a double, b double, c double, label double").cache()


@pytest.mark.parametrize("name,module,params", [
    ("gradient_boosting", boosting, {"n_estimators": 12}), ("ada_boost", adaboost, {"n_estimators": 12}),
    ("svm", svr, {"kernel": "rbf", "n_components": 40}), ("svm", svr, {"kernel": "linear"})])
def test_a_fit_in_one_task_is_the_fit_of_many_jobs(data, monkeypatch, name, module, params):
    spec, got = cv.get_spec(name, shard_rows=150, **params), []
    ran = []
    whole = shards.in_one_task
    monkeypatch.setattr(shards, "in_one_task", lambda *a: ran.append(1) or whole(*a))
    for most in (module.HELD, 0):
        monkeypatch.setattr(module, "HELD", most)
        got.append({r.id: r.prediction for r in spec.fit(data, F3).transform(data).collect()})
    assert len(ran) == 1 and all(got[0][i] == pytest.approx(got[1][i], rel=1e-6, abs=1e-6) for i in got[0])


def test_shards_are_shared_and_let_go(data, monkeypatch):
    made, whole = [], shards._sharded
    monkeypatch.setattr(shards, "_sharded", lambda *a: made.append(whole(*a)) or made[-1])
    alone = {r.id: r.prediction for r in cv.get_spec("voting_regressor", bases=[("gb", boosting.GradientBoosting(n_estimators=3))]).fit(data, F3).transform(data).collect()}
    assert len(made) == 1
    twice = [("gb", boosting.GradientBoosting(n_estimators=3)), ("again", boosting.GradientBoosting(n_estimators=3))]
    got = {r.id: r.prediction for r in cv.get_spec("voting_regressor", bases=twice).fit(data, F3).transform(data).collect()}
    assert len(made) == 2 and not shards._KEPT and not made[1][0].is_cached
    assert all(got[i] == pytest.approx(alone[i]) for i in got)


def test_few_values_are_all_values(spark, data):
    values = few_values(data.repartition(5), ["a", "b", "c"])
    assert values[0].tolist() == list(range(9)) and len(values[1]) <= boosting.MAX_BINS
    many = spark.range(1000).selectExpr("double(id) a", "double(id % 255) b", "double(id % 256) c").repartition(7)
    values = few_values(many, F3)
    assert values[0] is None and values[1].tolist() == list(range(255)) and values[2] is None
    assert [len(v) for v in few_values(many.limit(0), F3)] == [0, 0, 0]


def test_a_tree_cut_to_its_depth_is_not_empty(spark, data):
    rows, _, _ = shards.sharded(data, F3, "label", 150)
    tops, bodies = grow_forest(rows, 3, Limits(2, 2, 1, 7, local_rows=5))
    assert bodies.count() == 0 and all(len(t.value) == len(t.feature) == 7 for t in tops)
