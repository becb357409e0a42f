"""G3, G4 against a dense solver, and what the fit says about itself."""
import numpy as np
import pytest

from ventana.models.svr import SVR, kernel


def dense(x, y, C, eps):
    """Dual coordinate ascent to a tiny gap on centred rows with a constant feature: (weights, objective)."""
    q, n = (x * x).sum(axis=1), len(y)
    beta, w = np.zeros(n), np.zeros(x.shape[1])
    for _ in range(20000):
        for i in range(n):
            u = beta[i] + (y[i] - x[i] @ w) / q[i]
            b = np.clip(np.sign(u) * max(abs(u) - eps / q[i], 0.0), -C, C)
            w, beta[i] = w + (b - beta[i]) * x[i], b
        primal = 0.5 * w @ w + C * np.maximum(0, np.abs(y - x @ w) - eps).sum()
        if primal - (y @ beta - eps * np.abs(beta).sum() - 0.5 * w @ w) <= 2e-4 * primal:
            return w, primal
    raise AssertionError("the dense solver did not settle")


def frame(spark, x, y):
    return spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))], "id long, a double, b double, label double")


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 2))
    return x, 2 * x[:, 0] - x[:, 1] + 5 + rng.normal(scale=0.5, size=120) + (rng.random(120) < 0.1) * 6


@pytest.mark.parametrize("C", [0.02, 0.2])
def test_linear_equals_a_dense_solver(spark, rows, C):
    x, y = rows
    m = SVR(kernel="linear", C=C, epsilon=0.2, shard_rows=25).fit(frame(spark, x, y).repartition(5), ["a", "b"])
    assert m.state["gap"] <= 1e-3
    center = x - x.mean(axis=0)
    big = 10 * max(1.0, np.sqrt(center.var(axis=0).sum()))
    w, best = dense(np.column_stack([center, np.full(len(x), big)]), y - y.mean(), C, 0.2)
    assert best * (1 - 1e-3) <= m.state["objective"] <= best * (1 + 1.1e-3)
    assert np.allclose(m.state["w"], w[:-1], atol=0.05)
    got = [r.prediction for r in m.transform(frame(spark, x, y)).orderBy("id").collect()]
    assert np.allclose(got, center @ w[:-1] + big * w[-1] + y.mean(), atol=0.15)


def test_repeated_rows_weigh(spark, rows):
    x, y = rows
    one = SVR(kernel="linear", C=2.0).fit(frame(spark, x, y), ["a", "b"])
    two = SVR(kernel="linear", C=1.0, shard_rows=40).fit(frame(spark, np.concatenate([x, x]), np.concatenate([y, y])), ["a", "b"])
    assert one.state["objective"] == pytest.approx(two.state["objective"], rel=2e-3)


def test_rbf_with_all_rows_as_landmarks_is_the_kernel(spark, rows):
    x, _ = rows
    y = np.sin(2 * x[:, 0]) * 3 + x[:, 1] ** 2
    all_ = SVR(C=1.0, gamma=0.5, n_components=200).fit(frame(spark, x, y), ["a", "b"])
    assert all_.state["gap"] <= 1e-3 and all_.state["kernel_error"] < 1e-6
    few = SVR(C=1.0, gamma=0.5, n_components=12).fit(frame(spark, x, y), ["a", "b"])
    assert few.state["kernel_error"] > 1e-3
    score = lambda m: np.abs(np.array([r.prediction for r in m.transform(frame(spark, x, y)).orderBy("id").collect()]) - y).mean()
    assert score(all_) < 0.4 and score(all_) < score(few)
    k = kernel(x, x, 0.5)
    assert np.allclose(np.diag(k), 1) and np.allclose(k, k.T)


def test_rows_without_features_and_without_rows(spark, rows):
    x, y = rows
    m = SVR(C=1.0, n_components=20, rounds=8).fit(frame(spark, x, y), ["a", "b"])
    holes = spark.createDataFrame([(1.0, None), (float("nan"), 1.0), (1.0, 1.0)], "a double, b double")
    got = [r.prediction for r in m.transform(holes).collect()]
    assert got[0] is None and got[1] is None and got[2] is not None
    with pytest.raises(ValueError, match="no training rows"):
        SVR().fit(frame(spark, x, y).limit(0), ["a", "b"])
    flat = SVR(kernel="linear").fit(frame(spark, np.ones((30, 2)), np.full(30, 4.0)), ["a", "b"])
    assert [r.prediction for r in flat.transform(frame(spark, np.ones((1, 2)), [0.0])).collect()] == pytest.approx([4.0], abs=0.11)
