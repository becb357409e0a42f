"""G5 against a brute-force boosting that tries every cut."""
import numpy as np
import pytest

from ventana.models import cv as CV
from ventana.models.boosting import MAX_BINS, GradientBoosting, Tree


def brute_tree(x, r, depth, split, leaf):
    """Nested (feature, threshold, left, right) or a value."""
    n = len(r)
    if depth == 0 or n < split or r.var() <= 1e-14 * max(1.0, (r * r).mean()):
        return r.mean()
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for a, b in zip(values, values[1:]):
            go = x[:, f] <= a
            nl, nr = go.sum(), (~go).sum()
            if min(nl, nr) < leaf:
                continue
            gain = nl * nr / n * (r[go].mean() - r[~go].mean()) ** 2
            if best is None or gain > best[0] * (1 + 1e-10):
                best = (gain, f, (a + b) / 2, go)
    if best is None or best[0] <= 1e-14:
        return r.mean()
    _, f, t, go = best
    return f, t, brute_tree(x[go], r[go], depth - 1, split, leaf), brute_tree(x[~go], r[~go], depth - 1, split, leaf)


def follow(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def brute(x, y, rounds, rate, depth, split, leaf, new):
    start = y.mean()
    now, out = np.full(len(y), start), np.full(len(new), start)
    for _ in range(rounds):
        tree = brute_tree(x, y - now, depth, split, leaf)
        now = now + rate * np.array([follow(tree, row) for row in x])
        out = out + rate * np.array([follow(tree, row) for row in new])
    return out


def frame(spark, x, y):
    return spark.createDataFrame([(i, *map(float, row), float(v)) for i, (row, v) in enumerate(zip(x, y))], "id long, a double, b double, c double, label double")


@pytest.mark.parametrize("rounds,rate,depth,split,leaf", [(1, 1.0, 1, 2, 1), (12, 0.1, 3, 2, 1), (5, 0.3, 4, 20, 3), (4, 0.5, 2, 2, 30)])
def test_boosting_equals_trying_every_cut(spark, rounds, rate, depth, split, leaf):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.integers(0, 30, 300), rng.integers(-5, 5, 300) / 4, rng.normal(size=300).round(2)])
    y = 3 * x[:, 0] - 20 * (x[:, 1] > 0) + 5 * x[:, 2] ** 2 + rng.normal(size=300)
    x[250:], y[250:] = x[:50], y[:50]  # rows that repeat
    df = frame(spark, x, y)
    spec = GradientBoosting(n_estimators=rounds, learning_rate=rate, max_depth=depth, min_samples_split=split, min_samples_leaf=leaf, shard_rows=40)
    m = spec.fit(df.repartition(3), ["a", "b", "c"])
    new = np.concatenate([x[:60], rng.uniform(-6, 31, (60, 3))])
    want = brute(x, y, rounds, rate, depth, split, leaf, new)
    assert np.allclose(m.values(new), want, rtol=1e-9, atol=1e-9)
    got = {r.id: r.prediction for r in m.transform(frame(spark, new, want)).collect()}
    assert [got[i] for i in range(len(new))] == pytest.approx(list(want), abs=1e-8)


def test_many_values_and_missing_ones(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 3))
    y = 10 * (x[:, 0] > 0.3) + x[:, 1]
    m = GradientBoosting(n_estimators=25, learning_rate=0.3, shard_rows=300).fit(frame(spark, x, y), ["a", "b", "c"])
    assert len({t.threshold[0] for t in m.trees}) > 1 and len(np.unique(x[:, 0])) > MAX_BINS
    assert np.abs(m.values(x) - y).mean() < 0.15
    holes = spark.createDataFrame([(1.0, None, 0.0), (float("nan"), 1.0, 0.0), (1.0, 1.0, 0.0)], "a double, b double, c double")
    got = [r.prediction for r in m.transform(holes).collect()]
    assert got[0] is None and got[1] is None and got[2] is not None
    with pytest.raises(ValueError, match="missing"):
        GradientBoosting().fit(holes.selectExpr("*", "1.0 as label"), ["a", "b", "c"])


def test_edges_of_boosting(spark):
    flat = frame(spark, np.ones((20, 3)), np.full(20, 4.0))
    m = GradientBoosting(n_estimators=30).fit(flat, ["a", "b", "c"])
    assert len(m.trees) == 1 and m.values(np.zeros((1, 3)))[0] == 4.0
    with pytest.raises(ValueError, match="max_depth"):
        GradientBoosting(max_depth=40).fit(flat, ["a"])
    with pytest.raises(ValueError, match="no training rows"):
        GradientBoosting().fit(flat.limit(0), ["a"])
    a, b = GradientBoosting(min_samples_split=2), GradientBoosting(min_samples_split=3)
    assert a.effective() != b.effective() and a.effective() == GradientBoosting().effective()
    assert Tree.of(3).depth == 3 and CV.get_spec("gradient_boosting", max_depth=2).rules().depth == 2
