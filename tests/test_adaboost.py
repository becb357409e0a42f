"""G10 against AdaBoost.R2 written out, with the same draws."""
import math

import numpy as np
import pytest
from test_boosting import brute_tree, follow, frame

from ventana.models import adaboost as A
from ventana.models import shards


def brute(groups, n, rounds, seed, new):
    """groups: (x, y, multiplicity) per shard."""
    x, y = np.concatenate([g[0] for g in groups]), np.concatenate([g[1] for g in groups])
    weight = [g[2] / n for g in groups]
    trees, weights = [], []
    for t in range(rounds):
        quota = A.share_out([w.sum() for w in weight], n, [seed, t])
        taken = np.concatenate([A.draws(w, q, [seed, t, k]) for k, (w, q) in enumerate(zip(weight, quota))]).astype(int)
        tree = brute_tree(np.repeat(x, taken, axis=0), np.repeat(y, taken), 3, 2, 1)
        error = np.abs(y - np.array([follow(tree, row) for row in x]))
        now = np.concatenate(weight)
        loss = (now @ error) / (error.max() * now.sum())
        if loss >= 0.5 and trees:
            break
        trees.append(tree)
        beta = loss / (1 - loss)
        weights.append(math.log(1 / beta))
        now = now * beta ** (1 - error / error.max())
        weight = np.split(now / now.sum(), np.cumsum([len(g[1]) for g in groups])[:-1])
    out = []
    for row in new:
        pairs = sorted((follow(t, row), w) for t, w in zip(trees, weights))
        total, reached = sum(weights), 0.0
        for value, w in pairs:
            reached += w
            if reached >= 0.5 * total:
                out.append(value)
                break
    return np.array(out), len(trees)


def test_adaboost_equals_the_definition(spark):
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.integers(0, 20, 200), rng.integers(0, 8, 200), rng.normal(size=200).round(1)])
    y = x[:, 0] * 2 + (x[:, 1] > 4) * 10 + rng.normal(size=200)
    x[180:], y[180:] = x[:20], y[:20]
    df = frame(spark, x, y)
    m = A.AdaBoostR2(n_estimators=13, shard_rows=60).fit(df.repartition(2), ["a", "b", "c"])
    data, n, _ = shards.sharded(df, ["a", "b", "c"], "label", 60)
    groups = [(g[0], g[1], g[2]) for g in sorted(shards.packed(data, 3).collect(), key=lambda g: g[3])]
    data.unpersist()
    want, rounds = brute(groups, n, 13, 42, x[:80])
    assert len(m.trees) == rounds and np.allclose(m.values(x[:80]), want)
    got = [r.prediction for r in m.transform(frame(spark, x[:80], want)).orderBy("id").collect()]
    assert got == pytest.approx(list(want))


def test_draws_follow_the_weights():
    weight = np.array([0.5, 0.0, 0.25, 0.25])
    taken = A.draws(weight, 40_000, [1, 2])
    assert taken.sum() == 40_000 and taken[1] == 0 and np.allclose(taken / 40_000, weight, atol=0.01)
    assert sum(A.share_out([3.0, 1.0], 1000, [7])) == 1000
    assert A.draws(weight, 0, [1]).sum() == 0


def test_perfect_and_missing(spark):
    flat = frame(spark, np.ones((10, 3)), np.full(10, 2.0))
    m = A.AdaBoostR2(n_estimators=9).fit(flat, ["a", "b", "c"])
    assert len(m.trees) == 1 and m.values(np.ones((1, 3)))[0] == 2.0
    holes = spark.createDataFrame([(1.0, None, 0.0), (1.0, 1.0, 0.0)], "a double, b double, c double")
    assert [r.prediction is None for r in m.transform(holes).collect()] == [True, False]
