"""Forests grown off the driver, against a plain tree and one another."""

import numpy as np
import pytest

from ventana.models import forest
from ventana.models.boosting import candidate_cuts
from ventana.models.classic import Bagging, RandomForest
from ventana.models.forest import Limits, grow_body, grow_forest, taken
from ventana.models.persist import load_model, save_model
from ventana.models.shards import packed, sharded

F3 = ["a", "b", "c"]


def table(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (n, 3)).astype(float)
    y = 3 * x[:, 0] + (x[:, 1] > 5) * x[:, 2] + rng.integers(0, 5, n)
    return spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))], "id long, a double, b double, c double, label double")


def plain(x, y, w, depth, leaf, at):
    """The value at ``at`` of the tree that tries every cut of the rows, one node after another."""
    n, mean = w.sum(), (w @ y) / w.sum()
    best = (1e-9, None)
    if depth and n >= 2 * leaf and y.min() < y.max():
        for j in range(x.shape[1]):
            values = np.unique(x[:, j])
            for a, b in zip(values, values[1:]):
                go = x[:, j] <= a
                nl, nr = w[go].sum(), w[~go].sum()
                gain = nl * nr / n * ((w[go] @ y[go]) / nl - (w[~go] @ y[~go]) / nr) ** 2
                if min(nl, nr) >= leaf and gain > best[0] * (1 + 1e-9):
                    best = (gain, (j, (a + b) / 2))
    if best[1] is None:
        return mean
    j, cut = best[1]
    go = x[:, j] <= cut if at[j] <= cut else x[:, j] > cut
    return plain(x[go], y[go], w[go], depth - 1, leaf, at)


@pytest.mark.parametrize("depth,leaf", [(30, 1), (3, 1), (30, 7)])
def test_body_tries_every_cut(depth, leaf):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 9, (150, 3)).astype(float)
    y, w = rng.normal(size=150) + x[:, 1] * x[:, 0], rng.integers(1, 4, 150).astype(float)
    cuts = [np.unique(x[:, j]) for j in range(3)]
    bins = np.column_stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)]).astype(np.uint8)
    tree = grow_body(bins, y, w, cuts, [True] * 3, depth, leaf)
    asked = np.vstack([x[:30], rng.uniform(-1, 10, (30, 3))])
    assert np.allclose(tree.value[tree.leaves(asked)], [plain(x, y, w, depth, leaf, a) for a in asked])


def values(model, df):
    return {r.id: r.prediction for r in model.transform(df).select("id", "prediction").collect()}


def test_forest_is_the_mean_of_trees_on_bootstraps(spark):
    df = table(spark)
    got = values(RandomForest(n_estimators=3, seed=5).fit(df, F3), df)
    data, _, _ = sharded(df, F3, "label")
    x, y, w, number = packed(data, 3).collect()[0]
    rows = {r.id: np.array([r.a, r.b, r.c]) for r in df.collect()}
    for i in list(rows)[:25]:
        each = []
        for tree in range(3):
            k = taken(w, 5, tree, number)
            each.append(plain(x[k > 0], y[k > 0], k[k > 0], 30, 1, rows[i]))
        assert got[i] == pytest.approx(np.mean(each), abs=1e-9)


@pytest.mark.parametrize("cells", [forest.GROUP_CELLS, 1])
def test_tops_and_bodies_are_one_tree(spark, monkeypatch, cells):
    """Nodes cut by histograms, several a job or one, give the trees that are grown in one task."""
    df = table(spark, 900)
    data, _, _ = sharded(df, F3, "label", 250)
    assert len(candidate_cuts(data, ["x0"])[0][0]) == 12
    monkeypatch.setattr(forest, "GROUP_CELLS", cells)
    asked = df.drop("label")
    whole = forest.FittedForest(*grow_forest(data, 3, Limits(2, 30, 1, 7)), F3, "f")
    parts = forest.FittedForest(*grow_forest(data, 3, Limits(2, 30, 1, 7, local_rows=60)), F3, "f")
    assert [len(t.small) for t in whole.tops] == [1, 1] and all(len(t.small) > 5 and not t.large for t in parts.tops)
    a, b = values(whole, asked), values(parts, asked)
    assert len(a) == 900 and all(a[i] == pytest.approx(b[i], abs=1e-9) for i in a)
    few = forest.FittedForest(*grow_forest(data, 3, Limits(2, 2, 1, 7, local_rows=10)), F3, "f")
    short = forest.FittedForest(*grow_forest(data, 3, Limits(2, 2, 1, 7)), F3, "f")
    a, b = values(few, asked), values(short, asked)
    assert all(a[i] == pytest.approx(b[i], abs=1e-9) for i in a)


def test_forest_saved_copies_and_missing(spark, tmp_path):
    df = table(spark, 200)
    twice = df.drop("label").unionByName(df.drop("label"))
    m = Bagging(n_estimators=3).fit(df, F3)
    got = m.transform(twice)
    assert got.columns == ["id", "a", "b", "c", "prediction"] and got.count() == 400
    save_model(spark, m, str(tmp_path / "m"))
    assert values(load_model(spark, str(tmp_path / "m")), df) == values(m, df)
    with pytest.raises(Exception, match="missing values"):
        m.transform(spark.createDataFrame([(1, 1.0, None, 2.0)], "id long, a double, b double, c double")).collect()
    with pytest.raises(TypeError):
        RandomForest(bogus=1)
    assert m.transform(df.limit(0)).count() == 0


def test_a_tree_without_rows_knows_the_mean(spark):
    one = spark.createDataFrame([(1, 1.0, 2.0, 3.0, 7.0)], "id long, a double, b double, c double, label double")
    assert values(RandomForest(n_estimators=20).fit(one, F3), one) == {1: pytest.approx(7.0)}
