"""What the fits bring to the driver does not grow with rows, shards or bins."""

import pickle

import numpy as np
import pytest
from pyspark import RDD

from ventana.models.adaboost import AdaBoostR2
from ventana.models.boosting import GradientBoosting
from ventana.models.svr import SVR


@pytest.fixture
def brought(monkeypatch):
    sizes, old = [], RDD.collect

    def collect(self):
        got = old(self)
        sizes.append((len(got), len(pickle.dumps(got))))
        return got
    monkeypatch.setattr(RDD, "collect", collect)
    return sizes


def table(spark, n=1200):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 200, (n, 3)).astype(float)
    return spark.createDataFrame([(*map(float, r), float(r[0] - r[1] + (r[2] > 90) * 50)) for r in x], "a double, b double, c double, label double")


@pytest.mark.parametrize("spec", [GradientBoosting(n_estimators=2, shard_rows=100), AdaBoostR2(n_estimators=2, shard_rows=100)])
def test_trees_bring_a_few_numbers_a_node(spark, brought, spec):
    spec.fit(table(spark), ["a", "b", "c"])
    # 12 shards; the sums of the third level were 4 nodes x 3 features x 200 bins x 2 numbers each
    assert len(brought) >= 6 and max(size for _, size in brought) < 4000


@pytest.mark.parametrize("kernel", ["linear", "rbf"])
def test_svr_brings_one_sum_a_pass(spark, brought, kernel):
    m = SVR(kernel=kernel, n_components=16, shard_rows=100).fit(table(spark), ["a", "b", "c"])
    assert len(brought) >= m.state["passes"] and max(n for n, _ in brought) == 1
