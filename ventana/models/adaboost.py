"""G10 -- AdaBoost.R2 (Drucker, 1997) by weighted resampling.

Every round draws as many rows as there are, with replacement and in
proportion to their weights, fits a tree to the draws, and raises the weights
of rows it predicts badly. The draws are those from prefix sums of all
weights: the shards' totals split the draws among the shards (one multinomial
draw of as many numbers as shards), and within a shard places in the running
sum of its weights pick the rows. Seeds belong to round and shard, so a
recomputed task draws the same rows. Trees grow on histograms as in
``models.boosting``, with the number of draws as weight. A round is a job per
level, one for the errors and one for the totals; weights are brought up to
date, brought back to a sum of one and checkpointed every FOLD rounds. Distinct
rows of at most HELD shards meet in one task, which runs the rounds by the same code.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ventana.models import shards
from ventana.models.base import LABEL, PRED, Fitted, Spec
from ventana.models.boosting import FOLD, HELD, Rules, Tree, binned, grow, known_cuts, level_cuts
from ventana.session import checkpoint_dir

#: A past round's effect on the weights: its tree, beta, the largest error, the learning rate.
Past = tuple[Tree, float, float, float]


def weights_now(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, past: list[Past]) -> np.ndarray:
    for tree, beta, largest, rate in past:
        weight = weight * beta ** ((1.0 - np.abs(y - tree.predict_bins(bins)) / largest) * rate)
    return weight


def draws(weight: np.ndarray, n: int, seed: list[int]) -> np.ndarray:
    """How often each row is drawn in ``n`` draws in proportion to ``weight``."""
    if not n:
        return np.zeros(len(weight))
    ends = np.cumsum(weight)
    at = np.random.default_rng(seed).random(n) * ends[-1]
    return np.bincount(np.minimum(np.searchsorted(ends, at, "right"), len(weight) - 1), minlength=len(weight)).astype(np.float64)


def share_out(totals: list[float], n: int, seed: list[int]) -> list[int]:
    """The draws that fall to each shard."""
    p = np.array(totals, dtype=np.float64)
    return np.random.default_rng(seed).multinomial(n, p / p.sum()).tolist()


class AdaBoostR2(Spec):
    """50 rounds, learning rate 1, trees of depth 3, linear loss. Stops
    when a round's weighted loss is 0 (kept) or at least 0.5 (discarded, unless
    it is the first). Prediction: the weighted median of the trees."""
    name = "ada_boost"
    allowed = frozenset({"n_estimators", "learning_rate", "max_depth", "shard_rows", "seed"})

    def fit(self, df: DataFrame, features: list[str], label: str = LABEL) -> Fitted:
        get, p = self.params.get, len(features)
        rate, seed = float(get("learning_rate", 1.0)), int(get("seed", 42))
        rules = Rules(int(get("n_estimators", 50)), 1.0, int(get("max_depth", 3)))
        size = int(get("shard_rows", shards.SHARD_ROWS))
        data, n, _ = shards.sharded(df, features, label, size)
        checkpoint_dir(df.sparkSession)
        try:
            if not n:
                raise ValueError("no training rows")
            cuts, exact = known_cuts(data, p)
            rows, run = binned(data, p, cuts), lambda some: rounds(some, p, n, cuts, exact, rules, rate, seed)
            trees, weights = shards.in_one_task(rows, lambda s: s[3], run) if data.count() <= HELD * size else run(rows)
            return MedianOfTrees(trees, weights, list(features), self.name)
        finally:
            shards.release(data)


def rounds(rows: RDD | shards.Held, p: int, n: int, cuts: list[np.ndarray], exact: list[bool], rules: Rules, rate: float, seed: int) -> tuple[list[Tree], list[float]]:
    """The trees and their weights. ``n``: the training rows."""
    trees: list[Tree] = []
    weights: list[float] = []
    past: list[Past] = []
    width = max(len(c) for c in cuts)
    rdd = rows.map(lambda s: ((s[0], s[1], s[2] / n), s[3])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for t in range(rules.rounds):
            totals = sorted(rdd.map(_total(past)).collect())  # a number per shard
            quota = dict(zip([k for k, _ in totals], share_out([w for _, w in totals], n, [seed, t])))
            tree = Tree.of(rules.depth)
            for level in range(rules.depth):
                best = level_cuts(rdd, _level(past, quota, [seed, t], tree, level), level, p, width, rules.leaf)
                if not grow(tree, level, best, cuts, exact, rules):
                    break
            largest, total, weighted = rdd.map(_errors(past, tree)).treeReduce(lambda a, b: (max(a[0], b[0]), a[1] + b[1], a[2] + b[2]))
            loss = weighted / (largest * total) if largest > 0 else 0.0
            if loss >= 0.5 and trees:
                break
            trees.append(tree)
            if loss <= 0 or loss >= 0.5:
                weights.append(1.0)
                break
            beta = loss / (1.0 - loss)
            weights.append(rate * math.log(1.0 / beta))
            past.append((tree, beta, largest, rate))
            if len(past) == FOLD and t + 1 < rules.rounds:
                later = rdd.map(_brought_up(past, total)).persist(StorageLevel.MEMORY_AND_DISK)
                later.checkpoint()
                later.count()
                rdd.unpersist()
                rdd, past = later, []
    finally:
        rdd.unpersist()
    return trees, weights


def _total(past: list[Past]):
    past = list(past)
    return lambda s: (s[1], float(weights_now(*s[0], past).sum()))


def _level(past: list[Past], quota: dict[int, int], seed: list[int], tree: Tree, level: int):
    past = list(past)

    def run(s) -> tuple:
        (bins, y, weight), k = s
        taken = draws(weights_now(bins, y, weight, past), quota[k], [*seed, k])
        some = taken > 0
        return bins[some], tree.descend(bins[some], tree.cut, level), taken[some], y[some]
    return run


def _errors(past: list[Past], tree: Tree):
    past = list(past)

    def run(s) -> tuple[float, float, float]:
        (bins, y, weight), _ = s
        now, error = weights_now(bins, y, weight, past), np.abs(y - tree.predict_bins(bins))
        return float(error.max()), float(now.sum()), float(now @ error)
    return run


def _brought_up(past: list[Past], total: float):
    past = list(past)
    return lambda s: ((s[0][0], s[0][1], weights_now(*s[0], past) / total), s[1])


class MedianOfTrees(Fitted):
    """The weighted median of the trees' predictions: the first, in order of
    value, at which half of all weight is reached. In Arrow batches."""

    def __init__(self, trees: list[Tree], weights: list[float], features: list[str], name: str = "ada_boost"):
        self.trees, self.weights, self.features, self.name, self.output_col = trees, list(map(float, weights)), features, name, PRED

    def values(self, x: np.ndarray) -> np.ndarray:
        """NaN where a feature is missing."""
        each = np.stack([t.predict(x) for t in self.trees], axis=1)
        order = np.argsort(each, axis=1, kind="stable")
        reached = np.cumsum(np.array(self.weights)[order], axis=1)
        at = np.argmax(reached >= 0.5 * reached[:, -1:], axis=1)
        n = np.arange(len(x))
        return np.where(np.isnan(x).any(axis=1), np.nan, each[n, order[n, at]])

    def transform(self, df: DataFrame) -> DataFrame:
        me, feats, out = MedianOfTrees(self.trees, self.weights, self.features), self.features, self.output_col
        schema = T.StructType([f for f in df.schema.fields if f.name != out] + [T.StructField(out, T.DoubleType())])

        def score(batches):
            for pdf in batches:
                v = me.values(pdf[feats].to_numpy(dtype=np.float64))
                pdf[out] = pd.Series(np.nan_to_num(v), index=pdf.index, dtype="Float64").mask(np.isnan(v))
                yield pdf[[f.name for f in schema.fields]]
        return df.mapInPandas(score, schema)
