"""G5 -- gradient boosting for squared loss, level by level on histograms.

The start is the mean of the target; every round fits a regression tree to
the residuals and adds ``learning_rate`` of it. Trees grow by the friedman
gain ``nl * nr / n * (mean_l - mean_r)^2``; a node is split if it holds
``min_samples_split`` rows or more, is not pure, and leaves
``min_samples_leaf`` on both sides.

Candidate cuts are made once: the distinct values of a feature with at most
MAX_BINS of them (then every cut there is, is one: the trees are the exact
ones, cut midway between neighbours of the node), else that many quantiles.
Rows are dealt to shards (``models.shards``: equal rows once, with a weight;
the same shards on any cluster) and kept as bins. A level is one job: every
shard adds up weight and residual per node, feature and bin; each feature's
sums meet in a task, which finds the feature's best cut of every node. The
driver compares those: it gets eight numbers per node and feature, whatever the
rows and bins. Shards keep the running
prediction, brought up to date after every round; each FOLD rounds it is
checkpointed in the shared folder, so a lost executor costs few rounds. Distinct
rows of at most HELD shards meet in one task, which runs the rounds by the same
code: there a level takes less than a job. A model is at most
rounds x 2^(depth + 1) numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ventana.models import shards
from ventana.models.base import LABEL, PRED, Fitted, Spec
from ventana.session import checkpoint_dir

MAX_BINS, FOLD, DEEPEST = 255, 10, 12
#: A fit of so many shards' distinct rows is run by one task: about 50 bytes a row.
HELD = 10


@dataclass
class Tree:
    """A complete heap of nodes (children of i: 2 i + 1, 2 i + 2): the feature
    tested (-1: none), the last bin that goes left and the same as a value, and the node's value."""
    feature: np.ndarray
    cut: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(depth: int) -> "Tree":
        n = 2 ** (depth + 1) - 1
        return Tree(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n), np.zeros(n))

    def descend(self, rows: np.ndarray, against: np.ndarray, levels: int) -> np.ndarray:
        """The node of every row after so many steps (earlier at a leaf)."""
        node, n = np.zeros(len(rows), np.int64), np.arange(len(rows))
        if levels and self.feature[0] >= 0:  # the first step is the same for all rows
            node = 1 + (rows[:, self.feature[0]] > against[0])
        for _ in range(levels - 1):
            f = self.feature[node]
            node = np.where(f >= 0, 2 * node + 1 + (rows[n, np.maximum(f, 0)] > against[node]), node)
        return node

    @property
    def depth(self) -> int:
        return len(self.feature).bit_length() - 1

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.value[self.descend(x, self.threshold, self.depth)]

    def predict_bins(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.descend(bins, self.cut, self.depth)]

    @property
    def state(self) -> dict:
        return {k: getattr(self, k).tolist() for k in ("feature", "cut", "threshold", "value")}

    @staticmethod
    def load(state: dict) -> "Tree":
        return Tree(np.array(state["feature"], np.int32), np.array(state["cut"], np.int32), np.array(state["threshold"]), np.array(state["value"]))


@dataclass(frozen=True)
class Rules:
    rounds: int = 100
    rate: float = 0.1
    depth: int = 3
    split: int = 2
    leaf: int = 1


def candidate_cuts(data: DataFrame, xs: list[str]) -> tuple[list[np.ndarray], list[bool]]:
    """Per feature its cut values in order (bin b holds what is above the
    cut before and at most cut b) and whether they are all its values."""
    probs = F.array(*[F.lit((i + 1) / MAX_BINS) for i in range(MAX_BINS)])
    cuts, exact = [], []
    values = dict(zip(xs, few_values(data, xs)))
    rest = [x for x in xs if values[x] is None]
    spread = data.agg(*[F.percentile_approx(x, probs, 100_000).alias(x) for x in rest], *[F.max(x).alias(f"{x}_max") for x in rest]).first() if rest else {}
    for x in xs:
        exact.append(x not in rest)
        cuts.append(np.unique(np.array([*spread[x], spread[f"{x}_max"]] if x in rest else values[x], dtype=np.float64)))
    return cuts, exact


def few_values(data: DataFrame, xs: list[str]) -> list[np.ndarray | None]:
    """Per feature its distinct values, None if they are more than MAX_BINS. No task holds more than it may return."""
    def joined(a: np.ndarray | None, b: np.ndarray | None) -> np.ndarray | None:
        if a is None or b is None:
            return None
        both = np.unique(np.concatenate([a, b]))
        return None if len(both) > MAX_BINS else both

    def part(batches):
        got = [np.empty(0) for _ in xs]
        for batch in batches:
            got = [joined(g, c.to_numpy(zero_copy_only=False).astype(np.float64)) for g, c in zip(got, batch.columns)]
        yield pa.RecordBatch.from_pydict({"x": pa.array(range(len(xs)), pa.int32()), "few": pa.array([None if g is None else g.tobytes() for g in got], pa.binary())})

    found = data.select(*xs).mapInArrow(part, "x int, few binary").rdd.map(lambda r: (r.x, None if r.few is None else np.frombuffer(r.few)))
    tasks = min(len(xs), max(1, data.sparkSession.sparkContext.defaultParallelism))
    few = found.reduceByKey(joined, tasks).map(lambda kv: (kv[0], None if kv[1] is None else kv[1].tobytes()))
    got = {r.x: None if r.few is None else np.frombuffer(r.few) for r in data.sparkSession.createDataFrame(few, "x int, few binary", verifySchema=False).collect()}
    return [got.get(i, np.empty(0)) for i in range(len(xs))]


def sums_of(bins: np.ndarray, node: np.ndarray, base: int, nodes: int, width: int, weight: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """Per feature (weights, residuals) by node and bin, of the rows that have reached the level, and the squares by node."""
    here = np.flatnonzero(node >= base)
    if len(here) == len(node):
        at, w, r = node - base, weight, residual
    else:
        at, w, r, bins = node[here] - base, weight[here], residual[here], bins[here]
    p, cells, wr = bins.shape[1], nodes * width, w * r
    out = np.empty((p, 2 * cells + nodes))
    out[:, 2 * cells:] = np.bincount(at, wr * r, nodes)
    at = at * width
    for j in range(p):
        cell = at + bins[:, j]
        out[j, :cells] = np.bincount(cell, w, cells)
        out[j, cells:2 * cells] = np.bincount(cell, wr, cells)
    return out


#: What the driver is told of a feature at a node: the node's weight, sum and squares; the best gain, its bin, the next
#: bin that holds rows, weight and sum up to the bin.
N, S, SQUARES, GAIN, BIN, NEXT, NL, SL = range(8)


def best_cuts(sums: np.ndarray, nodes: int, width: int, leaf: int) -> np.ndarray:
    """One feature's best cut of every node (rows) by its sums; the gain is -1 where there is none."""
    cells, k = nodes * width, np.arange(nodes)
    weight, total = sums[:cells].reshape(nodes, width), sums[cells:2 * cells].reshape(nodes, width)
    nl, sl = weight.cumsum(axis=1), total.cumsum(axis=1)
    n, s = weight.sum(axis=1), total.sum(axis=1)
    nr, sr = n[:, None] - nl, s[:, None] - sl
    able = (weight > 0) & (nl >= max(1, leaf)) & (nr >= max(1, leaf))
    gain = np.where(able, nl * nr / np.maximum(n, 1)[:, None] * (sl / np.maximum(nl, 1) - sr / np.maximum(nr, 1)) ** 2, -1.0)
    best = gain.max(axis=1)
    # sums differ in their last digits with the order of adding: near equals are equal, the first counts
    at = np.argmax(gain >= (best - 1e-10 * np.abs(best))[:, None], axis=1)
    above = np.argmax((weight > 0) & (np.arange(width) > at[:, None]), axis=1)
    return np.column_stack([n, s, sums[2 * cells:], best, at, above, nl[k, at], sl[k, at]])


def level_cuts(rdd: RDD, rows_of, level: int, p: int, width: int, leaf: int) -> np.ndarray:
    """The best cut by feature and node of a level. ``rows_of(shard)``: bins,
    node, weight and residual of its rows. Features are added up and judged
    apart, in tasks of their own: the driver gets eight numbers each and no sums."""
    nodes = 2 ** level

    def part(some):
        got = None
        for shard in some:
            bins, node, weight, residual = rows_of(shard)
            now = sums_of(bins, node, nodes - 1, nodes, width, weight, residual)
            got = now if got is None else got + now
        return [] if got is None else enumerate(got)

    sums = rdd.mapPartitions(part)
    if rdd.getNumPartitions() > 1:
        size = 16 * p * nodes * width * rdd.getNumPartitions()
        sums = sums.reduceByKey(np.add, max(1, min(p, rdd.context.defaultParallelism, size >> 22)))
    return np.stack([best for _, best in sorted(sums.mapValues(lambda v: best_cuts(v, nodes, width, leaf)).collect(), key=lambda kv: kv[0])])


def grow(tree: Tree, level: int, best: np.ndarray, cuts: list[np.ndarray], exact: list[bool], rules: Rules) -> bool:
    """Cuts the level's nodes by the features' best cuts; whether any was cut."""
    base, grown = 2 ** level - 1, False
    for k in range(2 ** level):
        node, (n, s, squares) = base + k, best[0, k, :GAIN]
        if n == 0:
            continue
        tree.value[node] = s / n
        spread = squares / n - (s / n) ** 2
        if n < max(2, rules.split) or spread <= 1e-14 * max(1.0, squares / n):
            continue
        gain = best[:, k, GAIN]
        if gain.max() <= 1e-14 * max(1.0, squares):
            continue
        f = int(np.argmax(gain >= gain.max() * (1 - 1e-10)))
        b, above = int(best[f, k, BIN]), int(best[f, k, NEXT])
        tree.feature[node], tree.cut[node] = f, b
        tree.threshold[node] = cuts[f][b]
        if exact[f]:
            tree.threshold[node] = (cuts[f][b] + cuts[f][above]) / 2
            # values between the two, which no row of the sums holds, go where the threshold sends them
            tree.cut[node] = np.searchsorted(cuts[f], tree.threshold[node], "right") - 1
        nl, sl = best[f, k, NL], best[f, k, SL]
        tree.value[2 * node + 1], tree.value[2 * node + 2] = sl / nl, (s - sl) / (n - nl)
        grown = True
    return grown


Shard = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # bins, target, weight, running prediction


def binned(data: DataFrame, p: int, cuts: list[np.ndarray]) -> RDD:
    """(bins, target, weight, number) per shard."""
    def cut(shard: tuple) -> tuple:
        x, y, w, number = shard
        return np.asfortranarray(np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)]).astype(np.uint8)), y, w, number

    return shards.packed(data, p).map(cut)


def boost(data: DataFrame, p: int, start: float, rules: Rules, small: bool) -> list[Tree]:
    """``data``: what ``shards.sharded`` gives; ``small``: one task runs the rounds."""
    cuts, exact = known_cuts(data, p)
    checkpoint_dir(data.sparkSession)
    rows = binned(data, p, cuts)
    if small:
        return shards.in_one_task(rows, lambda s: s[3], lambda some: rounds(some, p, start, cuts, exact, rules))
    return rounds(rows, p, start, cuts, exact, rules)


def known_cuts(data: DataFrame, p: int) -> tuple[list[np.ndarray], list[bool]]:
    return shards.known(data, "cuts", lambda: candidate_cuts(data, [f"x{i}" for i in range(p)]))


def rounds(rows: RDD | shards.Held, p: int, start: float, cuts: list[np.ndarray], exact: list[bool], rules: Rules) -> list[Tree]:
    width = max(len(c) for c in cuts)
    rdd = rows.map(lambda s: (s[0], s[1], s[2], np.full(len(s[1]), start))).persist(StorageLevel.MEMORY_AND_DISK)
    old: list = []
    trees: list[Tree] = []
    try:
        for t in range(rules.rounds):
            tree = Tree.of(rules.depth)
            for level in range(rules.depth):
                best = level_cuts(rdd, _level(tree, level), level, p, width, rules.leaf)
                if not grow(tree, level, best, cuts, exact, rules):
                    break
            trees.append(tree)
            if tree.feature[0] < 0:  # nothing left to learn: so would be every later round
                break
            if t + 1 < rules.rounds:
                # made by the next round's first job, from the one before; that one is let go a round later
                old.append(rdd)
                rdd = rdd.map(_advance(tree, rules.rate)).persist(StorageLevel.MEMORY_AND_DISK)
                if len(trees) % FOLD == 0:
                    rdd.checkpoint()
                    rdd.count()
                while len(old) > 1:
                    old.pop(0).unpersist()
    finally:
        for each in (*old, rdd):
            each.unpersist()
    return trees


def _level(tree: Tree, level: int):
    def run(shard: Shard) -> tuple:
        bins, y, w, now = shard
        return bins, tree.descend(bins, tree.cut, level), w, y - now
    return run


def _advance(tree: Tree, rate: float):
    def run(shard: Shard) -> Shard:
        bins, y, w, now = shard
        return bins, y, w, now + rate * tree.predict_bins(bins)
    return run


class GradientBoosting(Spec):
    """100 x 0.1 x depth 3 unless told otherwise. Missing values in the
    training rows raise; a row to be scored with one has no prediction."""
    name = "gradient_boosting"
    allowed = frozenset({"n_estimators", "learning_rate", "max_depth", "min_samples_split", "min_samples_leaf", "shard_rows", "seed"})

    def rules(self) -> Rules:
        p = self.params
        depth = int(p.get("max_depth", 3))
        if not 1 <= depth <= DEEPEST:
            raise ValueError(f"max_depth must be 1 to {DEEPEST}")
        return Rules(int(p.get("n_estimators", 100)), float(p.get("learning_rate", 0.1)), depth, int(p.get("min_samples_split", 2)),
                     int(p.get("min_samples_leaf", 1)))

    def effective(self) -> tuple:
        return (self.rules(),)

    def fit(self, df: DataFrame, features: list[str], label: str = LABEL) -> Fitted:
        rules = self.rules()
        size = int(self.params.get("shard_rows", shards.SHARD_ROWS))
        data, n, _ = shards.sharded(df, features, label, size)
        try:
            if not n:
                raise ValueError("no training rows")
            start, held = data.agg(F.sum(F.col("w") * F.col("y")) / F.sum("w"), F.count(F.lit(1))).first()
            return Boosted(float(start), rules.rate, boost(data, len(features), float(start), rules, held <= HELD * size), list(features), self.name)
        finally:
            shards.release(data)


class Boosted(Fitted):
    """The start and the trees; prediction in Arrow batches."""

    def __init__(self, start: float, rate: float, trees: list[Tree], features: list[str], name: str = "gradient_boosting"):
        self.start, self.rate, self.trees, self.features, self.name, self.output_col = start, rate, trees, features, name, PRED

    @property
    def state(self) -> dict:
        return {"start": self.start, "rate": self.rate, "trees": [t.state for t in self.trees]}

    @staticmethod
    def of(state: dict, features: list[str], name: str) -> "Boosted":
        return Boosted(state["start"], state["rate"], [Tree.load(t) for t in state["trees"]], features, name)

    def values(self, x: np.ndarray, rounds: int | None = None) -> np.ndarray:
        """Predictions after so many rounds (all: None); NaN where a feature is missing."""
        out = np.full(len(x), self.start)
        for tree in self.trees[:rounds]:
            out += self.rate * tree.predict(x)
        return np.where(np.isnan(x).any(axis=1), np.nan, out)

    def transform(self, df: DataFrame) -> DataFrame:
        me, feats, out = Boosted(self.start, self.rate, self.trees, self.features), self.features, self.output_col
        schema = T.StructType([f for f in df.schema.fields if f.name != out] + [T.StructField(out, T.DoubleType())])

        def score(batches):
            for pdf in batches:
                v = me.values(pdf[feats].to_numpy(dtype=np.float64))
                pdf[out] = pd.Series(np.nan_to_num(v), index=pdf.index, dtype="Float64").mask(np.isnan(v))
                yield pdf[[f.name for f in schema.fields]]
        return df.mapInPandas(score, schema)
