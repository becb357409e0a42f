"""G2, G11 -- bootstrap forests of full trees, off the driver.

Every tree sees each training row as often as a Poisson draw of the row's
count says (seeds belong to tree and shard, so a recomputed task draws the same
rows), considers all features at every node and grows until its leaves are
pure, ``max_depth`` is reached or ``min_samples_leaf`` stands in the way. Cuts
are those of ``models.boosting``: all values of a feature, or MAX_BINS
quantiles, and of equal gains the first counts.

1. Top. While a node holds more than LOCAL_ROWS distinct rows, its cut is found
   from histograms: every partition adds up its rows' counts, sums and rows per
   tree, node, feature and bin; a feature's sums meet in one task, which tells
   the driver the best cut. The driver holds these top nodes alone, at most
   about rows / LOCAL_ROWS of a tree. GROUP_CELLS bounds the histograms that a
   task holds: as many nodes as fit are cut in one job.
2. Bodies. The rows of a smaller node meet in one task by (tree, node), which
   grows all that is below, level by level in numpy: its cells (node, bin) are
   sorted, never laid out as a table of nodes x bins. A body is written to the
   shared folder as it is made; none comes to the driver.
3. Scores. Distinct rows are sent through the tops and meet the bodies by
   (tree, node); a task holds one body at a time and the rows stream by. The sums
   of a row over the trees are joined back by two 64-bit hashes of its features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventana.models import shards
from ventana.models.base import LABEL, PRED, Fitted, Spec
from ventana.models.boosting import BIN, GAIN, NEXT, NL, N, SL, binned, best_cuts, known_cuts
from ventana.session import materialise

#: Distinct rows of a node that one task grows to the end; cells of histograms that a task holds; bodies of a file; rows of a block to be scored.
LOCAL_ROWS, GROUP_CELLS, FILE_BODIES, BLOCK_ROWS = 50_000, 8_000_000, 64, 8192
BODY = "tree int, node int, feature binary, threshold binary, left binary, value binary"


@dataclass
class Nodes:
    """A tree or a part of one: the feature tested (-1: none), the largest value
    that goes left, the left child (the right one follows it) and the node's value."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        at, going = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(going):
            f = self.feature[at[going]]
            going, f = going[f >= 0], f[f >= 0]
            here = at[going]
            at[going] = self.left[here] + (x[going, f] > self.threshold[here])
        return at

    def packed(self) -> list[bytes]:
        return [self.feature.astype(np.int16).tobytes(), self.threshold.astype(np.float64).tobytes(), self.left.astype(np.int32).tobytes(), self.value.astype(np.float64).tobytes()]

    @staticmethod
    def unpacked(feature: bytes, threshold: bytes, left: bytes, value: bytes) -> "Nodes":
        return Nodes(np.frombuffer(feature, np.int16), np.frombuffer(threshold), np.frombuffer(left, np.int32), np.frombuffer(value))


@dataclass
class Top:
    """The nodes of a tree that the driver knows; ``large`` are to be cut by
    histograms (node: depth), ``small`` have a body."""
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    large: dict[int, int] = field(default_factory=dict)
    small: dict[int, int] = field(default_factory=dict)

    def by_value(self) -> Nodes:
        return Nodes(np.array(self.feature), np.array(self.threshold), np.array(self.left), np.array(self.value))

    def by_bin(self) -> Nodes:
        return Nodes(np.array(self.feature), np.array(self.cut), np.array(self.left), np.array(self.value))


@dataclass(frozen=True)
class Limits:
    trees: int
    depth: int
    leaf: int
    seed: int
    local_rows: int = LOCAL_ROWS


def taken(weight: np.ndarray, seed: int, tree: int, shard: int) -> np.ndarray:
    """How often a tree sees each row of a shard: the bootstrap of ``weight`` equal rows each."""
    return np.random.default_rng([seed, tree, shard]).poisson(weight).astype(np.float64)


def threshold_of(cuts: np.ndarray, exact: bool, b: int, above: int) -> float:
    return float((cuts[b] + cuts[above]) / 2 if exact else cuts[b])


def grow_body(bins: np.ndarray, y: np.ndarray, w: np.ndarray, cuts: list[np.ndarray], exact: list[bool], depth: int, leaf: int) -> Nodes:
    """The whole tree of the rows (none of weight 0), ``depth`` levels at most."""
    leaf = max(1, leaf)
    p, center = bins.shape[1], float(w @ y / w.sum())
    y, columns = y - center, [np.ascontiguousarray(bins[:, j]).astype(np.int64) for j in range(p)]
    rows, k = np.arange(len(y)), np.zeros(len(y), np.int64)  # the rows by node, and their node's place in the level
    parts: list[tuple] = []
    made = 1
    while True:
        first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        yy, ww = y[rows], w[rows]
        n, s = np.add.reduceat(ww, first), np.add.reduceat(ww * yy, first)
        count = len(first)
        feature, threshold, left = np.full(count, -1, np.int64), np.zeros(count), np.full(count, -1, np.int64)
        parts.append((feature, threshold, left, s / n + center))
        able = (np.maximum.reduceat(yy, first) > np.minimum.reduceat(yy, first)) & (n >= 2 * leaf)
        if depth <= 0 or not able.any():
            break
        depth -= 1
        stay, place = able[k], np.flatnonzero(able)
        rows, k, yy, ww = rows[stay], (np.cumsum(able) - 1)[k[stay]], yy[stay], ww[stay]
        count, n, s = len(place), n[able], s[able]
        wy = ww * yy
        best = 1e-14 * np.maximum(1.0, np.add.reduceat(wy * yy, np.flatnonzero(np.r_[True, k[1:] != k[:-1]])))
        by, at, above = np.full(count, -1, np.int64), np.zeros(count, np.int64), np.zeros(count, np.int64)
        for j in range(p):
            shift = max(1, (len(cuts[j]) - 1).bit_length())
            cell, cells = (k << shift) + columns[j][rows], count << shift
            if cells <= 4 * len(rows):
                cw, cs = np.bincount(cell, ww, cells), np.bincount(cell, wy, cells)
                name = np.flatnonzero(cw > 0)
                cw, cs = cw[name], cs[name]
            else:
                order = np.argsort(cell, kind="stable")  # the rows are in their nodes' order: runs are merged
                cell = cell[order]
                start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
                name, cw, cs = cell[start], np.add.reduceat(ww[order], start), np.add.reduceat(wy[order], start)
            node = name >> shift
            begin = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            if len(begin) == len(name):  # the feature has one value in every node
                continue
            nl, sl = np.cumsum(cw), np.cumsum(cs)
            nl, sl = nl - (nl[begin] - cw[begin])[node], sl - (sl[begin] - cs[begin])[node]
            whole, total = n[node], s[node]
            nr, sr = whole - nl, total - sl
            able = np.r_[node[1:] == node[:-1], False] & (nl >= leaf) & (nr >= leaf)
            gain = np.where(able, nl * nr / whole * (sl / nl - sr / np.maximum(nr, 1)) ** 2, -1.0)
            most = np.maximum.reduceat(gain, begin)
            better = most > best * (1 + 1e-10)
            if better.any():
                # sums differ in their last digits with the order of adding: near equals are equal, the first counts
                cut = np.minimum.reduceat(np.where(gain >= (most * (1 - 1e-10))[node], np.arange(len(name)), len(name)), begin)[better]
                best[better], by[better], at[better], above[better] = most[better], j, name[cut] & ((1 << shift) - 1), name[cut + 1] & ((1 << shift) - 1)
        split = np.flatnonzero(by >= 0)
        if not len(split):
            break
        feature[place[split]] = by[split]
        threshold[place[split]] = [threshold_of(cuts[f], exact[f], b, a) for f, b, a in zip(by[split], at[split], above[split])]
        left[place[split]] = made + 2 * np.arange(len(split))
        made += 2 * len(split)
        stay = (by >= 0)[k]
        rows, k = rows[stay], k[stay]
        right = bins[rows, by[k]] > at[k]
        k = 2 * (np.cumsum(by >= 0) - 1)[k] + right
        order = np.argsort(k, kind="stable")
        rows, k = rows[order], k[order]
    return Nodes(*[np.concatenate(x) for x in zip(*parts)])


def top_level(rdd: RDD, tops: list[Top], job: list[tuple[int, int]], p: int, width: int, limits: Limits) -> dict:
    """For the nodes (tree, node) of ``job``: per feature what ``best_cuts`` says and the distinct rows up to the cut."""
    nodes: dict[int, list[int]] = {}
    for tree, node in job:
        nodes.setdefault(tree, []).append(node)
    maps = {tree: (tops[tree].by_bin(), np.array(some)) for tree, some in nodes.items()}

    def part(some):
        got: dict[tuple[int, int], np.ndarray] = {}
        for bins, y, weight, shard in some:
            columns = [np.ascontiguousarray(bins[:, j]).astype(np.int64) for j in range(p)]
            for tree, (top, wanted) in maps.items():
                w = taken(weight, limits.seed, tree, shard)
                place = np.full(len(top.feature), -1)
                place[wanted] = np.arange(len(wanted))
                at = place[top.leaves(bins)]
                here = np.flatnonzero((at >= 0) & (w > 0))
                at, ww, cells = at[here], w[here], len(wanted) * width
                wy = ww * y[here]
                squares, at = np.bincount(at, wy * y[here], len(wanted)), at * width
                for j in range(p):
                    cell = at + columns[j][here]
                    now = np.concatenate([np.bincount(cell, ww, cells), np.bincount(cell, wy, cells), squares, np.bincount(cell, None, cells)])
                    got[tree, j] = got[tree, j] + now if (tree, j) in got else now
        return got.items()

    def judge(item):
        (tree, j), sums = item
        count = len(nodes[tree])
        cells = count * width
        best = best_cuts(sums[:2 * cells + count], count, width, limits.leaf)
        held = sums[2 * cells + count:].reshape(count, width)
        return (tree, j), np.column_stack([best, held.cumsum(axis=1)[np.arange(count), best[:, BIN].astype(int)], held.sum(axis=1)])

    sums = rdd.mapPartitions(part).reduceByKey(np.add, max(1, min(p * len(nodes), rdd.context.defaultParallelism)))
    told = dict(sums.map(judge).collect())
    return {(tree, node): np.stack([told[tree, j][i] for j in range(p)]) for tree, some in nodes.items() for i, node in enumerate(some) if (tree, 0) in told}


def cut_top(top: Top, node: int, told: np.ndarray, cuts: list[np.ndarray], exact: list[bool], limits: Limits) -> None:
    depth = top.large.pop(node)
    n, s, squares = told[0, :GAIN]
    rows = told[0, -1]
    top.value[node] = float(s / n) if n else 0.0
    gain = told[:, GAIN]
    pure = n == 0 or squares / n - (s / n) ** 2 <= 1e-14 * max(1.0, squares / n)
    if pure or depth >= limits.depth or gain.max() <= 1e-14 * max(1.0, squares):
        return
    f = int(np.argmax(gain >= gain.max() * (1 - 1e-10)))
    b, above = int(told[f, BIN]), int(told[f, NEXT])
    top.feature[node], top.cut[node], top.threshold[node], top.left[node] = f, b, threshold_of(cuts[f], exact[f], b, above), len(top.feature)
    nl, sl, below = told[f, NL], told[f, SL], told[f, -2]
    for count, total, held in ((nl, sl, below), (n - nl, s - sl, rows - below)):
        child = len(top.feature)
        top.feature.append(-1), top.cut.append(0), top.threshold.append(0.0), top.left.append(-1), top.value.append(float(total / count))
        if depth + 1 < limits.depth and count >= 2 * limits.leaf:
            (top.large if held > limits.local_rows else top.small)[child] = depth + 1


def grow_forest(data: DataFrame, p: int, limits: Limits) -> tuple[list[Top], DataFrame]:
    """The tops and the bodies of all trees; ``data``: what ``shards.sharded`` gives."""
    spark = data.sparkSession
    cuts, exact = known_cuts(data, p)
    width = max(len(c) for c in cuts)
    # the distinct rows that a tree may be expected to draw
    held = data.agg(F.sum(1 - F.exp(-F.col("w")))).first()[0]
    tops = [Top() for _ in range(limits.trees)]
    for top in tops:
        (top.large if held > limits.local_rows else top.small)[0] = 0
    rdd = binned(data, p, cuts).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        while any(top.large for top in tops):
            todo = [(tree, node) for tree, top in enumerate(tops) for node in top.large]
            job = todo[:max(1, GROUP_CELLS // (3 * p * width))]
            told = top_level(rdd, tops, job, p, width, limits)
            for tree, node in job:
                if (tree, node) in told:
                    cut_top(tops[tree], node, told[tree, node], cuts, exact, limits)
                else:  # the tree has drawn no row
                    tops[tree].small[node] = tops[tree].large.pop(node)
        bodies = bodies_of(spark, rdd, tops, cuts, exact, limits)
        total, mean = data.agg(F.sum("w"), F.sum(F.col("w") * F.col("y")) / F.sum("w")).first()
        if total < 1000:  # a tree may have drawn no row at all: it knows the mean
            grown = {r.tree for r in bodies.select("tree").collect()}
            for tree, top in enumerate(tops):
                if 0 in top.small and tree not in grown:
                    top.small, top.value = {}, [float(mean)]
        return tops, bodies
    finally:
        rdd.unpersist()


def bodies_of(spark: SparkSession, rdd: RDD, tops: list[Top], cuts: list[np.ndarray], exact: list[bool], limits: Limits) -> DataFrame:
    keys = {key: i for i, key in enumerate((tree, node) for tree, top in enumerate(tops) for node in top.small)}
    depths = {(tree, node): depth for tree, top in enumerate(tops) for node, depth in top.small.items()}
    maps = [(top.by_bin(), np.array(sorted(top.small), dtype=np.int64)) for top in tops]

    def send(shard):
        bins, y, weight, number = shard
        for tree, (top, small) in enumerate(maps):
            w = taken(weight, limits.seed, tree, number)
            at = np.where(w > 0, top.leaves(bins), -1)
            order = np.argsort(at, kind="stable")
            begin, end = np.searchsorted(at[order], small, "left"), np.searchsorted(at[order], small, "right")
            for node, a, b in zip(small.tolist(), begin, end):
                if b > a:
                    some = order[a:b]
                    yield (tree, node), (number, bins[some], y[some], w[some])

    def body(item):
        key, blocks = item
        blocks = sorted(blocks, key=lambda b: b[0])
        bins, y, w = (np.concatenate([b[i] for b in blocks]) for i in (1, 2, 3))
        return (*key, *grow_body(bins, y, w, cuts, exact, limits.depth - depths[key], limits.leaf).packed())

    tasks = max(1, min(len(keys), max(4 * rdd.context.defaultParallelism, -(-len(keys) // FILE_BODIES))))
    grown = rdd.flatMap(send).groupByKey(tasks, lambda key: keys[key]).map(body)
    return materialise(spark, spark.createDataFrame(grown, BODY, verifySchema=False), "forest")[0]


class Forest(Spec):
    """The limits of a forest come from the classes below."""

    def limits(self) -> Limits:  # pragma: no cover - interface
        raise NotImplementedError

    def effective(self) -> tuple:
        return (self.limits(),)

    def fit(self, df: DataFrame, features: list[str], label: str = LABEL) -> Fitted:
        data, n, _ = shards.sharded(df, features, label)
        try:
            if not n:
                raise ValueError("no training rows")
            tops, bodies = grow_forest(data, len(features), self.limits())
            return FittedForest(tops, bodies, list(features), self.name)
        finally:
            shards.release(data)


class FittedForest(Fitted):
    """Tops here, bodies in the shared folder. A missing feature is an error."""

    def __init__(self, tops: list[Top], bodies: DataFrame, features: list[str], name: str):
        self.tops, self.bodies, self.features, self.name, self.output_col = tops, bodies, features, name, PRED

    @property
    def state(self) -> list[dict]:
        return [{"feature": t.feature, "cut": t.cut, "threshold": t.threshold, "left": t.left, "value": t.value, "small": sorted(t.small.items())} for t in self.tops]

    @staticmethod
    def of(state: list[dict], bodies: DataFrame, features: list[str], name: str) -> "FittedForest":
        return FittedForest([Top(t["feature"], t["cut"], t["threshold"], t["left"], t["value"], {}, {int(k): int(d) for k, d in t["small"]}) for t in state], bodies, features, name)

    def transform(self, df: DataFrame) -> DataFrame:
        feats, out = self.features, self.output_col
        kept = [F.col(f"`{c}`") for c in df.columns if c != out]
        full = [F.col(f"`{c}`").cast("double") + F.lit(0.0) for c in feats]  # one zero
        missing = F.greatest(*[(x.isNull() | F.isnan(x)).cast("int") for x in full], F.lit(0), F.lit(0)) == 1
        error = F.raise_error(F.lit(f"{self.name}: a row to be scored has missing values; impute them first"))
        h, g = F.xxhash64(*full), F.xxhash64(F.lit(1), *reversed(full))
        keyed = df.select(*kept, F.when(missing, error.cast("long")).otherwise(h).alias("_h"), g.alias("_g"))
        scores = self.scores(df.select(F.when(missing, error.cast("long")).otherwise(h).alias("_h"), g.alias("_g"), *[x.alias(f"_x{i}") for i, x in enumerate(full)]))
        return keyed.join(scores.withColumnRenamed("_p", out), ["_h", "_g"], "left").select(*kept, out)

    def scores(self, rows: DataFrame) -> DataFrame:
        """``_h, _g, _p`` of the distinct rows ``_h, _g, _x0..``."""
        spark, p, trees = rows.sparkSession, len(self.features), len(self.tops)
        # by hash and in order: a recomputed task makes the same blocks
        asked = rows.dropDuplicates(["_h", "_g"]).sortWithinPartitions("_h", "_g")

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number, where = 0, TaskContext.get().partitionId()
            for batch in batches:
                for begin in range(0, batch.num_rows, BLOCK_ROWS):
                    b = batch.slice(begin, BLOCK_ROWS)
                    h, g, *xs = (c.to_numpy(zero_copy_only=False) for c in b.columns)
                    x = np.column_stack(xs).astype(np.float64)
                    yield pa.RecordBatch.from_pydict({"part": pa.array([where], pa.int32()), "number": pa.array([number], pa.int32()), "h": [h.astype(np.int64).tobytes()],
                                                      "g": [g.astype(np.int64).tobytes()], "x": [x.tobytes()]})
                    number += 1

        blocks = asked.mapInArrow(pack, "part int, number int, h binary, g binary, x binary").rdd
        keys = {key: i for i, key in enumerate((tree, node) for tree, top in enumerate(self.tops) for node in top.small)}
        maps = [(top.by_value(), np.array(sorted(top.small), dtype=np.int64)) for top in self.tops]
        # few bodies are copied, so that there is a task for every core
        salts = max(1, -(-4 * spark.sparkContext.defaultParallelism // max(1, len(keys))))

        def send(r):
            x = np.frombuffer(r.x).reshape(-1, p)
            base = np.zeros(len(x))
            for tree, (top, small) in enumerate(maps):
                at = top.leaves(x)
                order = np.argsort(at, kind="stable")
                begin, end = np.searchsorted(at[order], small, "left"), np.searchsorted(at[order], small, "right")
                done = np.ones(len(x), bool)
                for node, a, b in zip(small.tolist(), begin, end):
                    if b > a:
                        some = order[a:b]
                        done[some] = False
                        yield (tree, node, (r.part * 31 + r.number) % salts, 1, r.part, r.number), (some.astype(np.int32), x[some])
                base[done] += top.value[at[done]]
            yield (-1, 0, 0, 1, r.part, r.number), (r.h, r.g, base)

        def answer(items):
            body = None
            for (tree, _, _, kind, *block), value in items:
                if kind == 0:
                    body = Nodes.unpacked(*value)
                elif tree < 0:
                    yield tuple(block), value
                else:
                    yield tuple(block), (value[0], body.value[body.leaves(value[1])])

        bodies = self.bodies.rdd.flatMap(lambda r: [((r.tree, r.node, s, 0, 0, 0), (r.feature, r.threshold, r.left, r.value)) for s in range(salts)])
        tasks = max(1, min(len(keys) * salts, max(4 * spark.sparkContext.defaultParallelism, len(keys) // FILE_BODIES)))
        met = blocks.flatMap(send).union(bodies).repartitionAndSortWithinPartitions(
            tasks, lambda k: keys[k[0], k[1]] * salts + k[2] if k[0] >= 0 else k[4] + k[5])

        def rows_of(item):
            values = sorted(item[1], key=len, reverse=True)  # the base (three parts) first
            h, g, total = values[0][0], values[0][1], values[0][2].copy()
            for at, value in values[1:]:
                total[at] += value
            return zip(np.frombuffer(h, np.int64).tolist(), np.frombuffer(g, np.int64).tolist(), (total / trees).tolist())

        found = met.mapPartitions(answer).groupByKey(max(1, min(4 * spark.sparkContext.defaultParallelism, tasks))).flatMap(rows_of)
        return materialise(spark, spark.createDataFrame(found, "_h long, _g long, _p double", verifySchema=False), "forest-scores")[0]
