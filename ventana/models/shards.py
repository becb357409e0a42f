"""Data-parallel fitting that does not depend on how the data is partitioned.

Equal training rows are counted once with a weight (so a row that repeats
over a third of the table is one row), and rows are dealt to a fixed number of
shards by a hash of their values. Every round broadcasts the parameters; each
shard improves them on its own rows (read in hash order, with a seed of its
own) and returns its parameters times its weight; one grouped sum averages
them. The same rows give the same fit on any cluster, up to rounding in sums.

The rounds stop once the loss of the averaged parameters no longer falls by
``tol`` of its value, or after ``rounds``; the best parameters seen are kept.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a shard, about: what one Python worker holds at a time.
SHARD_ROWS = 20_000
_LOSS, _WEIGHT = -1, -2


class _Kept:
    """The shards of a frame that several fits share, by size, and what they found out about them."""

    def __init__(self):
        self.lock, self.made, self.facts = threading.RLock(), {}, {}


_KEPT: dict[int, _Kept] = {}


@contextmanager
def shared(df: DataFrame) -> Iterator[DataFrame]:
    """Within it, the fits on this very frame object share its shards, which are made once."""
    if id(df) in _KEPT:
        yield df
        return
    kept = _KEPT[id(df)] = _Kept()
    try:
        yield df
    finally:
        del _KEPT[id(df)]
        for data, _, _ in kept.made.values():
            data.unpersist()


def release(data: DataFrame) -> None:
    """A fit is done with its shards: they go unless other fits share them."""
    if not any(data is made[0] for kept in list(_KEPT.values()) for made in list(kept.made.values())):
        data.unpersist()


def known(data: DataFrame, what: object, find):
    """``find()``, once for shards that are shared."""
    for kept in list(_KEPT.values()):
        if any(data is made[0] for made in list(kept.made.values())):
            with kept.lock:
                key = (id(data), what)
                if key not in kept.facts:
                    kept.facts[key] = find()
                return kept.facts[key]
    return find()


def sharded(df: DataFrame, features: list[str], label: str, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int, int]:
    """``shard, h, x0.., y, w`` (cached), the number of rows, and of shards."""
    kept = _KEPT.get(id(df))
    if kept is None:
        return _sharded(df, features, label, shard_rows)
    with kept.lock:
        key = (tuple(features), label, shard_rows)
        if key not in kept.made:
            kept.made[key] = _sharded(df, features, label, shard_rows)
        return kept.made[key]


def _sharded(df: DataFrame, features: list[str], label: str, shard_rows: int) -> tuple[DataFrame, int, int]:
    xs = [f"x{i}" for i in range(len(features))]
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(x) for c, x in zip(features, xs)], F.col(label).cast("double").alias("y"))
    holes = sum((F.count_if(F.col(c).isNull() | F.isnan(c)) for c in [*xs, "y"]), F.lit(0))
    size = rows.agg(F.count(F.lit(1)).alias("n"), holes.alias("holes")).first()
    if size.n and size.holes:
        raise ValueError(f"{size.holes} missing values in the training rows; impute them first")
    shards = max(1, -(-size.n // shard_rows))
    out = rows.groupBy(*xs, "y").agg(F.count(F.lit(1)).alias("w")).withColumn("h", F.xxhash64(*xs, "y"))
    out = out.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int")).repartition(shards, "shard")
    return out.cache(), size.n, shards


def packed(data: DataFrame, p: int) -> RDD:
    """``data`` as (features, labels, weights, number) per shard, rows in hash order."""
    xs = [f"x{i}" for i in range(p)]

    def pack(pdf):
        import pandas as pd
        pdf = pdf.sort_values(["h", *xs, "y"])
        return pd.DataFrame({"shard": pdf["shard"].iloc[:1].to_numpy(), "n": [len(pdf)], "x": [pdf[xs].to_numpy(np.float64).tobytes()], "y": [pdf["y"].to_numpy(np.float64).tobytes()],
                             "w": [pdf["w"].to_numpy(np.float64).tobytes()]})

    got = data.groupBy("shard").applyInPandas(pack, "shard int, n long, x binary, y binary, w binary")
    rdd = got.rdd.map(lambda r: (np.frombuffer(r.x).reshape(r.n, p), np.frombuffer(r.y), np.frombuffer(r.w), r.shard))
    # a task takes its shards one after another: no more tasks a job than run at a time
    return rdd.coalesce(min(rdd.getNumPartitions(), max(1, rdd.context.defaultParallelism)))


class Held:
    """Shards that one task holds, with what the fits ask of an RDD: a small
    fit runs from end to end in a task, by the code that else is a job a step."""

    def __init__(self, items):
        self.items = list(items)

    def getNumPartitions(self) -> int:  # noqa: N802 -- an RDD's names
        return 1

    def map(self, f) -> "Held":
        return Held(f(x) for x in self.items)

    def mapPartitions(self, f) -> "Held":  # noqa: N802
        return Held(f(iter(self.items)))

    def mapValues(self, f) -> "Held":  # noqa: N802
        return Held((k, f(v)) for k, v in self.items)

    def values(self) -> "Held":
        return Held(v for _, v in self.items)

    def collect(self) -> list:
        return list(self.items)

    def treeReduce(self, f):  # noqa: N802
        return reduce(f, self.items)

    def count(self) -> int:
        return len(self.items)

    def persist(self, *_) -> "Held":
        return self

    def unpersist(self) -> "Held":
        return self

    def checkpoint(self) -> None:
        pass


def in_one_task(rdd: RDD, number, fit):
    """``fit(shards)``, run by one task that holds all shards in order of ``number(shard)``."""
    return rdd.map(lambda s: (0, s)).groupByKey(1).map(lambda kv: fit(Held(sorted(kv[1], key=number)))).collect()[0]


def added_up(rdd: RDD | Held, of) -> np.ndarray:
    """The sum of ``of(shard)``, made by the executors: the driver gets one array."""
    def part(some):
        got = None
        for shard in some:
            now = of(shard)
            got = now if got is None else got + now
        return [] if got is None else [(0, got)]

    sums = rdd.mapPartitions(part)
    return (sums if rdd.getNumPartitions() == 1 else sums.reduceByKey(np.add, 1)).values().collect()[0]


def batch_of(rows: int, w: np.ndarray) -> int:
    """How many weighted rows stand for a mini-batch of ``rows`` rows, so that
    an epoch has as many steps as without the counting of equal rows."""
    return max(1, min(len(w), round(rows * len(w) / max(1.0, float(w.sum())))))


def fit(data: DataFrame, p: int, theta: np.ndarray, improve, loss, rounds: int, tol: float) -> tuple[np.ndarray, list[float]]:
    """``improve(X, y, w, theta, round, shard) -> theta``;
    ``loss(X, y, w, theta) -> weighted sum``. Returns the best parameters and
    the losses per round."""
    spark = data.sparkSession
    xs = [f"x{i}" for i in range(p)]
    history: list[float] = []
    best, worse = theta, 0
    for r in range(rounds + 1):
        shared = spark.sparkContext.broadcast(theta)

        def local(key, pdf):
            import pandas as pd
            pdf = pdf.sort_values(["h", *xs, "y"])
            X, y, w = pdf[xs].to_numpy(dtype=np.float64), pdf["y"].to_numpy(dtype=np.float64), pdf["w"].to_numpy(dtype=np.float64)
            now = shared.value
            new = improve(X, y, w, now.copy(), r, int(key[0])) if r < rounds else now
            return pd.DataFrame({"i": np.concatenate([np.arange(len(new)), [_LOSS, _WEIGHT]]).astype(np.int32),
                                 "v": np.concatenate([new * w.sum(), [loss(X, y, w, now), w.sum()]])})

        got = {x.i: x.v for x in data.groupBy("shard").applyInPandas(local, "i int, v double")
               .groupBy("i").agg(F.sum("v").alias("v")).collect()}
        shared.unpersist()
        if not got:
            return theta, history
        mean = got[_LOSS] / got[_WEIGHT]
        if not history or mean < min(history):
            best = theta
        worse = worse + 1 if history and min(history) - mean < tol * abs(min(history)) else 0
        history.append(mean)
        if worse >= 3:
            break
        theta = np.array([got[i] for i in range(len(theta))]) / got[_WEIGHT]
    return best, history
