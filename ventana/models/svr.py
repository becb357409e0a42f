"""G3, G4 -- support vector regression with a certificate.

The objective is ``|w|^2 / 2 + C * sum of the epsilon-insensitive losses``. A
constant feature, large against the others, carries the intercept, so its
share of the penalty is negligible. The loss is smoothed over a width mu; a
Newton step on the smoothed objective needs sums over the rows alone (slope,
and products of the features of the rows within mu of the tube's edge), one
job a step, added up by the executors; what a merge holds and the driver gets
is features x features, once a step. Each step gives a point of the dual as well, whose value
bounds the optimum from below. Mu shrinks until the gap between the best
objective and the best bound is at most ``tol`` of the objective: the rows'
order, shards and partitions do not matter, and the fit says how good it is.
Distinct rows of at most HELD shards meet in one task, which takes the steps by
the same code and keeps its features; else a step makes them anew.

The RBF kernel goes through Nystrom features: landmarks are the training rows
of smallest hash, a row's features its kernel values against them times the
inverse root of the landmarks' kernel matrix (``lift``: only the rows at the
tube's edge are multiplied by it, for the others the weights and the slope are);
the same solver does the rest.
The error of the kernel on other rows is measured and kept with the model
(``state['kernel_error']``); ``n_components`` is the number of landmarks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ventana.models import shards
from ventana.models.base import LABEL, PRED, ExprFitted, Fitted, Spec, lincomb

#: Rows on which the kernel's error is measured.
PROBES = 400
#: A fit of so many shards' distinct rows is run by one task: up to 2 KB a row.
HELD = 5


class Sums:
    """What one pass over the rows gives at ``w`` with smoothing ``mu``."""

    def __init__(self, flat: np.ndarray, w: np.ndarray, C: float, epsilon: float):
        p = len(w)
        smooth, loss, dual_y, dual_size = flat[:4]
        self.slope, self.curve = flat[4:4 + p], flat[4 + p:].reshape(p, p)
        self.smooth = 0.5 * w @ w + C * smooth
        self.primal = 0.5 * w @ w + C * loss
        # the dual point that the residuals name: its weights are the slope
        self.dual = C * (dual_y - epsilon * dual_size) - 0.5 * C * C * self.slope @ self.slope
        self.gradient = w - C * self.slope


def one_pass(k: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray, mu: float, epsilon: float, lift: np.ndarray | None = None) -> np.ndarray:
    """The sums of the rows with features ``k @ lift`` (None: ``k``)."""
    r = y - k @ (w if lift is None else lift @ w)
    over = np.abs(r) - epsilon
    beta = np.sign(r) * np.clip(over / mu, 0.0, 1.0)
    smooth = np.where(over <= 0, 0.0, np.where(over < mu, over * over / (2 * mu), over - mu / 2))
    edge = (over > 0) & (over < mu)
    near = k[edge] if lift is None else k[edge] @ lift
    near = near * np.sqrt(weight[edge] / mu)[:, None]
    slope = (weight * beta) @ k
    sums = [weight @ smooth, weight @ np.maximum(over, 0.0), weight @ (y * beta), weight @ np.abs(beta)]
    return np.concatenate([sums, slope if lift is None else slope @ lift, (near.T @ near).ravel()])


def solve(rows: RDD | shards.Held, turn, lift: np.ndarray | None, p: int, scale: float, C: float, epsilon: float, tol: float, passes: int) -> tuple[np.ndarray, dict]:
    """The weights for ``turn(x) @ lift`` (p columns; None: ``turn(x)``), and
    ``gap``, ``objective``, ``passes``. ``scale``: the smoothing to begin with."""
    def at(w: np.ndarray, mu: float) -> Sums:
        return Sums(shards.added_up(rows, lambda s: one_pass(turn(s[0]), s[1], s[2], w, mu, epsilon, lift)), w, C, epsilon)

    w, mu, done = np.zeros(p), max(scale, 1e-12), 1
    now = at(w, mu)
    best, best_w, bound = now.primal, w, now.dual
    while done < passes and best - bound > tol * max(abs(best), 1e-12):
        step = -np.linalg.solve(C * now.curve + np.eye(p), now.gradient)
        # once the slope is the weights' own to the accuracy asked for, only the smoothing is left
        if 0.5 * now.gradient @ now.gradient <= 0.05 * tol * abs(best):
            mu /= 4
            now = at(w, mu)
            done += 1
        else:
            size, fall = 1.0, -now.gradient @ step
            while done < passes:
                new = at(w + size * step, mu)
                done += 1
                if new.smooth <= now.smooth - 1e-4 * size * fall or size < 1e-6:
                    w, now = w + size * step, new
                    break
                size /= 2
        bound = max(bound, now.dual)
        if now.primal < best:
            best, best_w = now.primal, w
    return best_w, {"objective": float(best), "gap": float((best - bound) / max(abs(best), 1e-12)), "passes": done}


def kernel(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    out = np.empty((len(a), len(b)))
    turned, square = 2 * gamma * b.T, gamma * (b * b).sum(axis=1)
    for i in range(0, len(a), 1024):  # blocks stay in the processor's cache
        some, part = a[i:i + 1024], out[i:i + 1024]
        np.matmul(some, turned, out=part)
        part -= square
        part -= gamma * (some * some).sum(axis=1)[:, None]
        np.exp(np.minimum(part, 0.0, out=part), out=part)
    return out


def inverse_root(k: np.ndarray) -> np.ndarray:
    values, vectors = np.linalg.eigh(k)
    keep = values > 1e-10 * values.max()
    return vectors[:, keep] / np.sqrt(values[keep])


class SVR(Spec):
    """G3 (linear kernel) / G4 (RBF). ``gamma='scale'`` is 1 / (p * Var(X))
    over all feature values, 'auto' is 1 / p. ``rounds`` bounds the passes."""
    name = "svm"
    allowed = frozenset({"C", "epsilon", "kernel", "gamma", "n_components", "rounds", "tol", "seed", "shard_rows"})

    def fit(self, df: DataFrame, features: list[str], label: str = LABEL) -> Fitted:
        get, feats, p = self.params.get, list(features), len(features)
        C, epsilon, tol, passes = float(get("C", 1.0)), float(get("epsilon", 0.1)), float(get("tol", 1e-3)), int(get("rounds", 600))
        data, n, _ = shards.sharded(df, feats, label, int(get("shard_rows", shards.SHARD_ROWS)))
        try:
            if not n:
                raise ValueError("no training rows")
            xs, w = [f"x{i}" for i in range(p)], F.col("w")
            st = data.agg(F.sum(w * F.col("y")) / n, F.sum(w * F.abs(F.col("y"))) / n,
                          *[F.sum(w * F.col(x)) / n for x in xs], *[F.sum(w * F.col(x) * F.col(x)) / n for x in xs]).first()
            mean, center, square = float(st[0]), np.array(st[2:2 + p], float), np.array(st[2 + p:], float)
            scale, gap = max(float(st[1]), 1e-6), (C, epsilon, tol, passes)
            if get("kernel", "rbf") == "linear":
                big = 10 * max(1.0, float(np.sqrt(np.maximum(square - center * center, 0).sum())))
                turn = lambda x: np.column_stack([x - center, np.full(len(x), big)])
                weights, facts = self._solve(data, p, mean, turn, None, p + 1, scale, *gap)
                return linear_svr(weights[:-1], mean + big * weights[-1] - weights[:-1] @ center, 0.0, 1.0, feats, self.name, facts)
            return self._rbf(data, xs, feats, mean, self._gamma(get("gamma", "scale"), center, square), scale, *gap)
        finally:
            shards.release(data)

    def _solve(self, data: DataFrame, p: int, mean: float, turn, lift, width: int, *rest) -> tuple[np.ndarray, dict]:
        rows = shards.packed(data, p).map(lambda s: (s[0], s[1] - mean, s[2], s[3]))
        if data.count() <= HELD * int(self.params.get("shard_rows", shards.SHARD_ROWS)):
            def held(some: shards.Held):
                return solve(some.map(lambda s: (turn(s[0]), *s[1:])), lambda k: k, lift, width, *rest)
            return shards.in_one_task(rows, lambda s: s[3], held)
        rows = rows.cache()
        try:
            return solve(rows, turn, lift, width, *rest)
        finally:
            rows.unpersist()

    @staticmethod
    def _gamma(gamma, center: np.ndarray, square: np.ndarray) -> float:
        p = len(center)
        if gamma == "scale":
            spread = float(square.mean() - center.mean() ** 2)
            return 1.0 / (p * spread) if spread > 0 else 1.0
        return 1.0 / p if gamma == "auto" else float(gamma)

    def _rbf(self, data, xs, feats, mean, gamma, scale, C, epsilon, tol, passes) -> Fitted:
        m, seed = int(self.params.get("n_components", 256)), int(self.params.get("seed", 42))
        # a sample by hash: distinct rows, the same ones however the table is cut
        drawn = data.orderBy(F.xxhash64("h", F.lit(seed)), *xs).limit(m + PROBES).select(*xs).collect()
        some = np.array([list(r) for r in drawn], dtype=np.float64)
        marks, probes = some[:m], some[m:] if len(some) > m else some
        root = inverse_root(kernel(marks, marks, gamma))
        features = kernel(probes, marks, gamma) @ root
        true = kernel(probes, probes, gamma)
        error = float(np.linalg.norm(true - features @ features.T) / np.linalg.norm(true))
        turn = lambda x: np.column_stack([kernel(x, marks, gamma), np.full(len(x), 10.0)])
        lift = np.zeros((len(marks) + 1, root.shape[1] + 1))
        lift[:-1, :-1], lift[-1, -1] = root, 1.0
        weights, facts = self._solve(data, len(feats), mean, turn, lift, root.shape[1] + 1, scale, C, epsilon, tol, passes)
        return KernelSVR(gamma, marks, root @ weights[:-1], mean + 10.0 * weights[-1], feats, self.name, facts | {"kernel_error": error})


def linear_svr(w, b, mu, sd, feats, name, facts: dict | None = None) -> Fitted:
    return ExprFitted(lambda: lincomb(feats, w, b) * F.lit(sd) + F.lit(mu), feats, name,
                      state={"w": list(map(float, w)), "b": float(b), "mu": float(mu), "sd": float(sd)} | (facts or {}))


class KernelSVR(Fitted):
    """Prediction per Arrow batch: kernel values against the landmarks, weighted."""

    def __init__(self, gamma, marks, weights, intercept, features, name, facts: dict | None = None):
        self.gamma, self.marks, self.weights, self.intercept = float(gamma), np.asarray(marks, float), np.asarray(weights, float), float(intercept)
        self.features, self.name, self.output_col = features, name, PRED
        self.state = {"gamma": self.gamma, "marks": self.marks.tolist(), "weights": self.weights.tolist(), "intercept": self.intercept} | (facts or {})

    def transform(self, df: DataFrame) -> DataFrame:
        gamma, marks, weights, b, feats, out = self.gamma, self.marks, self.weights, self.intercept, self.features, self.output_col
        schema = T.StructType([f for f in df.schema.fields if f.name != out] + [T.StructField(out, T.DoubleType())])

        def score(batches):
            for pdf in batches:
                v = kernel(pdf[feats].to_numpy(dtype=np.float64), marks, gamma) @ weights + b
                pdf[out] = pd.Series(np.nan_to_num(v), index=pdf.index, dtype="Float64").mask(np.isnan(v))
                yield pdf[[f.name for f in schema.fields]]
        return df.mapInPandas(score, schema)
