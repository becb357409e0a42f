"""G6/G7 -- multi-layer perceptron regressor, data-parallel.

Each round (``models.shards``) broadcasts the parameters; every shard runs
local Adam mini-batch epochs over its own rows in numpy; one grouped sum
averages the results, so only a parameter vector (model-sized, not data-sized)
reaches the driver. Rounds stop when the loss settles. G7 is the same job with
one pass per round after the first (warm start). Prediction runs on Arrow
batches; a row with a missing feature has none.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ventana.models import shards
from ventana.models.base import LABEL, PRED, Fitted, Spec


def _shapes(p: int, hidden: tuple[int, ...]) -> list[tuple[int, int]]:
    sizes = [p, *hidden, 1]
    return [(sizes[i], sizes[i + 1]) for i in range(len(sizes) - 1)]


def _unpack(theta: np.ndarray, shapes):
    out, o = [], 0
    for a, b in shapes:
        W = theta[o:o + a * b].reshape(a, b)
        o += a * b
        bb = theta[o:o + b]
        o += b
        out.append((W, bb))
    return out


def _init(shapes, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in shapes:
        lim = np.sqrt(6.0 / (a + b))  # Glorot uniform, as scikit-learn
        parts += [rng.uniform(-lim, lim, size=a * b), rng.uniform(-lim, lim, size=b)]
    return np.concatenate(parts)


def _act(z, kind):
    if kind == "tanh":
        return np.tanh(z)
    if kind == "logistic":
        return 1.0 / (1.0 + np.exp(-z))
    if kind == "identity":
        return z
    return np.maximum(z, 0.0)


def _dact(a, kind):
    if kind == "tanh":
        return 1.0 - a * a
    if kind == "logistic":
        return a * (1.0 - a)
    if kind == "identity":
        return np.ones_like(a)
    return (a > 0).astype(a.dtype)


def _local_train(X, y, wt, theta, shapes, act, lr, alpha, batch, epochs, seed):
    """Adam on squared loss/2 + alpha/2 |W|^2 (scikit-learn's objective)."""
    theta, g, m1, m2 = theta.copy(), np.empty_like(theta), np.zeros_like(theta), np.zeros_like(theta)
    one, two = np.empty_like(theta), np.empty_like(theta)
    layers, grads = _unpack(theta, shapes), _unpack(g, shapes)  # views: a step changes theta in place
    b1, b2, eps = 0.9, 0.999, 1e-8
    t = 0
    n = len(y)
    batch = shards.batch_of(batch, wt)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(n) if batch < n else np.arange(n)
        for s in range(0, n, batch):
            idx = order[s:s + batch]
            xb, yb, wb = X[idx], y[idx], wt[idx]
            acts = [xb]
            for li, (W, bb) in enumerate(layers):
                z = acts[-1] @ W + bb
                acts.append(z if li == len(layers) - 1 else _act(z, act))
            delta = ((acts[-1][:, 0] - yb) * (wb / wb.sum()))[:, None]
            for li in range(len(layers) - 1, -1, -1):
                (W, _), (gW, gb) = layers[li], grads[li]
                np.matmul(acts[li].T, delta, out=gW)
                gW += alpha * W / len(yb)
                delta.sum(axis=0, out=gb)
                if li > 0:
                    delta = (delta @ W.T) * _dact(acts[li], act)
            t += 1
            np.multiply(g, 1 - b1, out=one)
            m1 *= b1
            m1 += one
            np.multiply(g, 1 - b2, out=one)
            one *= g
            m2 *= b2
            m2 += one
            np.divide(m1, 1 - b1 ** t, out=one)
            one *= lr
            np.divide(m2, 1 - b2 ** t, out=two)
            np.sqrt(two, out=two)
            two += eps
            one /= two
            theta -= one
    return theta


def _predict(X, layers, act):
    h = X
    for li, (W, bb) in enumerate(layers):
        h = h @ W + bb
        if li < len(layers) - 1:
            h = _act(h, act)
    return h[:, 0]


class MLP(Spec):
    """G6 ("neural_network"): hidden (100,), relu, Adam lr 1e-3, alpha 1e-4.
    Up to ``rounds`` x ``local_epochs`` passes, fewer once the loss falls by
    less than ``tol`` of itself."""
    name = "neural_network"
    chunked = False
    allowed = frozenset({"hidden_layer_sizes", "activation", "learning_rate_init", "alpha", "rounds", "local_epochs",
                         "batch_size", "seed", "tol", "shard_rows"})

    def fit(self, df: DataFrame, features: list[str], label: str = LABEL) -> Fitted:
        hidden = tuple(int(h) for h in self.params.get("hidden_layer_sizes", (100,)))
        act = self.params.get("activation", "relu")
        lr = float(self.params.get("learning_rate_init", 1e-3))
        alpha = float(self.params.get("alpha", 1e-4))
        rounds = int(self.params.get("rounds", 25))
        epochs = int(self.params.get("local_epochs", 40))
        batch = int(self.params.get("batch_size", 200))
        seed = int(self.params.get("seed", 42))
        tol = float(self.params.get("tol", 1e-3))
        shapes = _shapes(len(features), hidden)
        chunked = self.chunked

        def improve(X, y, wt, theta, r, shard):
            # The first pass is a full fit, later ones single warm-started epochs
            passes = 1 if chunked and r > 0 else epochs
            return _local_train(X, y, wt, theta, shapes, act, lr, alpha, batch, passes, seed + 7919 * r + shard)

        def loss(X, y, wt, theta):
            layers = _unpack(theta, shapes)
            e = _predict(X, layers, act) - y
            return float((wt * e * e).sum() / 2 + alpha / 2 * sum((W * W).sum() for W, _ in layers))

        data, _, _ = shards.sharded(df, list(features), label, int(self.params.get("shard_rows", shards.SHARD_ROWS)))
        try:
            theta, _ = shards.fit(data, len(features), _init(shapes, seed), improve, loss, rounds, tol)
        finally:
            shards.release(data)
        return mlp_fitted(theta, shapes, act, list(features), self.name)


class ChunkedMLP(MLP):
    """G7 ("mlp_regressor"): a full fit on the first pass, then warm-started
    single passes (the source's 2,000-row chunks become the shards; inside
    them, 200-row mini-batches). The source tunes it on a sample first: see
    ``tuning_rows`` of ``cv.grid_search``."""
    name = "mlp_regressor"
    chunked = True


def mlp_fitted(theta, shapes, act, features, name) -> Fitted:
    return _ArrowMLP(theta, shapes, act, features, name)


class _ArrowMLP(Fitted):
    """Scores Arrow batches with numpy, whatever the network's size. A row
    with a missing feature has no prediction (NULL)."""

    def __init__(self, theta, shapes, act, features, name):
        self.theta, self.shapes, self.act, self.features, self.name = theta, shapes, act, features, name
        self.output_col = PRED
        self.state = {"theta": list(map(float, theta)), "act": act, "shapes": [list(x) for x in shapes]}

    def transform(self, df: DataFrame) -> DataFrame:
        layers = _unpack(self.theta, self.shapes)
        feats, act, out = self.features, self.act, self.output_col
        schema = T.StructType([f for f in df.schema.fields if f.name != out] + [T.StructField(out, T.DoubleType())])

        def score(it):
            import pandas as pd
            for pdf in it:
                X = pdf[feats].to_numpy(dtype=np.float64)
                missing = np.isnan(X).any(axis=1)
                pdf[out] = pd.Series(np.nan_to_num(_predict(X, layers, act)), index=pdf.index, dtype="Float64").mask(missing)
                yield pdf[[f.name for f in schema.fields]]
        return df.mapInPandas(score, schema)
