"""G0, G12, G13, H9-H13, H15 -- grid search, cross-validation, the model
registry, training all models, validation-based selection.

Folds are a column (F2/F4), so every fit reads the cached frame through a
filter on ``fold`` -- no copies of the data. Fold scores are computed with
one grouped aggregate over the union of the fold predictions.
"""

from __future__ import annotations

import itertools
import logging
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ventana.models.base import LABEL, PRED, Spec, parallel_map
from ventana.models.classic import SPECS as CLASSIC
from ventana.models.classic import GradientBoosting, LinearOLS, RandomForest, SVR
from ventana.models.ensembles import SPECS as ENSEMBLE
from ventana.models.mlp import MLP, ChunkedMLP
from ventana.operators.evaluate import evaluate

log = logging.getLogger(__name__)

# Order of the source's training loop: six classics, then four ensembles.
CLASSIC_ORDER = ["logistic_regression", "random_forest", "svm", "gradient_boosting", "neural_network",
                 "mlp_regressor"]
ENSEMBLE_ORDER = ["voting_regressor", "stacking_regressor", "ada_boost", "bagging_regressor"]

REGISTRY: dict[str, type[Spec]] = {**CLASSIC, **ENSEMBLE, "neural_network": MLP, "mlp_regressor": ChunkedMLP}


def get_spec(name: str, **params) -> Spec | None:
    """A spec by name; ``None`` when unknown."""
    cls = REGISTRY.get(name)
    return cls(**params) if cls else None


def core_metrics(preds: DataFrame, by: list[str]) -> DataFrame:
    """R2, MSE and MAE of ``(y, p)`` per group from plain sums: the three that
    model selection reads, without the order statistics of the full report."""
    e = F.col("y") - F.col("p")
    got = preds.groupBy(*by).agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.var_pop("y").alias("v"))
    r2 = F.when(F.col("v") > 0, 1 - F.col("mse") / F.col("v")).otherwise(F.when(F.col("mse") == 0, 1.0).otherwise(0.0))
    return got.select(*by, r2.alias("r2"), "mse", "mae")


def cross_val_predict(spec: Spec, df: DataFrame, features: list[str], fold_col: str = "fold",
                      label: str = LABEL, k: int | None = None, parallelism: int = 2) -> DataFrame:
    """H9: each row predicted by the model fitted without its fold."""
    folds = list(range(k)) if k else sorted(r[0] for r in df.select(fold_col).distinct().collect())
    models = parallel_map(lambda f: spec.fit(df.filter(F.col(fold_col) != f), features, label), folds, parallelism)
    out = None
    for f, m in zip(folds, models):
        part = m.transform(df.filter(F.col(fold_col) == f))
        out = part if out is None else out.unionByName(part)
    return out


def cross_validate(spec: Spec, df: DataFrame, features: list[str], fold_col: str = "fold", k: int = 5,
                   label: str = LABEL, name: str | None = None, parallelism: int = 5) -> DataFrame:
    """Per fold, test and train R2, -MSE, -MAE, fit and score time (each
    fold's own: it is scored by one aggregate, 2 rows of which come back)."""
    spark = df.sparkSession

    def fit_fold(f):
        t0 = time.time()
        m = spec.fit(df.filter(F.col(fold_col) != f), features, label)
        return m, time.time() - t0
    rows = []
    for f, (m, fit_time) in enumerate(parallel_map(fit_fold, range(k), parallelism)):
        t0 = time.time()
        both = m.transform(df).select(F.when(F.col(fold_col) == f, "test").otherwise("train").alias("part"),
                                      F.col(label).alias("y"), F.col(PRED).alias("p"))
        got = {r.part: r for r in core_metrics(both, ["part"]).collect()}
        rows.append((f, *[x for part in ("test", "train") for x in (
            (got[part].r2, -got[part].mse, -got[part].mae) if part in got else (None, None, None))], fit_time, time.time() - t0))
    cols = [f"{part}_{m} double" for part in ("test", "train") for m in ("r2", "neg_mean_squared_error", "neg_mean_absolute_error")]
    out = spark.createDataFrame(rows, ", ".join(["fold int", *cols, "fit_time double", "score_time double"]))
    return out.withColumn("model", F.lit(name or spec.name)).orderBy("fold")


def cv_scores(cv: DataFrame, metric: str = "neg_mean_absolute_error") -> DataFrame:
    """H11 ``get_cv_scores``: the test scores of one metric, their mean and
    population std (the source's default 'accuracy' is a classifier metric;
    ours defaults to -MAE, where higher is better)."""
    c = F.col(f"test_{metric}")
    return cv.groupBy("model").agg(F.sort_array(F.collect_list(F.struct("fold", c.alias("score")))).alias("scores"),
                                   F.avg(c).alias("mean"), F.stddev_pop(c).alias("std"))


def compare_cv(cvs: DataFrame, metric: str = "neg_mean_absolute_error") -> DataFrame:
    """H12 ``compare_models``: Model, Mean, Std, Min, Max, sorted Mean desc."""
    c = F.col(f"test_{metric}")
    return cvs.groupBy("model").agg(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std"),
                                    F.min(c).alias("min"), F.max(c).alias("max")) \
              .orderBy(F.col("mean").desc(), "model")


def cv_folds_table(cv: DataFrame) -> DataFrame:
    """H13 ``evaluate_cv_folds``: one row per fold, test_/train_ per metric."""
    return cv.select("model", "fold", *[c for c in cv.columns if c.startswith(("test_", "train_"))]).orderBy("fold")


def param_grid(grid: dict[str, list]) -> list[dict]:
    if not grid:
        return [{}]
    keys = list(grid)
    return [dict(zip(keys, v)) for v in itertools.product(*[grid[k] for k in keys])]


def grid_search(spec: Spec, grid: dict[str, list], df: DataFrame, features: list[str], fold_col: str = "fold",
                k: int = 5, label: str = LABEL, parallelism: int = 2, tuning: DataFrame | None = None):
    """Every grid point x k folds scored by mean test R2; the best point
    (the first of equals) is refitted on all rows of ``df``. Returns (fitted,
    best_params, best_score, table of all points).

    Points are scored one after another and their models let go, so k models
    are held at a time whatever the grid. Points that map to the same
    estimator are fitted once. ``tuning``: folded rows to tune on in place of
    ``df`` (see ``split.tuning_sample``; default all)."""
    points, rows = param_grid(grid), tuning if tuning is not None else df
    seen: dict[tuple, float | None] = {}
    results = []
    for point in points:
        sp = spec.copy(**point)
        key = sp.effective()
        if key not in seen:
            fits = parallel_map(lambda f: sp.fit(rows.filter(F.col(fold_col) != f), features, label), range(k), parallelism)
            preds = None
            for f, m in enumerate(fits):
                part = m.transform(rows.filter(F.col(fold_col) == f)).select(F.lit(f).alias("fold"), F.col(label).alias("y"), F.col(PRED).alias("p"))
                preds = part if preds is None else preds.unionByName(part)
            seen[key] = core_metrics(preds, ["fold"]).agg(F.avg("r2").alias("s")).first()["s"]
        results.append((str(point), seen[key]))
    best_i = max(range(len(points)), key=lambda i: results[i][1] if results[i][1] is not None else float("-inf"))
    best = points[best_i]
    fitted = spec.copy(**best).fit(df, features, label)
    table = df.sparkSession.createDataFrame(results, "params string, mean_r2 double")
    return fitted, best, results[best_i][1], table


def train_all(df: DataFrame, features: list[str], label: str = LABEL, names: list[str] | None = None,
              params: dict[str, dict] | None = None, order_by: list[str] | None = None) -> dict:
    """Six classics then four ensembles on the training frame (which the
    caller caches); an ensemble failure is logged and the rest continues."""
    names = names or (CLASSIC_ORDER + ENSEMBLE_ORDER)
    params = params or {}
    fitted = {}
    for n in names:
        p = dict(params.get(n, {}))
        if n == "stacking_regressor" and "order_by" not in p and order_by:
            p["order_by"] = order_by
        spec = get_spec(n, **p)
        if spec is None:
            log.warning("unknown model %s", n)
            continue
        try:
            fitted[n] = spec.fit(df, features, label)
        except Exception as e:  # noqa: BLE001 -- the source keeps going after an ensemble failure
            if n in ENSEMBLE_ORDER:
                log.error("training %s failed: %s", n, e)
                continue
            raise
    return fitted


def long_predictions(models: dict, df: DataFrame, key: list[str], label: str = LABEL) -> DataFrame:
    """All models' predictions long ``(key, model, y, p)`` for one grouped
    evaluation (H7)."""
    out = None
    for n, m in models.items():
        part = m.with_output(PRED).transform(df).select(*key, F.lit(n).alias("model"), F.col(label).alias("y"),
                                                        F.col(PRED).alias("p"))
        out = part if out is None else out.unionByName(part)
    return out


def select_and_test(models: dict, val: DataFrame, test: DataFrame, key: list[str], label: str = LABEL):
    """Leaderboard on validation, row 1 is the best; metrics once on
    test. Returns (val leaderboard, best name, test metrics frame)."""
    lb = evaluate(long_predictions(models, val, key, label))
    best = lb.first()["model"]
    test_m = evaluate(long_predictions({best: models[best]}, test, key, label))
    return lb, best, test_m


__all__ = ["REGISTRY", "get_spec", "cross_val_predict", "cross_validate", "cv_scores", "compare_cv",
           "cv_folds_table", "param_grid", "grid_search", "train_all", "long_predictions", "select_and_test",
           "LinearOLS", "RandomForest", "SVR", "GradientBoosting", "MLP", "ChunkedMLP", "core_metrics"]
