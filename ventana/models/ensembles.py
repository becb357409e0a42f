"""G8, G9 -- voting, stacking (G10: ``models.adaboost``).

Voting and stacking never join on the key: the base models are applied one
after another to the same frame (each ``transform`` appends a column), so
their predictions line up row by row inside one narrow plan. Bases fitted on
the same rows share their shards.
"""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ventana.models import shards
from ventana.models.adaboost import AdaBoostR2
from ventana.models.base import LABEL, PRED, Fitted, Spec, lincomb, parallel_map
from ventana.models.classic import SVR, GradientBoosting, LinearOLS, RandomForest


def default_bases():
    return [("logistic_regression", LinearOLS()), ("random_forest", RandomForest()), ("svm", SVR()),
            ("gradient_boosting", GradientBoosting())]


class _Chain(Fitted):
    """Applies fitted bases (each to its own column), then adds them up with
    weights and an intercept."""

    def __init__(self, bases: list[tuple[str, Fitted]], weights, intercept: float, features, name):
        self.bases, self.weights, self.intercept = bases, [float(w) for w in weights], float(intercept)
        self.features, self.name, self.output_col = features, name, PRED

    def transform(self, df: DataFrame) -> DataFrame:
        cols = []
        out = df
        for i, (_, m) in enumerate(self.bases):
            c = f"_base{i}"
            out = m.with_output(c).transform(out)
            cols.append(c)
        return out.withColumn(self.output_col, lincomb(cols, self.weights, self.intercept)).drop(*cols)


class Voting(Spec):
    """Mean of the refitted bases' predictions."""
    name = "voting_regressor"
    allowed = frozenset({"bases", "parallelism"})

    def fit(self, df, features, label=LABEL):
        bases = self.params.get("bases") or default_bases()
        par = int(self.params.get("parallelism", 4))
        with shards.shared(df):
            fitted = parallel_map(lambda nb: (nb[0], nb[1].fit(df, features, label)), bases, par)
        return _Chain(fitted, [1.0 / len(fitted)] * len(fitted), 0.0, list(features), self.name)


class Stacking(Spec):
    """Out-of-fold predictions of the bases over ``fold_col`` (contiguous
    folds, F4) train an OLS meta-model; the bases are refitted on all rows."""
    name = "stacking_regressor"
    allowed = frozenset({"bases", "cv", "order_by", "fold_col", "parallelism"})

    def fit(self, df, features, label=LABEL):
        from ventana.operators.split import contiguous_folds
        bases = self.params.get("bases") or default_bases()
        k = int(self.params.get("cv", 5))
        order = self.params.get("order_by")
        fold_col = self.params.get("fold_col")
        if fold_col is None:
            if not order:
                raise ValueError("Stacking needs order_by (for contiguous folds) or fold_col")
            df = contiguous_folds(df, list(order), k)
            fold_col = "fold"
        base_cols = [f"_oof{i}" for i in range(len(bases))]
        # side by side: a fit is many short jobs, and no base is held in the driver while it grows
        par = int(self.params.get("parallelism", 4))
        df = df.cache()
        # every (fold, base) fit and every refit is independent: run them side by side
        tasks = [(f, i) for f in range(k) for i in range(len(bases))] + [(None, i) for i in range(len(bases))]

        rows = {f: df.filter(F.col(fold_col) != f) for f in range(k)} | {None: df}
        with ExitStack() as stack:
            for some in rows.values():
                stack.enter_context(shards.shared(some))
            models = dict(zip(tasks, parallel_map(lambda t: bases[t[1]][1].fit(rows[t[0]], features, label), tasks, par)))

        def score(f):
            part = df.filter(F.col(fold_col) == f)
            for i in range(len(bases)):
                part = models[(f, i)].with_output(base_cols[i]).transform(part)
            return part.select(*base_cols, F.col(label))
        oof = None
        for part in parallel_map(score, range(k), par):
            oof = part if oof is None else oof.unionByName(part)
        meta = LinearOLS().fit(oof, base_cols, label)
        fitted = [(bases[i][0], models[(None, i)]) for i in range(len(bases))]
        lm = meta.model.stages[-1]
        df.unpersist()
        return _Chain(fitted, lm.coefficients.toArray(), lm.intercept, list(features), self.name)


SPECS = {"voting_regressor": Voting, "stacking_regressor": Stacking, "ada_boost": AdaBoostR2}
