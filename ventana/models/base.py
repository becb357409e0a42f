"""Common model interface.

A *model spec* is fitted on a DataFrame holding feature columns and a
``label`` column and returns a fitted model whose ``transform`` appends a
``prediction`` column. MLlib estimators are wrapped with a
``VectorAssembler``; the vector exists only at the model boundary.
"""

from __future__ import annotations

import inspect
import time
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABEL, PRED, VEC = "label", "prediction", "_features"


class Fitted:
    """A fitted model: ``transform(df)`` adds ``output_col``."""
    name: str = "model"
    features: list[str]
    output_col: str = PRED

    def transform(self, df: DataFrame) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError

    def with_output(self, name: str) -> "Fitted":
        self.output_col = name
        return self


class Spec:
    """An unfitted model with parameters."""
    name: str = "model"
    #: the parameters a model knows; another one is an error, not a silent no-op
    allowed: frozenset[str] = frozenset()

    def __init__(self, **params: Any):
        unknown = sorted(set(params) - self.known_parameters())
        if unknown:
            raise TypeError(f"{self.name} has no parameter {', '.join(unknown)}")
        self.params = params

    @classmethod
    def known_parameters(cls) -> set[str]:
        return set(cls.allowed)

    def effective(self) -> tuple:
        """What distinguishes two fits: parameter sets that map to the same
        estimator are equal here."""
        return tuple(sorted((k, repr(v)) for k, v in self.params.items()))

    def fit(self, df: DataFrame, features: list[str], label: str = LABEL) -> Fitted:  # pragma: no cover
        raise NotImplementedError

    def copy(self, **overrides: Any) -> "Spec":
        p = dict(self.params)
        p.update(overrides)
        return type(self)(**p)


@dataclass
class MLlibFitted(Fitted):
    model: PipelineModel
    features: list[str]
    name: str = "model"
    output_col: str = PRED

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(df)
        out = out.drop(VEC)
        if self.output_col != PRED:
            out = out.withColumnRenamed(PRED, self.output_col)
        return out

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)


class MLlibSpec(Spec):
    """Wraps an MLlib regressor factory ``make(**params)``."""
    make = None

    @classmethod
    def known_parameters(cls) -> set[str]:
        return set(inspect.signature(cls.make).parameters)

    def estimator(self):
        return type(self).make(**self.params)

    def effective(self) -> tuple:
        est = self.estimator()
        return tuple(sorted((k.name, repr(v)) for k, v in est.extractParamMap().items()))

    def fit(self, df: DataFrame, features: list[str], label: str = LABEL) -> Fitted:
        est = self.estimator().setFeaturesCol(VEC).setLabelCol(label).setPredictionCol(PRED)
        pipe = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol=VEC, handleInvalid="error"), est])
        return MLlibFitted(pipe.fit(df), list(features), self.name)


@dataclass
class ExprFitted(Fitted):
    """A model whose prediction is one JVM-side column expression built
    from fitted literals (linear models, random-feature SVR, small MLPs)."""
    expr_fn: Any
    features: list[str]
    name: str = "model"
    output_col: str = PRED
    state: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.output_col, self.expr_fn())


def parallel_map(fn, items, parallelism: int = 4):
    """Run independent fits concurrently from driver threads (Spark
    schedules their jobs side by side, as ``CrossValidator(parallelism)``
    does); results keep the order of ``items``."""
    items = list(items)
    if parallelism <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as ex:
        return list(ex.map(fn, items))


def timed(fn, *a, **k):
    t0 = time.time()
    out = fn(*a, **k)
    return out, time.time() - t0


def balanced_sum(terms: list):
    """Sum as a balanced tree (depth log n): a left-deep chain of hundreds
    of additions overflows the optimizer's recursion."""
    terms = list(terms)
    if not terms:
        return F.lit(0.0)
    while len(terms) > 1:
        terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0]


def lincomb(features: list[str], w, b: float):
    """``b + sum(w_j * x_j)`` as one column expression."""
    return balanced_sum([F.lit(float(b))] + [F.col(f"`{c}`") * F.lit(float(wj)) for c, wj in zip(features, w)])
