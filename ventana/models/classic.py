"""G1, G2, G11 -- regressors (G3, G4: ``models.svr``; G5: ``models.boosting``).

OLS is MLlib's; the forests are ``models.forest``. ``min_samples_split = s`` is
mapped to leaves of at least s // 2 rows, the nearest bound on the same splits.
"""

from __future__ import annotations

from pyspark.ml.regression import LinearRegression

from ventana.models.base import MLlibSpec
from ventana.models.boosting import GradientBoosting
from ventana.models.forest import Forest, Limits
from ventana.models.svr import SVR


def _leaf(min_samples_leaf: int, min_samples_split: int) -> int:
    return max(int(min_samples_leaf), int(min_samples_split) // 2, 1)


class LinearOLS(MLlibSpec):
    """G1 ("logistic_regression" in the source): OLS with intercept, no
    penalty; the normal-equation solver is exact and one pass."""
    name = "logistic_regression"

    @staticmethod
    def make():
        return LinearRegression(solver="normal", regParam=0.0, elasticNetParam=0.0, fitIntercept=True,
                                standardization=False)


class RandomForest(Forest):
    """100 trees, every feature considered at each split, seed 42;
    ``max_depth=None`` maps to a cap of 30."""
    name = "random_forest"
    allowed = frozenset({"n_estimators", "max_depth", "min_samples_leaf", "min_samples_split", "seed"})

    def limits(self) -> Limits:
        get = self.params.get
        return Limits(int(get("n_estimators", 100)), int(get("max_depth", None) or 30),
                      _leaf(get("min_samples_leaf", 1), get("min_samples_split", 2)), int(get("seed", 42)))


class Bagging(Forest):
    """10 unpruned bootstrap trees on all features."""
    name = "bagging_regressor"
    allowed = frozenset({"n_estimators", "max_depth", "min_samples_leaf", "seed"})

    def limits(self) -> Limits:
        get = self.params.get
        return Limits(int(get("n_estimators", 10)), int(get("max_depth", 30)), _leaf(get("min_samples_leaf", 1), 1), int(get("seed", 42)))


SPECS = {"logistic_regression": LinearOLS, "random_forest": RandomForest, "svm": SVR,
         "gradient_boosting": GradientBoosting, "bagging_regressor": Bagging}
