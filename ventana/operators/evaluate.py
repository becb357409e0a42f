"""H1-H8, H14, H16 -- regression metrics, leaderboard, best model, error
profile, run summary.

Every model is scored in one job: predictions arrive long as
``(model, y, p)`` and one ``groupBy('model')`` computes all metrics with
partial aggregation (the final merge is one row per model). Only the
leaderboard -- one row per model -- ever reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ventana.functions.quantiles import grouped_quantiles

# sklearn's MAPE guard (float64 machine epsilon).
EPS = 2.220446049250313e-16

METRICS = ["mae", "rmse", "r2", "mse", "medae", "evs", "mape"]
LOWER_IS_BETTER = {"mse", "rmse", "mae", "medae", "mape"}


def _guarded_ratio(num: Column, den: Column) -> Column:
    """1 - num/den with sklearn's finite rule: den = 0 -> 1 if num = 0 else 0."""
    return F.when(den == 0, F.when(num == 0, F.lit(1.0)).otherwise(F.lit(0.0))) \
            .otherwise(F.lit(1.0) - F.try_divide(num, den))


def metric_columns(y: Column, p: Column, accuracy: int | None = None) -> list[Column]:
    """H1-H6 as aggregate expressions over one group. The median error is
    exact only through :func:`evaluate`, which fills it in; with ``accuracy``
    it is an approximate percentile here."""
    e = y - p
    n = F.count(F.lit(1))
    sse = F.sum(e * e)
    sst = n * F.var_pop(y)
    med = F.percentile_approx(F.abs(e), 0.5, accuracy) if accuracy else F.lit(None).cast("double")
    return [
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        _guarded_ratio(sse, sst).alias("r2"),
        F.avg(e * e).alias("mse"),
        med.alias("medae"),
        _guarded_ratio(F.var_pop(e), F.var_pop(y)).alias("evs"),
        F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(EPS))).alias("mape"),
    ]


def evaluate(preds: DataFrame, y: str = "y", p: str = "p", by: list[str] | None = None,
             accuracy: int | None = None) -> DataFrame:
    """H7 ``evaluate_multiple_models``: metrics per model (or any grouping),
    sorted MAE asc, RMSE asc, R2 desc."""
    by = by if by is not None else ["model"]
    narrow = preds.select(*by, F.col(y).cast("double").alias("_y"), F.col(p).cast("double").alias("_p"))
    metrics = metric_columns(F.col("_y"), F.col("_p"), accuracy)
    if accuracy:
        out = narrow.groupBy(*by).agg(*metrics)
    else:
        out = grouped_quantiles(narrow.withColumn("_e", F.abs(F.col("_y") - F.col("_p"))), by, "_e", [0.5], metrics)
        out = out.withColumn("medae", F.col("_q")[0]).drop("_q")
    return out.orderBy(F.col("mae").asc_nulls_last(), F.col("rmse").asc_nulls_last(),
                       F.col("r2").desc_nulls_last(), *by)


def evaluate_one(df: DataFrame, y: str = "label", p: str = "prediction", accuracy: int | None = None) -> DataFrame:
    """H1-H6 for one model's predictions (one row)."""
    one = df.select(F.lit(1).alias("_one"), F.col(y).alias("_y"), F.col(p).alias("_p"))
    names = [n for n in METRICS]
    out = evaluate(one, "_y", "_p", ["_one"], accuracy).select(*names)
    # one row also for no predictions
    return df.sparkSession.range(1).join(out, F.lit(True), "left").select(*names)


def best_model(leaderboard: DataFrame, metric: str = "mae", name: str = "model") -> DataFrame:
    """H8 ``get_best_model``: min for error metrics, max otherwise; a NULL
    metric loses; empty -> no row (NULL)."""
    m = F.col(metric)
    if metric in LOWER_IS_BETTER:
        pick = F.min_by(F.col(name), F.struct(F.coalesce(m, F.lit(float("inf"))), F.col(name)))
    else:
        pick = F.min_by(F.col(name), F.struct(F.coalesce(-m, F.lit(float("inf"))), F.col(name)))
    return leaderboard.agg(pick.alias("best_model"))


def prediction_errors(df: DataFrame, y: str = "y", p: str = "p", by: list[str] | None = None,
                      accuracy: int | None = None) -> DataFrame:
    """H14 ``get_prediction_errors`` of ``e = y - p``: mean, population std,
    min, max, median, 5th and 95th percentile (linear interpolation)."""
    e = F.col(y).cast("double") - F.col(p).cast("double")
    probs = [0.5, 0.05, 0.95]
    if not by:
        got = prediction_errors(df.withColumn("_one", F.lit(1)), y, p, ["_one"], accuracy).drop("_one")
        return df.sparkSession.range(1).join(got, F.lit(True), "left").drop("id")
    narrow, x = df.select(*by, e.alias("_e")), F.col("_e")
    spread = [F.avg(x).alias("mean_error"), F.stddev_pop(x).alias("std_error"), F.min(x).alias("min_error"), F.max(x).alias("max_error")]
    if accuracy:
        out = narrow.groupBy(*by).agg(*spread, F.percentile_approx(x, F.array(*[F.lit(q) for q in probs]), accuracy).alias("_q"))
    else:
        out = grouped_quantiles(narrow, by, "_e", probs, spread)
    return out.select(*(by or []), "mean_error", "std_error", "min_error", "max_error",
                      F.col("_q")[0].alias("median_error"), F.col("_q")[1].alias("percentile_5"),
                      F.col("_q")[2].alias("percentile_95"))


def run_summary(data: DataFrame, features: list[str], label: str = "label", models: list[str] | None = None,
                best: str | None = None, test_metrics: dict | None = None, config: dict | None = None) -> DataFrame:
    """key/value table -- samples, features, distinct target values,
    models, best, and the best model's test MAE/RMSE/R2. Counts are one
    aggregate over the data; the rest are run parameters."""
    counts = data.agg(F.count(F.lit(1)).cast("string").alias("samples"),
                      F.count_distinct(F.col(label)).cast("string").alias("target_distinct"))
    kv = [("features", str(len(features))), ("models", ",".join(models or [])), ("best_model", best or "")]
    for k in ("mae", "rmse", "r2"):
        if test_metrics and test_metrics.get(k) is not None:
            kv.append((f"test_{k}", repr(float(test_metrics[k]))))
    for k, v in (config or {}).items():
        kv.append((f"config.{k}", str(v)))
    fixed = data.sparkSession.createDataFrame(kv, "key string, value string")
    c = counts.select(F.inline(F.array(F.struct(F.lit("samples").alias("key"), F.col("samples").alias("value")),
                                       F.struct(F.lit("target_distinct").alias("key"),
                                                F.col("target_distinct").alias("value")))))
    return c.unionByName(fixed)


__all__ = ["EPS", "METRICS", "metric_columns", "evaluate", "evaluate_one", "best_model",
           "prediction_errors", "run_summary"]
