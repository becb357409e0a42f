"""I1-I5 -- comparing result tables across runs/pipelines.

Inputs are leaderboards (one row per model), so every frame here is tiny;
the work is still expressed as DataFrame ops so it composes with the
leaderboards the evaluation jobs produce, and generalises from the source's
two inputs to any number of ranked sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ventana.functions.exprs import col

RESULT_COLUMNS = ["source", "source_rank", "model_name", "mae", "rmse", "r2"]

# Header aliases accepted by the source's result loaders.
MODEL_ALIASES = ["Model", "Architecture", "model", "model_name"]
MAE_ALIASES = ["MAE", "mae"]
RMSE_ALIASES = ["RMSE", "rmse"]
R2_ALIASES = ["R2", "R2-Score", "r2"]


def _first_present(df: DataFrame, names: list[str], default: Column) -> Column:
    have = [col(n) for n in names if n in df.columns]
    return F.coalesce(*have, default) if have else default


def first_result_row(df: DataFrame, source: str, source_rank: int, default_name: str = "Model") -> DataFrame:
    """The first row (file order) of a result table, with the source's
    header aliases resolved; an empty table yields no row."""
    t = df.withColumn("_ord", F.monotonically_increasing_id())
    row = t.select(
        F.lit(source).alias("source"), F.lit(source_rank).alias("source_rank"),
        _first_present(t, MODEL_ALIASES, F.lit(default_name)).cast("string").alias("model_name"),
        _first_present(t, MAE_ALIASES, F.lit(None)).cast("double").alias("mae"),
        _first_present(t, RMSE_ALIASES, F.lit(None)).cast("double").alias("rmse"),
        _first_present(t, R2_ALIASES, F.lit(None)).cast("double").alias("r2"), "_ord")
    first = row.agg(F.min("_ord").alias("_m"))
    return row.join(F.broadcast(first), F.col("_ord") == F.col("_m")).select(*RESULT_COLUMNS)


def load_result(spark: SparkSession, path: str, source: str, source_rank: int) -> DataFrame:
    """I1 from a CSV file; an absent file yields no row."""
    from ventana.sources.io import path_exists
    if not path_exists(spark, path):
        return spark.createDataFrame([], "source string, source_rank int, model_name string, "
                                         "mae double, rmse double, r2 double")
    return first_result_row(spark.read.option("header", "true").option("inferSchema", "true").csv(path),
                            source, source_rank)


def winner(results: DataFrame) -> DataFrame:
    """Lowest MAE wins; on a tie the lower ``source_rank`` (source A)
    wins. Improvement % = (runner_up - winner) / runner_up * 100, 0 when
    the runner-up MAE is not positive; no runner-up -> NULL.

    ``results`` has one row per result source, so sorting its rows inside
    one aggregate is bounded by the number of sources, not by data."""
    key = F.struct(F.coalesce(F.col("mae"), F.lit(float("inf"))).alias("k"), F.col("source_rank").alias("r"),
                   *[F.col(c) for c in RESULT_COLUMNS])
    agg = results.agg(F.sort_array(F.collect_list(key)).alias("_s"))
    w, ru = F.col("_s")[0], F.col("_s")[1]
    ru_mae = F.when(F.size("_s") > 1, ru["mae"])
    imp = F.when(ru_mae.isNull(), F.lit(None).cast("double")) \
           .when(ru_mae > 0, (ru_mae - w["mae"]) / ru_mae * 100.0).otherwise(F.lit(0.0))
    return agg.filter(F.size("_s") > 0).select(
        w["source"].alias("winner_source"), w["model_name"].alias("winner_model"), w["mae"].alias("winner_mae"),
        ru_mae.alias("runner_up_mae"), imp.alias("improvement_mae_pct"))


def metric_differences(results: DataFrame) -> DataFrame:
    """For the sources with ``source_rank`` 0 (A) and 1 (B), per metric:
    both values, the winner (MAE/RMSE lower, R2 higher; A on ties), the
    difference (A - B; for R2 B - A) and its % of A (MAE/RMSE only, 0 when
    A is not positive). One aggregate pivots the two rows."""
    def pick(rank, c):
        return F.max(F.when(F.col("source_rank") == rank, F.col(c)))
    j = results.agg(*[pick(r, c).alias(f"{p}_{c}") for r, p in ((0, "a"), (1, "b"))
                      for c in ["source", "mae", "rmse", "r2"]])
    rows = []
    for m, lower in (("mae", True), ("rmse", True), ("r2", False)):
        av, bv = F.col(f"a_{m}"), F.col(f"b_{m}")
        b_wins = F.coalesce((bv < av) if lower else (bv > av), F.lit(False))
        diff = (av - bv) if lower else (bv - av)
        pct = F.when(av > 0, diff / av * 100.0).otherwise(F.lit(0.0)) if lower else F.lit(None).cast("double")
        rows.append(F.struct(F.lit(m).alias("metric"), av.alias("value_a"), bv.alias("value_b"),
                             F.when(b_wins, F.col("b_source")).otherwise(F.col("a_source")).alias("winner"),
                             diff.alias("difference"), pct.alias("difference_pct")))
    return j.select(F.inline(F.array(*rows)))


def consolidated(results: DataFrame) -> DataFrame:
    """I4: all sources' rows sorted by MAE (source order on ties)."""
    return results.orderBy(F.col("mae").asc_nulls_last(), "source_rank").select(
        "model_name", "source", "mae", "rmse", "r2")


def architecture_leaderboard(df: DataFrame) -> DataFrame:
    """Name, config, val/train MAE, epochs; ascending val MAE, with the
    generalisation gap val - train."""
    return df.select("name", "config", F.col("val_mae").cast("double").alias("val_mae"),
                     F.col("train_mae").cast("double").alias("train_mae"),
                     F.col("epochs_trained").cast("int").alias("epochs_trained"),
                     (F.col("val_mae").cast("double") - F.col("train_mae").cast("double")).alias("gap")) \
             .orderBy("val_mae", "name")


__all__ = ["first_result_row", "load_result", "winner", "metric_differences", "consolidated",
           "architecture_leaderboard", "RESULT_COLUMNS"]
