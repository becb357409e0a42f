"""Query registrations for models (G), cross-validation and selection
(H9-H13, H15, H16), serving (J) and the runs (K2, K3).

Models are fitted on the train split of the demand matrix (the 20 feature
months, target = the 21st) and scored on its test split. Except G1 on one
feature, whose closed form SQL can state, these have no SQL twin: the driver
checks rows and schema; ``tests/`` checks their properties.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ventana.models import cv as CV
from ventana.models.classic import LinearOLS
from ventana.operators import evaluate as H
from ventana.operators import split as SP
from ventana.operators.prep import FeaturePrep, PrepConfig
from ventana.plans.oracles import dm_sql, qi, r6
from ventana.plans.pipeline import RunConfig, run_profile, run_training
from ventana.plans.queries_ops import _h
from ventana.plans.registry import register
from ventana.session import work_dir
from ventana.sources import bindings as B
from ventana.sources.bindings import FEATURES, RAW_MONTHS, TARGET
from ventana.streaming.filedrop import score_stream, scored
from ventana.streaming.serve import Bundle


def _frames(spark, sf_dir):
    d = SP.split_data(B.dm(spark, sf_dir), "product_id").withColumnRenamed(TARGET, "label")
    return d.filter("split = 'train'"), d.filter("split = 'test'")


def _fit_score(spec, spark, sf_dir):
    tr, te = _frames(spark, sf_dir)
    tr = tr.cache()
    m = spec.fit(tr, FEATURES)
    return m.transform(te).select("product_id", F.col("label").alias("y"), F.col("prediction").alias("p"))


_F1 = FEATURES[-1]


def _g1_sql() -> str:
    d = f"SELECT *, {_h('product_id')} AS u FROM ({dm_sql()})"
    return (f"WITH d AS ({d}), c AS (SELECT regr_slope({qi(TARGET)}, {qi(_F1)}) AS s, "
            f"regr_intercept({qi(TARGET)}, {qi(_F1)}) AS i FROM d WHERE u < 0.6) "
            f"SELECT product_id, {r6(qi(TARGET), 'y', 4)}, {r6(f'i + s * {qi(_F1)}', 'p', 4)} FROM d, c WHERE u >= 0.8")


@register("g1_linear_one_feature", _g1_sql(), digits=4)
def g1_linear_one_feature(spark, sf_dir):
    """G1 with one feature (last month): OLS equals regr_slope/intercept."""
    tr, te = _frames(spark, sf_dir)
    m = LinearOLS().fit(tr, [_F1])
    return m.transform(te).select("product_id", F.col("label").alias("y"), F.col("prediction").alias("p"))


def _model_query(name: str, **params):
    def q(spark, sf_dir):
        return _fit_score(CV.get_spec(name, **params), spark, sf_dir)
    q.__doc__ = f"{name}: fitted on the DM train split, predictions on its test split."
    return q


register("g1_linear_regression")(_model_query("logistic_regression"))
register("g2_random_forest")(_model_query("random_forest"))
register("g3_svr_linear")(_model_query("svm", kernel="linear"))
register("g4_svr_rbf")(_model_query("svm", kernel="rbf"))
register("g5_gradient_boosting")(_model_query("gradient_boosting"))
register("g6_mlp")(_model_query("neural_network"))
register("g7_mlp_chunked")(_model_query("mlp_regressor"))
register("g8_voting")(_model_query("voting_regressor"))
register("g9_stacking")(_model_query("stacking_regressor", order_by=["product_id"]))
register("g10_adaboost")(_model_query("ada_boost"))
register("g11_bagging")(_model_query("bagging_regressor"))


@register("g0_grid_search")
def g0_grid_search(spark, sf_dir):
    """Gradient boosting over a depth x rounds grid, contiguous 3 folds
    (the source's cv=3 for boosting), scored by mean R2; the table of grid
    points with their scores."""
    tr, _ = _frames(spark, sf_dir)
    folded = SP.contiguous_folds(tr, ["product_id"], 3).cache()
    _, _, _, table = CV.grid_search(CV.get_spec("gradient_boosting"), {"n_estimators": [20, 50], "max_depth": [3, 5]},
                                    folded, FEATURES, "fold", 3)
    return table


def _ols_folded(spark, sf_dir):
    tr, _ = _frames(spark, sf_dir)
    return SP.hash_folds(tr, "product_id", 5, seed=43).cache()


@register("h9_cross_val_predict")
def h9_cross_val_predict(spark, sf_dir):
    """H9: every training row predicted by the OLS fitted without its fold."""
    return CV.cross_val_predict(LinearOLS(), _ols_folded(spark, sf_dir), FEATURES, "fold", k=5) \
             .select("product_id", "fold", "label", "prediction")


@register("h10_cross_validate")
def h10_cross_validate(spark, sf_dir):
    """Per-fold test/train R2, -MSE, -MAE and times for OLS."""
    return CV.cross_validate(LinearOLS(), _ols_folded(spark, sf_dir), FEATURES, "fold", 5, name="logistic_regression")


@register("h12_compare_cv")
def h12_compare_cv(spark, sf_dir):
    """CV scores of OLS and gradient boosting, compared by mean -MAE."""
    f = _ols_folded(spark, sf_dir)
    a = CV.cross_validate(LinearOLS(), f, FEATURES, "fold", 5, name="logistic_regression")
    b = CV.cross_validate(CV.get_spec("gradient_boosting", n_estimators=20), f, FEATURES, "fold", 5,
                          name="gradient_boosting")
    return CV.compare_cv(a.unionByName(b))


@register("h13_cv_folds")
def h13_cv_folds(spark, sf_dir):
    return CV.cv_folds_table(CV.cross_validate(LinearOLS(), _ols_folded(spark, sf_dir), FEATURES, "fold", 5,
                                               name="logistic_regression"))


def _run(spark, sf_dir):
    cfg = RunConfig(prep=PrepConfig(usable_columns=tuple(RAW_MONTHS[:-1])))
    pair = B.dm_pair(spark, sf_dir).drop("almacen", "descripcion_producto", "tipo_producto", "descripcion_padre")
    return run_training(pair, RAW_MONTHS[-1], ["codigo_almacen", "codigo_producto"], cfg)


@register("h15_select_and_test")
def h15_select_and_test(spark, sf_dir):
    """H15 via K2 on DM_PAIR: the validation leaderboard of all ten models
    and the best one's metrics on the test rows."""
    run = _run(spark, sf_dir)
    return run.leaderboard_val.withColumn("split", F.lit("val")).unionByName(run.test_metrics.withColumn("split", F.lit("test")))


@register("k2_training_run")
def k2_training_run(spark, sf_dir):
    """K2 on DM_PAIR (raw month names, warehouse x product rows): clean,
    split, prepare, train ten models, select on validation, test once;
    returns the H16 run summary."""
    return _run(spark, sf_dir).summary


@register("k3_profile_run")
def k3_profile_run(spark, sf_dir):
    """K3 on DM_PAIR: the IQR vs z-score comparison of the profile run."""
    return run_profile(B.dm_pair(spark, sf_dir), RAW_MONTHS)["comparison"]


def _bundle(spark, sf_dir):
    cfg = PrepConfig(usable_columns=tuple(FEATURES), stats_from="train")
    tr, _ = _frames(spark, sf_dir)
    prep = FeaturePrep(cfg, passthrough=["product_id", "label"])
    pm, prepared = prep.fit_transform(tr)
    model = LinearOLS().fit(prepared, pm.features)
    path = work_dir(spark, "bundle")
    Bundle(pm, model, "logistic_regression", list(FEATURES), TARGET).save(spark, path)
    return Bundle.load(spark, path), B.dm(spark, sf_dir).drop(TARGET)


@register("j1_batch_scoring")
def j1_batch_scoring(spark, sf_dir):
    """Bundle saved and reloaded, all rows of DM scored; the
    prediction column is appended to the original columns."""
    b, rows = _bundle(spark, sf_dir)
    return b.score(rows)


@register("j2_stream_scoring")
def j2_stream_scoring(spark, sf_dir):
    """All rows of DM dropped as CSV files into a folder, scored by a
    Structured Streaming query (availableNow), output read back."""
    b, files = _bundle(spark, sf_dir)
    base = work_dir(spark, "j2")
    files.write.mode("overwrite").option("header", "true").csv(f"{base}/in")
    q = score_stream(spark, b, f"{base}/in", f"{base}/out", checkpoint=f"{base}/ckpt", schema=files.schema)
    q.awaitTermination()
    return scored(spark, f"{base}/out")


@register("h16_run_summary_counts", f"SELECT * FROM (VALUES ('samples', (SELECT count(*) FROM ({dm_sql()}))::VARCHAR), "
          f"('target_distinct', (SELECT count(DISTINCT {qi(TARGET)}) FROM ({dm_sql()}))::VARCHAR)) v(key, value)")
def h16_run_summary_counts(spark, sf_dir):
    """The data-derived entries of the run summary on DM."""
    d = B.dm(spark, sf_dir).withColumnRenamed(TARGET, "label")
    return H.run_summary(d, FEATURES, "label").filter(F.col("key").isin("samples", "target_distinct"))


@register("e14_profile_long")
def e14_profile_long(spark, sf_dir):
    """E14 on DM_NULL: shape, missing, describe, correlation and cardinality
    stacked long."""
    from ventana.operators.profile import profile_long
    return profile_long(B.dm_null(spark, sf_dir))


@register("a8_export_timestamped")
def a8_export_timestamped(spark, sf_dir):
    """The PREDS leaderboard exported under ``prefix_yyyyMMdd_HHmmss``
    and read back from the returned path."""
    from ventana.sources import io as A
    lb = H.evaluate(B.preds(spark, sf_dir))
    path = A.export_results(lb, work_dir(spark, "a8") + "/leaderboard")
    return spark.read.option("header", "true").csv(path)


@register("h11_cv_scores")
def h11_cv_scores(spark, sf_dir):
    """Per-fold test -MAE of OLS with mean and population std."""
    return CV.cv_scores(CV.cross_validate(LinearOLS(), _ols_folded(spark, sf_dir), FEATURES, "fold", 5,
                                          name="logistic_regression"))
