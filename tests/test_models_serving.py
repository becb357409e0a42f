import os

import pytest
from pyspark.sql import functions as F

from ventana.models import cv as CV
from ventana.models.classic import LinearOLS
from ventana.models.persist import load_model, save_model
from ventana.operators.evaluate import evaluate_one
from ventana.operators.prep import FeaturePrep, PrepConfig
from ventana.session import work_dir
from ventana.streaming.filedrop import accounts, score_stream, scored
from ventana.streaming.serve import Bundle, score_one


@pytest.fixture(scope="module")
def planted(spark):
    df = spark.range(2000).select("id", (F.col("id") % 17).cast("double").alias("a"),
                                  (F.col("id") % 5).cast("double").alias("b"))
    return df.withColumn("label", 3 * F.col("a") - 2 * F.col("b") + 1).cache()


def test_ols_recovers_plant(spark, planted):
    m = LinearOLS().fit(planted, ["a", "b"])
    lm = m.model.stages[-1]
    assert list(lm.coefficients.toArray()) == pytest.approx([3.0, -2.0], abs=1e-6)
    assert lm.intercept == pytest.approx(1.0, abs=1e-6)


SMALL = {"logistic_regression": {}, "random_forest": {"n_estimators": 5, "max_depth": 5}, "svm": {"kernel": "rbf", "rounds": 5},
         "gradient_boosting": {"n_estimators": 10}, "neural_network": {"rounds": 4}, "mlp_regressor": {"rounds": 4, "hidden_layer_sizes": (20,)},
         "ada_boost": {"n_estimators": 5}, "bagging_regressor": {"n_estimators": 3, "max_depth": 5}}


def small_spec(name):
    bases = [(n, CV.get_spec(n, **SMALL[n])) for n in ("logistic_regression", "gradient_boosting", "svm")]
    more = {"voting_regressor": {"bases": bases}, "stacking_regressor": {"bases": bases, "cv": 2, "order_by": ["id"]}}
    return CV.get_spec(name, **(SMALL | more)[name])


@pytest.mark.parametrize("name", [*CV.CLASSIC_ORDER, *CV.ENSEMBLE_ORDER, "svm linear"])
def test_models_beat_mean_and_survive_a_bundle(spark, planted, name):
    """Every model beats the mean; saved and loaded it predicts the same."""
    base = planted.agg(F.avg(F.abs(F.col("label") - F.lit(planted.agg(F.avg("label")).first()[0])))).first()[0]
    spec = CV.get_spec("svm", kernel="linear") if name == "svm linear" else small_spec(name)
    m = spec.fit(planted, ["a", "b"])
    out = {r.id: r.prediction for r in m.transform(planted).select("id", "prediction").collect()}
    assert evaluate_one(m.transform(planted)).first()["mae"] < base
    path = work_dir(spark, "model-test")
    save_model(spark, m, path)
    again = {r.id: r.prediction for r in load_model(spark, path).transform(planted).select("id", "prediction").collect()}
    assert out == pytest.approx(again, abs=1e-9) and len(out) == 2000


@pytest.mark.parametrize("spec", [("svm", {"kernel": "rbf", "rounds": 3}), ("neural_network", {"rounds": 2, "local_epochs": 5})])
def test_fits_do_not_depend_on_partitions(spark, planted, spec):
    got = []
    for n in (1, 8):
        m = CV.get_spec(spec[0], **spec[1], shard_rows=30).fit(planted.repartition(n), ["a", "b"])
        got.append([r[0] for r in m.transform(planted.orderBy("id").limit(20)).orderBy("id").select("prediction").collect()])
    assert got[0] == pytest.approx(got[1], abs=1e-6)


def test_network_of_any_size_has_no_prediction_for_a_missing_feature(spark, planted):
    from ventana.models.mlp import _init, _shapes, mlp_fitted
    holes = spark.createDataFrame([(1.0, None), (1.0, 2.0), (float("nan"), 2.0)], "a double, b double")
    for hidden in ((3,), (200,)):
        shapes = _shapes(2, hidden)
        got = [r.prediction for r in mlp_fitted(_init(shapes, 1), shapes, "relu", ["a", "b"], "m").transform(holes).collect()]
        assert got[0] is None and got[1] is not None and got[2] is None


def test_unknown_parameters_and_missing_training_values_raise(spark, planted):
    with pytest.raises(TypeError):
        CV.get_spec("random_forest", bogus=1)
    with pytest.raises(TypeError):
        CV.get_spec("neural_network", bogus=1)
    with pytest.raises(ValueError):
        CV.get_spec("neural_network").fit(planted.withColumn("a", F.when(F.col("id") > 5, F.col("a"))), ["a", "b"])


def test_tuned_run(spark):
    """tune=True searches its grids, and raises when there is nothing to search."""
    from ventana.plans.pipeline import RunConfig, run_training
    df = spark.range(400).select("id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"))
    df = df.withColumn("target", 3 * F.col("a") - 2 * F.col("b") + 1)
    cfg = RunConfig(models=("logistic_regression", "gradient_boosting", "voting_regressor"), tune=True, cv_folds=2,
                    grids={"gradient_boosting": {"n_estimators": [2, 6], "min_samples_split": [2, 3]}},
                    model_params={"svm": {"kernel": "linear", "rounds": 2}, "random_forest": {"n_estimators": 2, "max_depth": 3}},
                    prep=PrepConfig(usable_columns=("a", "b")))
    run = run_training(df, "target", ["id"], cfg)
    assert run.leaderboard_val.count() == 3 and run.best_model == "logistic_regression"
    assert run.test_metrics.first()["mae"] < 1.5 and run.cv.count() == 2
    with pytest.raises(ValueError):
        run_training(df, "target", ["id"], RunConfig(models=("logistic_regression",), tune=True))


def test_cross_val_predict_covers_each_row_once(spark, planted):
    from ventana.operators.split import hash_folds
    f = hash_folds(planted, "id", 5)
    out = CV.cross_val_predict(LinearOLS(), f, ["a", "b"], "fold", k=5)
    assert out.count() == 2000 and out.select("id").distinct().count() == 2000


def test_bundle_batch_equals_stream(spark, planted):
    tr = planted.withColumnRenamed("a", "2024-1").withColumnRenamed("b", "2024-2")
    prep = FeaturePrep(PrepConfig(usable_columns=("2024-1", "2024-2"), stats_from="train"), passthrough=["id", "label"])
    pm, prepared = prep.fit_transform(tr)
    model = LinearOLS().fit(prepared, pm.features)
    path = work_dir(spark, "bundle-test")
    Bundle(pm, model, "logistic_regression", ["2024-1", "2024-2"], "2025-9").save(spark, path)
    b = Bundle.load(spark, path)
    feats = tr.filter("id < 50").select("2024-1", "2024-2")
    batch = sorted(tuple(round(x, 6) for x in r) for r in b.score(feats).collect())
    base = work_dir(spark, "stream-test")
    feats.write.option("header", "true").csv(f"{base}/in")
    q = score_stream(spark, b, f"{base}/in", f"{base}/out", checkpoint=f"{base}/ck")
    q.awaitTermination()
    stream = sorted(tuple(round(x, 6) for x in r) for r in scored(spark, f"{base}/out").collect())
    assert batch == stream and len(batch) == 50
    one = score_one(spark, b, {"2024-1": 2.0}).collect()[0]
    assert "prediction_2025-9" in one.asDict()


@pytest.mark.parametrize("name", ["j1_batch_scoring", "j2_stream_scoring"])
def test_scoring_reads_every_row(spark, name):
    import __spark_entry__ as E
    from ventana.sources import bindings as B
    want = sorted(r.product_id for r in B.dm(spark, "/root/testdata/sf0.001").select("product_id").collect())
    got = E.queries()[name](spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.product_id for r in got) == want and all(r["prediction_m2001_09"] is not None for r in got)
