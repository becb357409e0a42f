"""K2: what a run leaves behind, and how it is taken up again."""
import json

import pytest
from pyspark.sql import functions as F

from ventana.operators import evaluate as H
from ventana.operators.prep import PrepConfig
from ventana.plans import pipeline
from ventana.plans.pipeline import RunConfig, run_training, winner
from ventana.plans.runstore import RunStore, frame_version
from ventana.sources import io as A

STAGES = ["bundle", "clean", "cross-validation", "load", "model-gradient_boosting", "model-logistic_regression", "prepare", "profile", "select",
          "summary", "test"]


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(300).select("id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"))
    return df.withColumn("target", 3 * F.col("a") - 2 * F.col("b") + 20)


def config(rounds=3):
    return RunConfig(models=("logistic_regression", "gradient_boosting"), cv_folds=2, prep=PrepConfig(usable_columns=("a", "b")),
                     model_params={"gradient_boosting": {"n_estimators": rounds}})


def test_a_run_writes_its_results_and_is_taken_up(spark, data, tmp_path, monkeypatch):
    folder = str(tmp_path / "run")
    whole = H.evaluate
    monkeypatch.setattr(pipeline.H, "evaluate", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("the driver is lost")))
    with pytest.raises(RuntimeError):
        run_training(data, "target", ["id"], config(), run_dir=folder)
    monkeypatch.setattr(pipeline.H, "evaluate", whole)
    first = {r["stage"]: r for r in RunStore(spark, folder).records()}
    assert sorted(first) == ["clean", "load", "model-gradient_boosting", "model-logistic_regression", "prepare", "profile"]
    run = run_training(data, "target", ["id"], config(), run_dir=folder)
    assert run.computed == ["select", "cross-validation", "test", "bundle", "summary"] and run.best_model == "logistic_regression"
    stages = {r["stage"]: r for r in run.stages}
    assert sorted(stages) == STAGES and all(stages[n] == first[n] for n in first)
    # what is on disk says the same as what came back
    saved = spark.read.option("header", "true").csv(f"{stages['select']['folder']}/leaderboard.csv").collect()
    assert [r.model for r in saved] == [r.model for r in run.leaderboard_val.collect()] == ["logistic_regression", "gradient_boosting"]
    text = "\n".join(r.value for r in spark.read.text(f"{stages['test']['folder']}/evaluation.json").collect())
    assert json.loads(text)["logistic_regression"]["mae"] == pytest.approx(run.test_metrics.first()["mae"])
    assert {r.section for r in run.profile.select("section").distinct().collect()} >= {"missing", "numeric_stats", "correlation"}
    assert run.cv.count() == 2 and dict(run.summary.collect())["best_model"] == "logistic_regression"
    got = {r.id: r.prediction_target for r in winner(spark, run).score(data.select("id", "a", "b")).collect()}
    assert got[7] == pytest.approx(3 * 7 - 2 * 2 + 20, abs=1e-6)
    # nothing changed: nothing is computed; one setting changed: what depends on it
    assert run_training(data.repartition(3), "target", ["id"], config(), run_dir=folder).computed == []
    again = run_training(data, "target", ["id"], config(4), run_dir=folder)
    assert again.computed == ["model-gradient_boosting", "select", "cross-validation", "test", "bundle", "summary"]
    other = run_training(data.where("id > 0"), "target", ["id"], config(4), run_dir=folder)
    assert other.computed[:5] == ["load", "profile", "clean", "prepare", "model-logistic_regression"]


def test_a_run_from_a_file_and_a_failing_ensemble(spark, data, tmp_path, monkeypatch):
    from ventana.models.ensembles import AdaBoostR2
    path, folder = str(tmp_path / "in.parquet"), str(tmp_path / "run")
    A.save_data(data, path, "parquet")
    cfg = RunConfig(models=("logistic_regression", "ada_boost"), cv_folds=2, prep=PrepConfig(usable_columns=("a", "b")),
                    model_params={"ada_boost": {"n_estimators": 2}})
    fit = AdaBoostR2.fit
    monkeypatch.setattr(AdaBoostR2, "fit", lambda *a, **k: 1 / 0)
    run = run_training(path, "target", ["id"], cfg, cross_validate_best=False, run_dir=folder)
    assert "ZeroDivisionError" in run.failed["ada_boost"] and run.leaderboard_val.count() == 1 and run.cv is None
    monkeypatch.setattr(AdaBoostR2, "fit", fit)
    run = run_training(path, "target", ["id"], cfg, cross_validate_best=False, run_dir=folder)
    assert run.computed[0] == "model-ada_boost" and not run.failed and run.leaderboard_val.count() == 2


def test_a_frame_has_one_version(spark, data):
    assert frame_version(data) == frame_version(data.repartition(5))
    assert frame_version(data) != frame_version(data.unionByName(data.limit(1)))
