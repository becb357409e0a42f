"""h15 and k2 train the models of the untuned run of the source."""

from ventana.models import cv
from ventana.plans import pipeline, queries_models


def test_registered_runs_train_models_of_the_sources_size(spark, monkeypatch):
    """h15 and k2: no parameter makes a model smaller than the untuned run's of the source."""
    seen = []
    monkeypatch.setattr(queries_models, "run_training", lambda *a: seen.append(a))
    queries_models._run(spark, "/root/testdata/sf0.001")
    cfg = seen[0][3]
    assert cfg.models == pipeline.RunConfig().models and len(cfg.models) == 10 and not cfg.model_params and cfg.cv_folds == 5
    limits = cv.get_spec("random_forest").limits()
    assert limits.trees == 100 and cv.get_spec("gradient_boosting").rules().rounds == 100 and cv.get_spec("bagging_regressor").limits().trees == 10
