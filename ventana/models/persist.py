"""Saving and loading any fitted model: a JSON description, MLlib pipelines
beside it, and the parts of an ensemble in sub-folders."""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from ventana.models.adaboost import MedianOfTrees
from ventana.models.base import ExprFitted, Fitted, MLlibFitted
from ventana.models.boosting import Boosted, Tree
from ventana.models.ensembles import _Chain
from ventana.models.forest import BODY, FittedForest
from ventana.models.mlp import _ArrowMLP, mlp_fitted
from ventana.models.svr import KernelSVR, linear_svr


def save_model(spark: SparkSession, model: Fitted, path: str) -> None:
    meta = {"name": model.name, "features": list(model.features)}
    if isinstance(model, MLlibFitted):
        meta["kind"] = "mllib"
        model.save(f"{path}/pipeline")
    elif isinstance(model, Boosted):
        meta |= {"kind": "boosted", "state": model.state}
    elif isinstance(model, _ArrowMLP):
        meta |= {"kind": "mlp", "state": model.state}
    elif isinstance(model, KernelSVR):
        meta |= {"kind": "rbf_svr", "state": model.state}
    elif isinstance(model, ExprFitted) and {"w", "b", "mu", "sd"} <= set(model.state):
        meta |= {"kind": "linear_svr", "state": model.state}
    elif isinstance(model, _Chain):
        meta |= {"kind": "chain", "weights": model.weights, "intercept": model.intercept, "bases": [n for n, _ in model.bases]}
        for i, (_, base) in enumerate(model.bases):
            save_model(spark, base, f"{path}/base{i}")
    elif isinstance(model, FittedForest):
        meta |= {"kind": "forest", "trees": model.state}
        model.bodies.write.mode("overwrite").parquet(f"{path}/bodies")
    elif isinstance(model, MedianOfTrees):
        meta |= {"kind": "median_of_trees", "weights": model.weights, "trees": [t.state for t in model.trees]}
    else:
        raise ValueError(f"model {model.name} cannot be saved")
    spark.createDataFrame([(json.dumps(meta, default=float),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> Fitted:
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    kind, name, feats, st = meta["kind"], meta["name"], meta["features"], meta.get("state", {})
    if kind == "mllib":
        return MLlibFitted(PipelineModel.load(f"{path}/pipeline"), feats, name)
    if kind == "boosted":
        return Boosted.of(st, feats, name)
    if kind == "mlp":
        return mlp_fitted(np.array(st["theta"]), [tuple(s) for s in st["shapes"]], st["act"], feats, name)
    if kind == "rbf_svr":
        return KernelSVR(st["gamma"], st["marks"], st["weights"], st["intercept"], feats, name)
    if kind == "linear_svr":
        return linear_svr(st["w"], st["b"], st["mu"], st["sd"], feats, name)
    if kind == "chain":
        bases = [(n, load_model(spark, f"{path}/base{i}")) for i, n in enumerate(meta["bases"])]
        return _Chain(bases, meta["weights"], meta["intercept"], feats, name)
    if kind == "median_of_trees":
        return MedianOfTrees([Tree.load(t) for t in meta["trees"]], meta["weights"], feats, name)
    if kind == "forest":
        return FittedForest.of(meta["trees"], spark.read.schema(BODY).parquet(f"{path}/bodies"), feats, name)
    raise ValueError(f"unknown kind of model {kind}")
