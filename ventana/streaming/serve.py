"""J1, J3, J4 -- scoring with a saved bundle (as files arrive: ``filedrop``).

A bundle is a folder: the fitted preparation state (parameter table +
JSON), the model (MLlib ``PipelineModel`` or the fitted literals of our own
models), and ``meta`` (config, usable columns, model name). Batch and
streaming scoring share one ``score`` function, so the same files give the
same predictions either way (J1 = J2).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventana.models.base import PRED, Fitted
from ventana.models.persist import load_model, save_model
from ventana.operators.prep import FeaturePrepModel
from ventana.operators.schema import literal_row_frame, validate_columns


class Bundle:
    """Everything needed to score new rows."""

    def __init__(self, prep: FeaturePrepModel, model: Fitted, model_name: str, usable_columns: list[str],
                 target_name: str = "2025-9", config: dict | None = None):
        if not usable_columns:
            raise ValueError("bundle has no usable_columns")
        self.prep, self.model, self.model_name = prep, model, model_name
        self.usable_columns, self.target_name, self.config = list(usable_columns), target_name, config or {}

    # ---------------------------------------------------------------- J4
    def save(self, spark: SparkSession, path: str) -> str:
        self.prep.save(spark, f"{path}/prep")
        save_model(spark, self.model, f"{path}/model")
        meta = {"model_name": self.model_name, "usable_columns": self.usable_columns,
                "target_name": self.target_name, "config": self.config}
        spark.createDataFrame([(json.dumps(meta, default=float),)], "meta string").coalesce(1) \
             .write.mode("overwrite").text(f"{path}/meta")
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Bundle":
        meta = json.loads(spark.read.text(f"{path}/meta").collect()[0][0])
        if not meta.get("usable_columns"):
            raise ValueError("bundle has no usable_columns")
        prep = FeaturePrepModel.load(spark, f"{path}/prep")
        model = load_model(spark, f"{path}/model")
        return Bundle(prep, model, meta["model_name"], meta["usable_columns"], meta["target_name"],
                      meta.get("config"))

    # ---------------------------------------------------------------- J1
    def score(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Check the columns, prepare with the stored state, predict, and
        append ``prediction_<target>`` to the ORIGINAL columns. Row-wise only
        (``stats_from='train'`` in the prep state means no aggregate runs),
        so the same function serves a stream."""
        ok, msg = validate_columns(df, self.usable_columns)
        if not ok:
            raise ValueError(msg)
        from ventana.operators.schema import normalize_name
        feats = set(self.prep.features)
        # originals ride along under neutral names; predictions stay aligned
        # row by row in one narrow plan (no key join)
        base = df.select(*[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(df.columns)],
                         *[F.col(f"`{c}`").alias(normalize_name(c)) for c in df.columns if normalize_name(c) in feats])
        keep = [f"_o{i}" for i in range(len(df.columns))]
        x = self.prep.transform(base, fit_stats=False, keep=keep)
        scored = self.model.with_output(PRED).transform(x)
        out_name = f"prediction_{self.target_name}"
        return scored.select(*[F.col(f"_o{i}").alias(c) for i, c in enumerate(df.columns)],
                             F.col(PRED).alias(out_name))


def score_one(spark: SparkSession, bundle: Bundle, values: dict | None = None) -> DataFrame:
    """One record of the usable columns (missing ones default to 0.0)."""
    return bundle.score(literal_row_frame(spark, bundle.usable_columns, values))
