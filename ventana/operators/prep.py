"""D1-D15 -- imputation, outlier treatment, scaling and feature selection
(after the split; never drops rows).

Fitting is one aggregate over the long form ``(column_name, value)`` (partial
aggregation before the shuffle; one final-merge task per column), and its
result is a *parameter table* with one row per column -- its size is bounded
by the schema width, never by the data. Transforming turns the parameters
into literals inside one ``select``, so it is a narrow, codegen'd
projection with no join and no shuffle.

Semantics follow pandas/scikit-learn where MLlib differs (exact median with
interpolation, population sigma, divide-by-1 for zero scale, constant column
-> 0 under min-max); see SURVEY section 2.4.
"""

from __future__ import annotations

import json
import logging
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ventana.functions.exprs import col, nan_to_null, numeric_columns
from ventana.functions.ordering import fill_forward_backward
from ventana.functions.quantiles import grouped_quantiles
from ventana.operators.profile import correlation_matrix, to_long
from ventana.operators.schema import (normalize_column_names, numeric_only, remove_categorical_columns,
                                      select_usable_columns)

log = logging.getLogger(__name__)

PARAM_SCHEMA = "column_name string, method string, center double, scale double"


def _feature_cols(df: DataFrame, columns: list[str] | None, exclude=()) -> list[str]:
    if columns is not None:
        return [c for c in columns if c in df.columns]
    return numeric_columns(df, exclude)


def column_params(df: DataFrame, columns: list[str], accuracy: int | None = None,
                  quantiles: bool = True) -> dict[str, dict]:
    """Every per-column statistic any D-op needs; p rows reach the driver
    (bounded by the schema width). ``quantiles=False`` skips the order
    statistics -- the only part that is not one aggregate -- when no median,
    IQR or robust scaling is configured; ``accuracy`` asks for approximate ones."""
    if not columns:
        return {}
    v = F.col("value")
    probs = [0.25, 0.5, 0.75]
    spread = [F.avg(v).alias("mean"), F.stddev_pop(v).alias("std_pop"), F.min(v).alias("min"), F.max(v).alias("max"),
              F.count(v).alias("n_valid"), F.count(F.lit(1)).alias("n_rows")]
    long = to_long(df, columns)
    if quantiles and not accuracy:
        rows = grouped_quantiles(long, ["column_name"], "value", probs, spread).collect()
    else:
        q = F.percentile_approx(v, F.array(*[F.lit(p) for p in probs]), accuracy) if quantiles else F.lit(None).cast("array<double>")
        rows = long.groupBy("column_name").agg(*spread, q.alias("_q")).collect()
    out = {}
    for r in rows:
        q = r["_q"] or [None, None, None]
        out[r["column_name"]] = {"mean": r["mean"], "std_pop": r["std_pop"], "min": r["min"], "max": r["max"],
                                 "q1": q[0], "median": q[1], "q3": q[2], "n_valid": r["n_valid"],
                                 "n_rows": r["n_rows"]}
    return out


def _lit(x) -> Column:
    return F.lit(None).cast("double") if x is None else F.lit(float(x))


def _apply(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    return df.select(*[exprs[c].alias(c) if c in exprs else col(c) for c in df.columns])


# ------------------------------------------------------------ D1-D5 missing values

def impute(df: DataFrame, method: str = "mean", columns: list[str] | None = None,
           params: dict | None = None, accuracy: int | None = None) -> DataFrame:
    """D1 mean / D2 exact median: NULLs of each numeric column take the
    column's statistic (an all-NULL column stays NULL)."""
    cols = _feature_cols(df, columns)
    p = params or column_params(df, cols, accuracy)
    key = {"mean": "mean", "median": "median"}[method]
    return _apply(df, {c: F.coalesce(nan_to_null(col(c).cast("double")), _lit(p[c][key])) for c in cols})


def forward_back_fill(df: DataFrame, order_by: list[str], columns: list[str] | None = None,
                      partition_by: list[str] | None = None) -> DataFrame:
    """D3: forward fill then back fill in ``order_by`` order (required:
    a DataFrame has no row order of its own)."""
    cols = columns if columns is not None else [c for c in df.columns if c not in order_by + (partition_by or [])]
    return fill_forward_backward(df, cols, order_by, partition_by)


def residual_fill(df: DataFrame, columns: list[str] | None = None, params: dict | None = None) -> DataFrame:
    """Leftover NULLs -> column mean; all-NULL column -> 0."""
    cols = _feature_cols(df, columns)
    p = params or column_params(df, cols, quantiles=False)
    return _apply(df, {c: F.coalesce(nan_to_null(col(c).cast("double")), _lit(p[c]["mean"]), F.lit(0.0)) for c in cols})


def missing_policy(method: str | None) -> str | None:
    """Row drops are not allowed after the split; 'drop' becomes 'mean'."""
    if method == "drop":
        log.warning("rows stay after the split: missing values are filled with the column mean, not dropped")
        return "mean"
    return method


# ------------------------------------------------------------ D6-D8 outliers

def iqr_winsorise(df: DataFrame, columns: list[str] | None = None, k: float = 1.5,
                  params: dict | None = None, accuracy: int | None = None) -> DataFrame:
    """Clip to ``[Q1 - k*IQR, Q3 + k*IQR]``; NULL and NaN are missing and stay so, as NULL."""
    cols = _feature_cols(df, columns)
    p = params or column_params(df, cols, accuracy)
    ex = {}
    for c in cols:
        q1, q3 = p[c]["q1"], p[c]["q3"]
        if q1 is None:
            continue
        lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        x = nan_to_null(col(c).cast("double"))
        # greatest() and least() skip NULLs: by themselves they would fill the cell with a fence
        ex[c] = F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))
    return _apply(df, ex)


def zscore_replace(df: DataFrame, columns: list[str] | None = None, t: float = 1.5,
                   params: dict | None = None) -> DataFrame:
    """``|x - mu| / sigma_pop > t`` -> column mean. A column with any
    NULL, or with sigma 0, is left as it is (scipy's z is NaN there)."""
    cols = _feature_cols(df, columns)
    p = params or column_params(df, cols, quantiles=False)
    ex = {}
    for c in cols:
        s = p[c]
        if s["n_valid"] != s["n_rows"] or not s["std_pop"]:
            continue
        x = col(c).cast("double")
        ex[c] = F.when(F.abs(x - F.lit(s["mean"])) > F.lit(t * s["std_pop"]), F.lit(float(s["mean"]))).otherwise(x)
    return _apply(df, ex)


def clip_negative(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``greatest(x, 0)`` on every feature column (NULL stays NULL)."""
    cols = _feature_cols(df, columns)
    return _apply(df, {c: F.when(col(c) < 0, F.lit(0.0)).otherwise(nan_to_null(col(c).cast("double"))) for c in cols})


def negative_count(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """D8 counter: total negative cells, one aggregate."""
    cols = _feature_cols(df, columns)
    total = sum((F.count_if(col(c) < 0) for c in cols), F.lit(0))
    return df.agg(total.cast("long").alias("negative_values"))


# ------------------------------------------------------------ D9-D12 scaling

_EPS = 2.0 ** -52
SCALERS = {"standardscaler": "standard", "standard": "standard", "minmaxscaler": "minmax",
           "minmax": "minmax", "robust": "robust", "robustscaler": "robust"}


def fit_scaler(df: DataFrame, method: str, columns: list[str] | None = None,
               params: dict | None = None, accuracy: int | None = None) -> DataFrame:
    """D9-D11 fit -> parameter table ``(column_name, method, center, scale)``.
    standard: mean, sigma_pop; minmax: min, max - min; robust: median, IQR;
    a zero (or undefined) scale becomes 1."""
    spark = df.sparkSession
    m = SCALERS.get(method)
    cols = _feature_cols(df, columns)
    if m is None:
        return spark.createDataFrame([], PARAM_SCHEMA)
    p = params or column_params(df, cols, accuracy, quantiles=(m == "robust"))
    rows = []
    for c in cols:
        s = p[c]
        if m == "standard":
            center, scale = s["mean"], s["std_pop"]
            # a spread that rounding alone explains is none
            if scale and scale * scale <= _EPS * s["n_valid"] * scale * scale + (s["n_valid"] * abs(center) * _EPS) ** 2:
                scale = None
        elif m == "minmax":
            center = s["min"]
            scale = None if s["min"] is None else s["max"] - s["min"]
        else:
            center = s["median"]
            scale = None if s["q1"] is None else s["q3"] - s["q1"]
        rows.append((c, m, center, scale if scale else 1.0))
    return spark.createDataFrame(rows, PARAM_SCHEMA)


def apply_scaler(df: DataFrame, params: DataFrame | list) -> DataFrame:
    """D12 transform: ``(x - center) / scale`` with the stored literals;
    columns without parameters pass through."""
    rows = params.collect() if isinstance(params, DataFrame) else params
    ex = {}
    for r in rows:
        c = r["column_name"]
        if c in df.columns:
            ex[c] = (col(c).cast("double") - _lit(r["center"])) / _lit(r["scale"])
    return _apply(df, ex)


def scale(df: DataFrame, method: str, columns: list[str] | None = None,
          accuracy: int | None = None) -> DataFrame:
    return apply_scaler(df, fit_scaler(df, method, columns, accuracy=accuracy))


# ------------------------------------------------------------ D13-D14 selection

def constant_columns(df: DataFrame, columns: list[str] | None = None) -> list[str]:
    """D13 test: exactly one distinct non-NULL value (``min = max`` and at
    least one value: one aggregate, no distinct shuffle). All-NULL is kept."""
    cols = columns if columns is not None else df.columns
    if not cols:
        return []
    r = df.agg(*[((F.min(col(c)) == F.max(col(c))) & (F.count(col(c)) > 0)).alias(f"_k{i}")
                 for i, c in enumerate(cols)]).collect()[0]
    return [c for i, c in enumerate(cols) if r[f"_k{i}"]]


def remove_constant_features(df: DataFrame, columns: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """D13 ``remove_constant_features`` -> (frame, dropped)."""
    dropped = constant_columns(df, columns)
    return df.drop(*dropped), dropped


def correlated_columns(df: DataFrame, threshold: float = 0.95, columns: list[str] | None = None) -> list[str]:
    """Column j goes when any earlier column i has ``|corr| > thr``
    (even if i itself goes); an undefined correlation never drops."""
    cols = _feature_cols(df, columns)
    corr = correlation_matrix(df, cols)
    pos = {c: i for i, c in enumerate(cols)}
    hits = corr.filter((F.col("column_a") != F.col("column_b")) & (F.abs("corr") > threshold)) \
               .select("column_b").distinct().collect()
    return sorted({r[0] for r in hits}, key=lambda c: pos[c])


def correlate_features(df: DataFrame, threshold: float = 0.95, columns: list[str] | None = None) -> DataFrame:
    return df.drop(*correlated_columns(df, threshold, columns))


# ------------------------------------------------------------ D15 pipeline

@dataclass(frozen=True)
class PrepConfig:
    """The source's DATA_PARAMS plus the column switches of process_pipeline."""
    handle_missing_values: str | None = "mean"
    outlier_method: str | None = None
    outlier_threshold: float = 1.5
    feature_scaling: str | None = "standardscaler"
    select_usable: bool = True
    usable_columns: tuple[str, ...] | None = None
    remove_categorical: bool = True
    categorical_list: tuple[str, ...] | None = None
    order_by: tuple[str, ...] = ()
    stats_from: str = "frame"  # 'frame' = the source's behaviour; 'train' = reuse fitted statistics
    accuracy: int | None = None


def _needs_quantiles(cfg: PrepConfig) -> bool:
    return (cfg.handle_missing_values == "median" or cfg.outlier_method == "iqr"
            or SCALERS.get(cfg.feature_scaling or "") == "robust")


@dataclass
class FeaturePrepModel:
    """Fitted state (D12): feature list, per-column statistics used for
    imputation/outliers when ``stats_from='train'``, scaler parameters."""
    config: PrepConfig
    features: list[str]
    stats: dict = field(default_factory=dict)
    scaler_params: list[tuple] = field(default_factory=list)
    passthrough: list[str] = field(default_factory=list)
    outlier_stats: dict = field(default_factory=dict)

    def _typed(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """The kept columns and the features as doubles; NaN is missing."""
        return df.select(*[col(c) for c in keep], *[nan_to_null(col(c).cast("double")).alias(c) for c in self.features])

    def _imputed(self, x: DataFrame, st: dict) -> tuple[DataFrame, bool]:
        method = missing_policy(self.config.handle_missing_values)
        if method in ("mean", "median"):
            return impute(x, method, self.features, st), True
        if method in ("forward_fill", "ffill"):
            if not self.config.order_by:
                raise ValueError("forward_fill needs PrepConfig.order_by")
            return forward_back_fill(x, list(self.config.order_by), self.features), True
        return x, False

    def measure_outliers(self, df: DataFrame, stats: dict) -> dict:
        """Outlier statistics of the frame AFTER imputation."""
        if not self.config.outlier_method:
            return {}
        df = normalize_column_names(df)
        x, _ = self._imputed(self._typed(df, [c for c in self.config.order_by if c in df.columns and c not in self.features]), stats)
        return column_params(x, self.features, self.config.accuracy, _needs_quantiles(self.config))

    def transform(self, df: DataFrame, fit_stats: bool | None = None, keep: list[str] | None = None,
                  stats: dict | None = None) -> DataFrame:
        """``fit_stats``: compute imputation and outlier statistics on this
        frame (the source's behaviour) instead of using the stored ones;
        ``stats`` passes the imputation statistics already computed on exactly
        this frame (then the stored outlier statistics are this frame's too)."""
        cfg = self.config
        df = normalize_column_names(df)
        keep = [c for c in self.passthrough + list(keep or []) if c in df.columns]
        missing = [c for c in self.features if c not in df.columns]
        if missing:
            raise ValueError(f"Missing feature columns: {missing}")
        x = self._typed(df, keep)
        frame_stats = cfg.stats_from == "frame" if fit_stats is None else fit_stats
        feats = self.features
        nq = _needs_quantiles(cfg)
        if stats is not None:
            st = stats
        else:
            st = column_params(x, feats, cfg.accuracy, nq) if frame_stats else self.stats
        x, imputed = self._imputed(x, st)
        if cfg.outlier_method:
            # measured after imputation: filled cells count, and no column holds NULLs any more
            st2 = column_params(x, feats, cfg.accuracy, nq) if frame_stats and stats is None else self.outlier_stats
            if cfg.outlier_method == "iqr":
                x = iqr_winsorise(x, feats, cfg.outlier_threshold, st2)
            elif cfg.outlier_method == "zscore":
                x = zscore_replace(x, feats, cfg.outlier_threshold, st2)
        x = clip_negative(x, feats)
        if imputed:
            # after imputation only all-NULL columns still hold NULLs, and
            # their mean is NULL too: D4 reduces to 0, no statistics needed
            x = _apply(x, {c: F.coalesce(col(c), F.lit(0.0)) for c in feats})
        else:
            st3 = column_params(x, feats, quantiles=False) if frame_stats else st
            x = residual_fill(x, feats, st3)
        if self.scaler_params:
            x = apply_scaler(x, [dict(zip(["column_name", "method", "center", "scale"], r))
                                 for r in self.scaler_params])
        return x

    # -- D12 persistence: parameters as parquet + config as JSON
    def save(self, spark: SparkSession, path: str) -> None:
        meta = {"config": asdict(self.config), "features": self.features, "passthrough": self.passthrough,
                "stats": self.stats, "outlier_stats": self.outlier_stats}
        spark.createDataFrame([(json.dumps(meta, default=float),)], "meta string") \
             .coalesce(1).write.mode("overwrite").text(f"{path}/meta")
        spark.createDataFrame(self.scaler_params or [], PARAM_SCHEMA) \
             .coalesce(1).write.mode("overwrite").parquet(f"{path}/scaler")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FeaturePrepModel":
        meta = json.loads(spark.read.text(f"{path}/meta").collect()[0][0])
        cfg = meta["config"]
        for k in ("usable_columns", "categorical_list", "order_by"):
            if cfg.get(k) is not None:
                cfg[k] = tuple(cfg[k])
        params = [tuple(r) for r in spark.read.parquet(f"{path}/scaler").collect()]
        return FeaturePrepModel(PrepConfig(**cfg), meta["features"], meta["stats"], params, meta["passthrough"],
                                meta["outlier_stats"])


class FeaturePrep:
    """D15 ``process_pipeline``: B1, B2, B3, D5 + (D1/D2/D3), D6/D7 when
    configured, B4, D8, D4, D9-D11. Row count is preserved; ``passthrough``
    columns (the row key, the label) are carried along untouched."""

    def __init__(self, config: PrepConfig | None = None, passthrough: list[str] | None = None):
        self.config = config or PrepConfig()
        self.passthrough = list(passthrough or [])

    def select_features(self, df: DataFrame) -> list[str]:
        cfg = self.config
        df = normalize_column_names(df)
        keep = [c.lower() for c in self.passthrough]
        body = df.drop(*[c for c in keep if c in df.columns])
        if cfg.select_usable and cfg.usable_columns:
            body, _ = select_usable_columns(body, list(cfg.usable_columns))
        if not body.columns:
            raise ValueError(f"none of the frame's columns is among the usable ones: {list(cfg.usable_columns or ())}")
        if cfg.remove_categorical:
            body, _ = remove_categorical_columns(body, list(cfg.categorical_list) if cfg.categorical_list else None)
        body, _ = numeric_only(body)
        if not body.columns:
            raise ValueError("selection left no numeric column to train on")
        return body.columns

    def fit(self, df: DataFrame) -> FeaturePrepModel:
        """Raw per-column statistics (kept for scoring rows that have none of
        their own), outlier statistics after imputation, then the scaler
        statistics of the prepared features; ``df`` is computed once."""
        feats = self.select_features(df)
        passthrough = [c.lower() for c in self.passthrough]
        model = FeaturePrepModel(self.config, feats, {}, [], passthrough)
        named = normalize_column_names(df)
        order = [c for c in self.config.order_by if c in named.columns and c not in feats and c not in passthrough]
        # every statistic reads the same narrow columns: the input is computed once
        x = model._typed(named, [c for c in passthrough if c in named.columns] + order).persist()
        try:
            model.stats = column_params(x, feats, self.config.accuracy, _needs_quantiles(self.config))
            model.outlier_stats = model.measure_outliers(x, model.stats)
            train = model.transform(x, fit_stats=True, stats=model.stats)
            sp = fit_scaler(train, self.config.feature_scaling or "", feats, accuracy=self.config.accuracy)
            model.scaler_params = [tuple(r) for r in sp.collect()]
        finally:
            x.unpersist()
        return model

    def fit_transform(self, df: DataFrame) -> tuple[FeaturePrepModel, DataFrame]:
        m = self.fit(df)
        return m, m.transform(df, fit_stats=True, stats=m.stats)


__all__ = ["column_params", "impute", "forward_back_fill", "residual_fill", "missing_policy",
           "iqr_winsorise", "zscore_replace", "clip_negative", "negative_count", "fit_scaler", "apply_scaler",
           "scale", "constant_columns", "remove_constant_features", "correlated_columns",
           "correlate_features", "PrepConfig", "FeaturePrep", "FeaturePrepModel"]
