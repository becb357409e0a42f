"""K2-K4 -- the configuration, the training run and the profile run.

The training run is a chain of stages on shared storage (``plans.runstore``):
each is written once and read by the next, so a lost driver costs one stage.
The training rows are cached for the model loop. What comes to the driver is
fitted parameters, metrics and records of stages.
"""

from __future__ import annotations

import json
import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ventana.models import cv as CV
from ventana.models import shards
from ventana.models.base import parallel_map
from ventana.models.persist import load_model, save_model
from ventana.operators import clean as C
from ventana.operators import evaluate as H
from ventana.operators import profile as E
from ventana.operators import split as SP
from ventana.operators.prep import FeaturePrep, FeaturePrepModel, PrepConfig
from ventana.operators.schema import analysis_columns_fallback, normalize_column_names, normalize_name, prepare_target
from ventana.plans.runstore import RunStore, fingerprint, frame_version, path_version
from ventana.session import work_dir
from ventana.sources import io as A
from ventana.streaming.serve import Bundle

log = logging.getLogger(__name__)


# The source's tuning grids.
DEFAULT_GRIDS = {
    "logistic_regression": {},
    "random_forest": {"n_estimators": [100, 200, 300], "max_depth": [5, 10, 15, None],
                      "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4]},
    "svm": {"C": [0.1, 1, 10, 100], "kernel": ["linear", "rbf"], "gamma": ["scale", "auto"]},
    "gradient_boosting": {"n_estimators": [50, 100, 200], "learning_rate": [0.01, 0.05, 0.1],
                          "max_depth": [3, 5, 7], "min_samples_split": [2, 5, 10]},
    "neural_network": {"hidden_layer_sizes": [(300,), (400, 100), (100, 50, 25)], "learning_rate_init": [0.001, 0.01],
                       "alpha": [0.0001, 0.001], "activation": ["relu", "tanh"]},
    "mlp_regressor": {"hidden_layer_sizes": [(100,), (200,), (300,), (100, 50), (200, 100)], "activation": ["relu", "tanh"],
                      "learning_rate_init": [0.001, 0.01, 0.1], "alpha": [0.0001, 0.001, 0.01]},
}
# Folds per tuned model where they are not the run's cv_folds.
TUNING_FOLDS = {"gradient_boosting": 3, "mlp_regressor": 3}


@dataclass(frozen=True)
class RunConfig:
    """K4: the source's configuration groups. ``tune`` searches ``grids``
    (default: the source's) for every model that has one; ``tuning_rows``
    bounds the rows a chunked network is tuned on (default: all)."""
    val_size: float = 0.2
    test_size: float = 0.2
    random_state: int = 42
    cv_folds: int = 5
    prep: PrepConfig = field(default_factory=PrepConfig)
    filters: C.FilterConfig | None = None
    models: tuple[str, ...] = tuple(CV.CLASSIC_ORDER + CV.ENSEMBLE_ORDER)
    model_params: dict = field(default_factory=dict)
    grids: dict = field(default_factory=lambda: dict(DEFAULT_GRIDS))
    tune: bool = False
    tuning_rows: int | None = None
    exact_split: bool = False


@dataclass
class TrainingResult:
    leaderboard_val: DataFrame
    best_model: str
    test_metrics: DataFrame
    cv: DataFrame | None
    summary: DataFrame
    models: dict
    prep_model: object
    features: list[str]
    split_sizes: DataFrame
    clean_stats: DataFrame
    profile: DataFrame
    run_dir: str
    stages: list[dict]       # the manifest: a record per stage
    computed: list[str]      # the stages that this call computed; the others were taken up
    failed: dict[str, str]   # ensembles that could not be trained, and why


def run_training(source: DataFrame | str, target: str | list[str], key: list[str], config: RunConfig | None = None,
                 cross_validate_best: bool = True, run_dir: str | None = None, version: str | None = None) -> TrainingResult:
    """K2, the full run: load -> E14 -> B5/B6 -> C8 -> F1 -> D15 -> G13 (each
    model a stage) -> H7(val) -> H15 -> H10(best, train) -> test -> J4 -> H16.

    Everything is written below ``run_dir`` (default: a folder of its own in
    the shared checkpoint location): the profile (Parquet), cleaning
    statistics, leaderboard, fold scores and summary (CSV with header), the
    evaluation (JSON), every model and the winner's scoring bundle, each as a
    stage of the run's manifest (``RunStore``). Called again with the same
    folder, a run takes up the stages that are done for the same input and
    settings. ``source`` is a path (its version is that of its files) or a
    frame, which is written down first; ``version`` names a frame's content
    and spares the scan that would fingerprint it.
    """
    spark = SparkSession.getActiveSession() if isinstance(source, str) else source.sparkSession
    cfg = config or RunConfig()
    key = [normalize_name(k) for k in key]
    targets = [normalize_name(t) for t in ([target] if isinstance(target, str) else target)]
    resumable = run_dir is not None
    store = RunStore(spark, run_dir or work_dir(spark, "run"))

    if isinstance(source, str):
        at = fingerprint("load", path_version(spark, source))
        load = store.stage("load", at, lambda folder: {"source": source})
        data = A.load_data(spark, source)
    else:
        at = fingerprint("load", version or (frame_version(source) if resumable else "once"))
        load = store.stage("load", at, lambda folder: source.write.parquet(f"{folder}/data"))
        data = spark.read.schema(source.schema).parquet(f"{load['folder']}/data")

    table = lambda record, name: spark.read.parquet(f"{record['folder']}/{name}")
    # nothing waits for the profile: it is made beside the stages up to the selection
    beside = ThreadPoolExecutor(1)
    profiling = beside.submit(store.stage, "profile", fingerprint(at, "profile"), lambda folder: E.profile_long(data).write.parquet(f"{folder}/table"))

    def clean(folder: str) -> None:
        cleaned, stats = C.clean_rows(prepare_target(normalize_column_names(data), targets), cfg.filters)
        cleaned.write.parquet(f"{folder}/data")
        A.save_small_table(stats, f"{folder}/stats.csv")

    at = fingerprint(at, "clean", targets, asdict(cfg.filters) if cfg.filters else None)
    cleaned = store.stage("clean", at, clean)

    def prepare(folder: str) -> dict:
        split = SP.split_data(table(cleaned, "data"), key, cfg.val_size, cfg.test_size, cfg.random_state, cfg.exact_split)
        split.write.parquet(f"{folder}/split")
        split = spark.read.parquet(f"{folder}/split")
        pm = FeaturePrep(cfg.prep, passthrough=key + ["label", "split"]).fit(split.where("split = 'train'"))
        pm.save(spark, f"{folder}/prep")
        pm.transform(split, fit_stats=False).write.parquet(f"{folder}/data")
        return {"features": pm.features}

    at = fingerprint(at, "prepare", key, asdict(cfg.prep), cfg.val_size, cfg.test_size, cfg.random_state, cfg.exact_split)
    prepared = store.stage("prepare", at, prepare)
    feats, pm = prepared["facts"]["features"], FeaturePrepModel.load(spark, f"{prepared['folder']}/prep")
    rows = table(prepared, "data")
    train = rows.where("split = 'train'").cache()
    val, test = rows.where("split = 'val'"), rows.where("split = 'test'")

    models, failed, prints = {}, {}, {}
    params = {n: dict(p) for n, p in cfg.model_params.items()}
    if cfg.tune and not any(cfg.grids.get(n) for n in cfg.models):
        raise ValueError("tune=True, but none of the run's models has a grid")
    settings = lambda p: sorted((k, [(n, s.effective()) for n, s in v] if k == "bases" else repr(v)) for k, v in p.items())
    fresh = {}

    def train_one(n: str) -> dict:
        grid = cfg.grids.get(n) if cfg.tune else None
        spec = CV.get_spec(n, **params.get(n, {}))

        def fit(folder: str) -> dict:
            facts = {}
            try:
                if spec is None:
                    raise ValueError(f"unknown model {n}")
                if grid:
                    k = TUNING_FOLDS.get(n, cfg.cv_folds)
                    some = SP.tuning_sample(train, key, cfg.tuning_rows) if n == "mlp_regressor" else train
                    fitted, best, score, _ = CV.grid_search(spec, grid, train, feats, "fold", k, tuning=SP.contiguous_folds(some, key, k))
                    facts = {"best": best, "score": score}
                else:
                    fitted = spec.fit(train, feats, "label")
            except Exception as e:  # noqa: BLE001 -- as in the source, a run goes on without an ensemble that fails
                if n not in CV.ENSEMBLE_ORDER:
                    raise
                log.error("training %s failed: %s", n, e)
                return {"error": f"{type(e).__name__}: {e}"[:500]}
            save_model(spark, fitted, f"{folder}/model")
            fresh[n] = fitted
            return facts

        return store.stage(f"model-{n}", prints[n], fit)

    with shards.shared(train):
        # ensembles build on the tuned parameters of the others; the models of a wave are fitted side by side
        for wave in ([n for n in cfg.models if n not in CV.ENSEMBLE_ORDER], [n for n in cfg.models if n in CV.ENSEMBLE_ORDER]):
            for n in wave:
                if n in ("voting_regressor", "stacking_regressor"):
                    bases = [(m, CV.get_spec(m, **params.get(m, {}))) for m in ("logistic_regression", "random_forest", "svm", "gradient_boosting")]
                    params[n] = {"bases": bases} | ({"order_by": key} if n == "stacking_regressor" else {}) | params.get(n, {})
                prints[n] = fingerprint(at, "model", n, settings(params.get(n, {})), cfg.grids.get(n) if cfg.tune else None, cfg.cv_folds, cfg.tuning_rows)
            for n, record in zip(wave, parallel_map(train_one, wave, 1 if cfg.tune else 4)):
                if record["facts"].get("error"):
                    failed[n] = record["facts"]["error"]
                    continue
                params[n] = params.get(n, {}) | {k: tuple(v) if isinstance(v, list) else v for k, v in record["facts"].get("best", {}).items()}
                models[n] = fresh[n] if n in fresh else load_model(spark, f"{record['folder']}/model")

    profiled = profiling.result()
    beside.shutdown()
    order = ["load", "profile", "clean", "prepare", *[f"model-{n}" for n in prints]]
    store.done.sort(key=order.index)

    def select(folder: str) -> dict:
        lb = H.evaluate(CV.long_predictions(models, val, key))
        A.save_small_table(lb, f"{folder}/leaderboard.csv")
        return {"best": A.load_data(spark, f"{folder}/leaderboard.csv", lb.schema).first()["model"], "columns": lb.schema.json()}

    at = fingerprint("select", {n: p for n, p in prints.items() if n in models})
    selected = store.stage("select", at, select)
    best, shape = selected["facts"]["best"], T.StructType.fromJson(json.loads(selected["facts"]["columns"]))
    leaderboard = A.load_data(spark, f"{selected['folder']}/leaderboard.csv", shape)

    cv = None
    if cross_validate_best:
        def cross(folder: str) -> dict:
            # another seed than the split's: the training rows are a range of the split's hash
            folded = SP.hash_folds(train, key, cfg.cv_folds, cfg.random_state + 1)
            scores = CV.cross_validate(CV.get_spec(best, **params.get(best, {})), folded, feats, "fold", cfg.cv_folds, name=best)
            A.save_small_table(scores, f"{folder}/folds.csv")
            return {"columns": scores.schema.json()}

        crossed = store.stage("cross-validation", fingerprint(at, "cross", best, cfg.cv_folds, cfg.random_state), cross)
        cv = A.load_data(spark, f"{crossed['folder']}/folds.csv", T.StructType.fromJson(json.loads(crossed["facts"]["columns"]))).orderBy("fold")

    def evaluate(folder: str) -> dict:
        got = H.evaluate(CV.long_predictions({best: models[best]}, test, key)).first()
        metrics = got.asDict() if got else {}
        A.save_metrics_json({best: {k: v for k, v in metrics.items() if k != "model"}}, f"{folder}/evaluation.json")
        return metrics

    tested = store.stage("test", fingerprint(at, "test", best), evaluate)
    metrics = tested["facts"]
    test_m = spark.createDataFrame([tuple(metrics.get(f.name) for f in shape.fields)] if metrics else [], shape)

    usable = list(cfg.prep.usable_columns or feats)
    title = "+".join([target] if isinstance(target, str) else target)
    store.stage("bundle", fingerprint(at, "bundle", best, usable, title), lambda folder: {
        "model": Bundle(replace(pm, passthrough=[]), models[best], best, usable, title, {"tune": cfg.tune}).save(spark, f"{folder}/bundle") and best})

    def summarise(folder: str) -> None:
        out = H.run_summary(rows, feats, "label", [n for n in cfg.models if n in models], best, metrics or None, {"models": len(models), "tune": cfg.tune})
        A.save_small_table(out, f"{folder}/summary.csv")

    summed = store.stage("summary", fingerprint(at, "summary", best), summarise)
    train.unpersist()
    stats = A.load_data(spark, f"{cleaned['folder']}/stats.csv", "stat string, rows long")
    return TrainingResult(leaderboard, best, test_m, cv, A.load_data(spark, f"{summed['folder']}/summary.csv", "key string, value string"), models, pm, feats,
                          SP.split_sizes(rows), stats, table(profiled, "table"), store.path, store.records(), store.done, failed)


def winner(spark: SparkSession, result: TrainingResult) -> Bundle:
    """The run's scoring bundle (J4), as a later process would load it."""
    record = next(r for r in result.stages if r["stage"] == "bundle")
    return Bundle.load(spark, f"{record['folder']}/bundle")


def run_profile(df: DataFrame, usable: list[str], k: float = 1.5, t: float = 3.0, bins: int = 50,
                columns: list[str] | None = None) -> dict[str, DataFrame]:
    """K3: normalise names, choose columns (B9), then the statistics table
    (E6), histogram (E10), Gaussian overlay (E11), quartile lines (E12),
    box plots (E13) and the IQR vs z comparison (E9)."""
    d = normalize_column_names(df)
    d, cols = analysis_columns_fallback(d, usable)
    if columns:
        cols = [c for c in cols if c in set(columns)]
    statistics = E.column_statistics(d, cols)
    # the quartiles are found once; what else is wanted is an aggregate each, run when it is read
    known = {r["column_name"]: None if r["q1"] is None else [r["q1"], r["median"], r["q3"]] for r in statistics.collect()}
    return {"statistics": statistics, "histogram": E.histogram(d, cols, bins),
            "gaussian": E.gaussian_overlay(d, cols), "quartiles": E.quartile_lines(d, cols, k, quartiles=known),
            "boxplot": E.boxplot_summary(d, cols, k, quartiles=known), "comparison": E.outlier_comparison(d, cols, k, t, quartiles=known)}


def config_table(cfg: RunConfig, spark) -> DataFrame:
    """K4 as a key/value table (for reports and the run summary)."""
    flat = {}
    for k, v in asdict(cfg).items():
        if isinstance(v, dict):
            for k2, v2 in v.items():
                flat[f"{k}.{k2}"] = str(v2)
        else:
            flat[k] = str(v)
    return spark.createDataFrame(sorted(flat.items()), "key string, value string")
