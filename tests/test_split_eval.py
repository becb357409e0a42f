import math

import pytest
from pyspark.sql import functions as F

from ventana.operators import compare as I
from ventana.operators import evaluate as H
from ventana.operators import split as SP


def test_contiguous_folds_sizes_and_partition(spark):
    df = spark.range(23).withColumnRenamed("id", "k")
    out = SP.contiguous_folds(df, ["k"], 5)
    sizes = {r["fold"]: r["count"] for r in out.groupBy("fold").count().collect()}
    assert sizes == {0: 5, 1: 5, 2: 5, 3: 4, 4: 4}
    assert out.select("k").distinct().count() == 23


def test_row_index_dense_with_hot_key(spark):
    # a third of all rows share one order value: still split over chunks, still dense
    df = spark.range(300).select((F.when(F.col("id") < 100, F.lit(7)).otherwise(F.col("id"))).alias("k"), "id")
    out = SP.row_index(df, ["k"])
    idx = sorted(r["row_idx"] for r in out.collect())
    assert idx == list(range(300))


def test_split_deterministic_and_exact(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = {r["k"]: r["split"] for r in SP.split_data(df, "k").collect()}
    b = {r["k"]: r["split"] for r in SP.split_data(df.repartition(7), "k").collect()}
    assert a == b
    ex = SP.split_data(df, "k", exact=True)
    sizes = {r["split"]: r["n_rows"] for r in SP.split_sizes(ex).collect()}
    assert sizes == {"test": 200, "val": 200, "train": 600}


def test_metrics_guards(spark):
    df = spark.createDataFrame([("m", 1.0, 1.0), ("m", 1.0, 1.0), ("z", 0.0, 1.0)], "model string, y double, p double")
    lb = {r["model"]: r for r in H.evaluate(df).collect()}
    assert lb["m"]["r2"] == 1.0 and lb["m"]["mae"] == 0.0
    assert lb["z"]["r2"] == 0.0 and lb["z"]["mape"] == pytest.approx(1.0 / H.EPS)


# Stored leaderboard of the source pipeline's run (model, MAE, RMSE, R2).
PUBLISHED = [("Logistic Regression", 26.6062, 212.0000, 0.8297), ("Random Forest", 24.5287, 320.1195, 0.6118),
             ("SVM", 27.2102, 289.0653, 0.6834), ("Gradient Boosting", 25.4388, 230.4732, 0.7988),
             ("Neural Network", 25.7901, 208.9242, 0.8346), ("MLP Regressor", 32.0087, 302.2958, 0.6538),
             ("Voting Regressor", 25.4333, 252.5055, 0.7584), ("Stacking Regressor", 29.2259, 266.8792, 0.7302),
             ("AdaBoost Regressor", 411.0105, 494.3164, 0.0743), ("Bagging Regressor", 26.1447, 349.0695, 0.5384)]


def test_best_model_on_published_table(spark):
    lb = spark.createDataFrame(PUBLISHED, "model string, mae double, rmse double, r2 double")
    assert H.best_model(lb, "mae").collect()[0][0] == "Random Forest"
    assert H.best_model(lb, "r2").collect()[0][0] == "Neural Network"
    assert H.best_model(lb, "rmse").collect()[0][0] == "Neural Network"


def test_winner_and_differences(spark):
    rows = [("A", 0, "Random Forest", 24.5287, 320.1195, 0.6118), ("B", 1, "Deep_Swish_Adam", 31.02, 281.0225, 0.7008)]
    res = spark.createDataFrame(rows, "source string, source_rank int, model_name string, mae double, rmse double, r2 double")
    w = I.winner(res).collect()[0]
    assert w["winner_source"] == "A" and w["improvement_mae_pct"] == pytest.approx((31.02 - 24.5287) / 31.02 * 100)
    d = {r["metric"]: r for r in I.metric_differences(res).collect()}
    assert d["mae"]["winner"] == "A" and d["rmse"]["winner"] == "B" and d["r2"]["winner"] == "B"
    tie = spark.createDataFrame([("A", 0, "a", 1.0, 1.0, 1.0), ("B", 1, "b", 1.0, 1.0, 1.0)], res.schema)
    assert I.winner(tie).collect()[0]["winner_source"] == "A"


def test_architecture_leaderboard(spark):
    # Three rows of the stored architecture comparison.
    rows = [("Deep_ReLU_Adam", "{}", 43.429, 30.841, 22), ("Wide_Shallow_ReLU", "{}", 35.527, 29.240, 22),
            ("Bottleneck_Linear_AdamW", "{}", 37.294, 21.110, 49)]
    df = spark.createDataFrame(rows, "name string, config string, val_mae double, train_mae double, epochs_trained int")
    out = I.architecture_leaderboard(df).collect()
    assert [r["name"] for r in out] == ["Wide_Shallow_ReLU", "Bottleneck_Linear_AdamW", "Deep_ReLU_Adam"]
    assert out[0]["gap"] == pytest.approx(35.527 - 29.240)
    assert math.isclose(math.sqrt(44944.00), 212.0)  # RMSE = sqrt(MSE) in the stored results


def test_stratified_folds_balanced_per_class(spark):
    # one class holds 70% of rows: folds still split every class evenly
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 10 < 7).cast("int").alias("label"))
    out = SP.stratified_folds(df, "k", "label", 5)
    counts = {(r["label"], r["fold"]): r["count"] for r in out.groupBy("label", "fold").count().collect()}
    assert all(counts[(1, f)] == 140 for f in range(5)) and all(counts[(0, f)] == 60 for f in range(5))
