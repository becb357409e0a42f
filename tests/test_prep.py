import pytest
from pyspark.sql import functions as F

from ventana.operators import prep as D


def _vals(df, c="x"):
    return [r[c] for r in df.orderBy("id").collect()]


def test_exact_median_imputation(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, 4.0), (4, 9.0), (5, None)], "id long, x double")
    assert _vals(D.impute(df, "median", ["x"]))[-1] == 3.5


def test_scalers_follow_sklearn(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 2.0, 2.0, 9.0, 4.0])], "id long, x double")
    assert _vals(D.scale(df, "standardscaler", ["x"]))[0] == pytest.approx(-0.9058, abs=1e-4)
    assert _vals(D.scale(df, "robust", ["x"]))[0] == pytest.approx(-0.5)
    const = spark.createDataFrame([(i, 5.0) for i in range(3)], "id long, x double")
    assert _vals(D.scale(const, "minmaxscaler", ["x"])) == [0.0, 0.0, 0.0]
    assert _vals(D.scale(const, "standardscaler", ["x"])) == [0.0, 0.0, 0.0]


def test_constant_and_correlated(spark):
    rows = [(i, 5.0, float(i), 2.0 * i, float((i * 7) % 5), None) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, c double, x double, y double, w double, n double")
    assert D.constant_columns(df, ["c", "x", "n"]) == ["c"]
    assert D.correlated_columns(df, 0.95, ["x", "y", "w"]) == ["y"]


def test_forward_back_fill_groups(spark):
    rows = [("a", 1, None), ("a", 2, 1.0), ("a", 3, None), ("a", 4, 4.0), ("a", 5, None),
            ("b", 1, None), ("b", 2, None)]
    df = spark.createDataFrame(rows, "g string, o int, v double")
    out = D.forward_back_fill(df, ["o"], ["v"], partition_by=["g"])
    got = {(r["g"], r["o"]): r["v"] for r in out.collect()}
    assert [got[("a", i)] for i in range(1, 6)] == [1.0, 1.0, 1.0, 4.0, 4.0]
    assert got[("b", 1)] is None and got[("b", 2)] is None


def test_forward_fill_many_chunks_matches_pandas(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(0)
    v = rng.normal(size=500)
    v[rng.random(500) < 0.6] = np.nan
    v[:7] = np.nan
    pdf = pd.DataFrame({"o": np.arange(500), "v": v})
    df = spark.createDataFrame([(int(o), None if np.isnan(x) else float(x)) for o, x in zip(pdf.o, pdf.v)], "o long, v double")
    from ventana.functions.ordering import fill_forward_backward
    out = fill_forward_backward(df, ["v"], ["o"], n_chunks=13)
    got = [r["v"] for r in out.orderBy("o").collect()]
    want = pdf["v"].ffill().bfill().tolist()
    assert got == pytest.approx(want)


def test_pipeline_preserves_rows_and_scales(spark):
    rows = [(i, float(i % 7), None if i % 5 == 0 else float(i % 3), -1.0 if i == 3 else float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    pm, out = D.FeaturePrep(D.PrepConfig(), passthrough=["id"]).fit_transform(df)
    assert out.count() == 50
    st = out.agg(*[F.avg(c).alias(f"m_{c}") for c in pm.features],
                 *[F.stddev_pop(c).alias(f"s_{c}") for c in pm.features]).collect()[0]
    for c in pm.features:
        assert st[f"m_{c}"] == pytest.approx(0.0, abs=1e-9)
        assert st[f"s_{c}"] == pytest.approx(1.0, abs=1e-9)


def test_pairwise_complete_correlation_matches_pandas(spark):
    import numpy as np
    import pandas as pd
    from ventana.operators.profile import correlation_matrix
    rng = np.random.default_rng(1)
    x = rng.normal(size=200)
    pdf = pd.DataFrame({"x": x, "y": 2 * x + rng.normal(scale=0.1, size=200), "w": rng.normal(size=200),
                        "c": np.full(200, 5.0)})
    pdf.loc[rng.random(200) < 0.2, "x"] = np.nan
    pdf.loc[rng.random(200) < 0.3, "y"] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in row) for row in pdf.to_numpy()],
                               "x double, y double, w double, c double")
    got = {(r["column_a"], r["column_b"]): r["corr"] for r in correlation_matrix(df).collect()}
    want = pdf.corr()
    for a in "xyw":
        for b in "xyw":
            if (a, b) in got:
                assert got[(a, b)] == pytest.approx(want.loc[a, b], abs=1e-9)
    assert got[("c", "c")] is None and got[("x", "c")] is None
