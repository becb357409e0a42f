import pytest
from pyspark.sql import functions as F

from ventana.operators import clean as C
from ventana.operators import schema as S


def test_normalize_names_and_collision(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], ["2024-1", "Código A", "A_b"])
    out = S.normalize_column_names(df)
    assert out.columns == ["20241", "cdigoa", "a_b"]
    assert S.normalize_column_names(out).columns == out.columns  # idempotent
    bad = spark.createDataFrame([(1.0, 2.0)], ["2024-1", "2024 1"])
    with pytest.raises(ValueError):
        S.normalize_column_names(bad)


def test_select_usable_keeps_all_when_none_match(spark):
    df = spark.createDataFrame([(1.0, 2.0)], ["x", "y"])
    out, kept = S.select_usable_columns(df, ["2024-1"])
    assert kept == [] and out.columns == ["x", "y"]
    out, kept = S.select_usable_columns(spark.createDataFrame([(1.0, 2.0)], ["y", "2024-1"]), ["2024-1"])
    assert kept == ["2024-1"]


def test_multi_target_row_mean(spark):
    df = spark.createDataFrame([(1, 2.0, 4.0), (2, None, 4.0), (3, None, None)], "id long, t1 double, t2 double")
    got = {r["id"]: r["label"] for r in S.prepare_target(df, ["t1", "t2"]).collect()}
    assert got == {1: 3.0, 2: 4.0, 3: None}


def test_validate_and_template(spark):
    df = spark.createDataFrame([(1.0,)], ["a"])
    ok, msg = S.validate_columns(df, ["a", "b"])
    assert not ok and "b" in msg
    t = S.build_template(spark, ["a", "b"])
    assert t.columns == ["a", "b"] and t.count() == 0


def test_filter_values_first_failing_rule(spark):
    df = spark.createDataFrame([(None, 1.0), (-1.0, -5.0), (5.0, -1.0), (0.0, 200001.0), (2.0, 3.0)], "a double, b double")
    kept, stats = C.filter_values(df, C.FilterConfig(True, True, (1, 100000)))
    assert kept.count() == 1
    st = {r["stat"]: r["rows"] for r in stats.collect()}
    assert st["rows_dropped_empty"] == 1 and st["rows_dropped_a"] == 1 and st["rows_dropped_b"] == 2
    assert st["total_rows_initial"] == 5 and st["total_rows_final"] == 1 and st["total_rows_dropped"] == 4


def test_clean_rows_counts(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (3.0, None), (4.0, -2.0)], "x double, label double")
    out, stats = C.clean_rows(df)
    st = {r["stat"]: r["rows"] for r in stats.collect()}
    assert st == {"rows_initial": 4, "duplicates_removed": 1, "null_target_removed": 1,
                  "negative_target_clipped": 1, "rows_final": 2}
    assert sorted(r["label"] for r in out.collect()) == [0.0, 2.0]


def test_missing_cells_stay_missing(spark):
    from ventana.operators import prep as D
    nan = float("nan")
    rows = [(i, float(i)) for i in range(1, 9)] + [(9, 1000.0), (10, None), (11, nan)]
    df = spark.createDataFrame(rows, "k long, x double")
    got = {r.k: r.x for r in D.iqr_winsorise(df, ["x"]).collect()}
    assert got[10] is None and got[11] is None and got[9] == 13.0 and got[3] == 3.0
    cfg = D.PrepConfig(usable_columns=("x",), handle_missing_values=None, outlier_method="iqr", feature_scaling=None)
    out = {r.k: r.x for r in D.FeaturePrep(cfg, passthrough=["k"]).fit_transform(df)[1].collect()}
    assert out[10] == out[11] == pytest.approx((36 + 13) / 9)
    labels = C.clip_negative_label(df.withColumnRenamed("x", "label")).collect()
    assert {r.k: r.label for r in labels}[10] is None and {r.k: r.label for r in labels}[11] is None
    assert C.drop_null_label(df, "x").count() == 9
    kept, stats = C.filter_values(df, C.FilterConfig(remove_empty=True, remove_negative=True))
    assert kept.count() == 9 and {r.stat: r.rows for r in stats.collect()}["rows_dropped_empty"] == 2
    kept, _ = C.filter_values(df, C.FilterConfig(remove_negative=True))
    assert kept.count() == 9
    twice = spark.createDataFrame([(1.0, None, 2.0), (1.0, nan, 2.0), (1.0, 1.0, nan), (1.0, 1.0, None)], "a double, b double, label double")
    cleaned, stats = C.clean_rows(twice)
    assert [tuple(r) for r in cleaned.collect()] == [(1.0, None, 2.0)]
    assert {r.stat: r.rows for r in stats.collect()}["duplicates_removed"] == 2
