"""Columns by name, rejected files, restarts."""
import os

import pytest
from pyspark.sql import functions as F

from ventana.models.classic import LinearOLS
from ventana.operators.prep import FeaturePrep, PrepConfig
from ventana.sources import io as A
from ventana.streaming.filedrop import accounts, layout_of, score_stream, scored
from ventana.streaming.serve import Bundle

SCHEMA = "id long, a double, b double"


@pytest.fixture(scope="module")
def bundle(spark):
    df = spark.range(60).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"))
    df = df.withColumn("label", 3 * F.col("a") - 2 * F.col("b") + 1)
    pm, prepared = FeaturePrep(PrepConfig(usable_columns=("a", "b"), stats_from="train"), passthrough=["id", "label"]).fit_transform(df)
    return Bundle(pm, LinearOLS().fit(prepared, pm.features), "logistic_regression", ["a", "b"], "t")


def drop(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", newline="") as f:
        f.write(text)


def run(spark, bundle, base, **more):
    schema = spark.createDataFrame([], SCHEMA).schema
    score_stream(spark, bundle, f"{base}/in", f"{base}/out", checkpoint=f"{base}/ck", schema=schema, **more).awaitTermination()
    return sorted((r.id, round(r.prediction_t, 6)) for r in scored(spark, f"{base}/out").collect())


def test_files_are_read_by_their_own_header_and_wrong_ones_listed(spark, bundle, tmp_path):
    base = str(tmp_path)
    drop(f"{base}/in", "1.csv", "id,a,b\n1,2,1\n2,,NaN\n")
    drop(f"{base}/in", "2.csv", "b,extra,id,a\r\n1,x,3,2\r\n")
    drop(f"{base}/in", "3.csv", "id,a\n4,1\n")
    drop(f"{base}/in", "4.csv", "id,a,b,a\n5,1,1,1\n")
    drop(f"{base}/in", "5.csv", "id,a,b\n6,1,1\n7,one,1\n")
    drop(f"{base}/in", "6.csv", "b,a,id\n")
    drop(f"{base}/in", "7.csv", '"id","b","a"\n8,"1","2"\n')
    got = run(spark, bundle, base)
    assert [i for i, _ in got] == [1, 2, 3, 8] and dict(got)[1] == dict(got)[3] == dict(got)[8] == pytest.approx(5.0, abs=1e-4)
    files = {r.file[-5:]: (r.accepted, r.reason, r.n_rows) for r in accounts(spark, f"{base}/out").collect()}
    assert files == {"1.csv": (True, None, 2), "2.csv": (True, None, 1), "3.csv": (False, "Missing columns: b", 0),
                     "4.csv": (False, "Repeated columns: a", 0), "5.csv": (False, "Unreadable values in 1 rows", 2),
                     "6.csv": (True, None, 0), "7.csv": (True, None, 1)}


def test_a_restart_leaves_every_row_once(spark, bundle, tmp_path):
    base = str(tmp_path)
    drop(f"{base}/in", "1.csv", "id,a,b\n1,2,1\n")
    drop(f"{base}/in", "2.csv", "b,a,id\n1,2,2\n")
    first = run(spark, bundle, base, max_files=1)
    # as if the driver had died after writing the last batch and before noting that it was done
    root = f"{base}/ck/commits"
    last = max(int(n) for n in os.listdir(root) if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{root}/{name}"):
            os.remove(f"{root}/{name}")
    drop(f"{base}/in", "3.csv", "id,b,a\n3,1,2\n")
    again = run(spark, bundle, base, max_files=1)
    assert [i for i, _ in first] == [1, 2] and [i for i, _ in again] == [1, 2, 3]
    assert accounts(spark, f"{base}/out").count() == 3
    assert run(spark, bundle, base) == again  # nothing new


def test_parquet_files(spark, bundle, tmp_path):
    base = str(tmp_path)
    spark.createDataFrame([(1, 2.0, 1.0)], SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
    spark.createDataFrame([(1, 2, 2)], "b int, a int, id int").coalesce(1).write.mode("append").parquet(f"{base}/in")
    spark.createDataFrame([(3, "x", 1.0)], "id long, a string, b double").coalesce(1).write.mode("append").parquet(f"{base}/in")
    assert [i for i, _ in run(spark, bundle, base, fmt="parquet")] == [1, 2]
    assert [r.reason for r in accounts(spark, f"{base}/out").where("not accepted").collect()] == ["Columns of another type: a"]


def test_bad_calls_raise(spark, bundle):
    with pytest.raises(ValueError, match="Missing columns: a"):
        score_stream(spark, bundle, "/x", "/y", schema=spark.createDataFrame([], "id long, b double").schema)
    with pytest.raises(ValueError, match="Unsupported file format"):
        score_stream(spark, bundle, "/x", "/y", fmt="xlsx")
    assert layout_of('\ufeffa,"b,c"') == ("a", "b,c")


def test_csv_columns_go_by_name(spark, tmp_path):
    base = str(tmp_path)
    drop(base, "one.csv", "b,note,a\n2,x,1\n")
    got = A.read_csv(spark, f"{base}/one.csv", "a double, b double").collect()
    assert [(r.a, r.b) for r in got] == [(1.0, 2.0)]
    with pytest.raises(ValueError, match="Missing columns: c"):
        A.read_csv(spark, f"{base}/one.csv", "a double, c double")
    drop(f"{base}/many.csv", "1.csv", "a,b\n1,2\n")
    drop(f"{base}/many.csv", "2.csv", "b,a\n2,1\n")
    with pytest.raises(Exception, match="header"):
        A.read_csv(spark, f"{base}/many.csv", "a double, b double").collect()
    drop(base, "none.csv", "")
    assert A.read_csv(spark, f"{base}/none.csv", "a double, b double").count() == 0
