import pytest

from __spark_entry__ import SMOKE_DIR as SF001
from ventana.session import work_dir
from ventana.sources import io as A


def test_format_dispatch_and_unknown(spark):
    with pytest.raises(ValueError, match="Unsupported file format"):
        A.file_format("x.xlsx")
    df = spark.createDataFrame([(1, float("nan")), (2, 3.0)], "k long, v double")
    with pytest.raises(ValueError):
        A.save_data(df, work_dir(spark, "io") + "/x.bin", "bin")
    for fmt in ("csv", "json", "parquet"):
        p = work_dir(spark, "io") + f"/t.{fmt}"
        A.save_data(df, p, fmt)
        back = A.load_data(spark, p, "k long, v double")
        got = {r["k"]: r["v"] for r in back.collect()}
        assert got[2] == 3.0 and got[1] is None  # NaN becomes NULL at load


def test_catalog_missing(spark):
    cat = A.DatasetCatalog({"x": "/nonexistent/path.csv"})
    with pytest.raises(FileNotFoundError):
        cat.load(spark, "x")


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns[0] == "column_name" and df.count() == 21
    qs, os_ = E.queries(), E.oracle_sql()
    assert set(os_) <= set(qs) and len(qs) >= 90


@pytest.mark.parametrize("name", ["e6_statistics", "c5_filter_stats", "d3_forward_back_fill", "f4_contiguous_folds",
                                  "h7_leaderboard", "i2_winner", "d15_process_pipeline", "e4_correlation"])
def test_oracle_small(spark, name):
    import duckdb

    import __spark_entry__ as E
    con = duckdb.connect()
    for t in ["lineitem", "orders", "part", "supplier"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    sdf = E.queries()[name](spark, SF001)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(ocols)

    def norm(rows, cols):
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        return sorted((tuple(round(r[i], 5) if isinstance(r[i], float) else r[i] for i in order) for r in rows),
                      key=repr)
    assert norm([tuple(r) for r in sdf.collect()], sdf.columns) == norm(cur.fetchall(), ocols)


def test_metrics_json_sink(spark, tmp_path):
    import json
    p = A.save_metrics_json({"rf": {"mae": 24.5287, "r2": 0.6118}}, str(tmp_path / "m" / "evaluation.json"))
    assert json.load(open(p))["rf"]["mae"] == 24.5287


def test_a3_reads_every_row(spark):
    import duckdb

    import __spark_entry__ as E
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{SF001}/lineitem.parquet'")
    df = E.queries()["a3_read_parquet_whole"](spark, SF001)
    want = con.execute(E.oracle_sql()["a3_read_parquet_whole"]).fetchall()
    assert len(want) == con.execute("SELECT count(*) FROM lineitem").fetchone()[0]
    assert sorted(map(tuple, df.collect())) == sorted(want)
    plan = df._jdf.queryExecution().toString()
    assert "l_quantity" in plan.split("ReadSchema: ")[1] and "l_comment" not in plan.split("ReadSchema: ")[1]
    # a filter reaches the scan
    some = A.load_data(spark, f"{SF001}/lineitem.parquet").filter("l_returnflag = 'R'")
    assert "EqualTo(l_returnflag,R)" in some._jdf.queryExecution().toString().split("PushedFilters: ")[1].split("]")[0]
