"""E1-E15 -- profiling and outlier statistics.

Every statistic is a whole-column aggregate. Plan shape: the wide frame is
unpivoted (``Expand``) to ``(column_name, value)`` and aggregated by
``column_name`` with partial aggregation before the shuffle, so at most one
row per column per map task crosses the network and the final merge is
spread over one task per column. Fitted bounds (p rows, p = number of
columns) are joined back with a broadcast whose size is bounded by the
schema width, never by the data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ventana.functions.exprs import col, nan_to_null, numeric_columns, q
from ventana.functions.quantiles import exact_quantiles, grouped_quantiles

STAT_COLUMNS = ["column_name", "mean", "std_dev", "min", "q1", "median", "q3", "max",
                "iqr", "skewness", "kurtosis"]


def analysis_columns(df: DataFrame, columns: list[str] | None = None) -> list[str]:
    """Requested columns intersected with the numeric ones (all numeric
    columns when none are requested), in the frame's order."""
    num = numeric_columns(df)
    if columns:
        wanted = set(columns)
        return [c for c in num if c in wanted]
    return num


def to_long(df: DataFrame, columns: list[str], ids: list[str] | None = None) -> DataFrame:
    """Wide -> long ``(ids..., column_name, value)`` with doubles, NaN as NULL."""
    sel = [col(i) for i in (ids or [])] + [nan_to_null(col(c).cast("double")).alias(c) for c in columns]
    return df.select(*sel).unpivot(ids or [], columns, "column_name", "value")


def _position(columns: list[str]) -> Column:
    m = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(i))])
    return m[F.col("column_name")]


def _ordered(out: DataFrame, columns: list[str], names: list[str]) -> DataFrame:
    return out.withColumn("_pos", _position(columns)).orderBy("_pos").select(*names)


QUARTILES = [0.25, 0.5, 0.75]


def _with_quartiles(df: DataFrame, cols: list[str], aggregates: list[Column], accuracy: int | None) -> DataFrame:
    """Per column the aggregates and ``_q``, its quartiles: exact by default,
    ``percentile_approx`` with ``accuracy``."""
    long = to_long(df, cols)
    if accuracy:
        return long.groupBy("column_name").agg(*aggregates, F.percentile_approx("value", F.array(*[F.lit(p) for p in QUARTILES]), accuracy).alias("_q"))
    return grouped_quantiles(long, ["column_name"], "value", QUARTILES, aggregates)


def _quartiles(df: DataFrame, cols: list[str], accuracy: int | None) -> dict[str, list[float | None]]:
    """The same as numbers, one entry per column."""
    if accuracy:
        return {r["column_name"]: r["_q"] or [None] * 3 for r in _with_quartiles(df, cols, [F.count("value").alias("n")], accuracy).collect()}
    return {k[0]: q for k, q in exact_quantiles(to_long(df, cols), ["column_name"], "value", QUARTILES)}


def _fences(df: DataFrame, cols: list[str], k: float, accuracy: int | None) -> dict[str, tuple]:
    """(q1, median, q3, lower, upper) per column; Nones where it has no values."""
    return _bounds(_quartiles(df, cols, accuracy), cols, k)


def _bounds(quartiles: dict[str, list[float] | None], cols: list[str], k: float) -> dict[str, tuple]:
    out = {}
    for c, q in quartiles.items():
        q1, med, q3 = q or (None,) * 3
        out[c] = (None,) * 5 if q1 is None else (q1, med, q3, q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return {c: out.get(c, (None,) * 5) for c in cols}


def _number(x: float | None) -> Column:
    return F.lit(None).cast("double") if x is None else F.lit(float(x))


def _wide(df: DataFrame, cols: list[str], per_column) -> DataFrame:
    """One aggregate over the wide frame, reshaped to a row per column.
    ``per_column(c, v)`` gives named aggregates; ``v`` is the value, NaN as NULL."""
    aggs = {c: per_column(c, nan_to_null(col(c).cast("double"))) for c in cols}
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[e.alias(f"_{i}_{name}") for i, c in enumerate(cols) for name, e in aggs[c].items()])
    rows = [F.struct(F.lit(i).alias("_pos"), F.lit(c).alias("column_name"), *[F.col(f"_{i}_{name}").alias(name) for name in aggs[c]])
            for i, c in enumerate(cols)]
    return one.select("_n", F.inline(F.array(*rows)))


def column_statistics(df: DataFrame, columns: list[str] | None = None,
                      accuracy: int | None = None) -> DataFrame:
    """E6 ``get_statistics``: mean, sample std, min, quartiles (linear
    interpolation), max, IQR, population skewness and excess kurtosis.
    ``accuracy`` switches the exact percentile to ``percentile_approx``."""
    cols = analysis_columns(df, columns)
    v = F.col("value")
    agg = _with_quartiles(df, cols, [
        F.avg(v).alias("mean"), F.stddev_samp(v).alias("std_dev"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.skewness(v).alias("skewness"), F.kurtosis(v).alias("kurtosis")], accuracy)
    out = agg.select(
        "column_name", "mean", "std_dev", "min",
        F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"),
        "max", (F.col("_q")[2] - F.col("_q")[0]).alias("iqr"), "skewness", "kurtosis")
    return _ordered(out, cols, STAT_COLUMNS)


def describe(df: DataFrame, columns: list[str] | None = None, accuracy: int | None = None) -> DataFrame:
    """Count, mean, std (n-1), min, 25/50/75 %, max per numeric column."""
    cols = analysis_columns(df, columns)
    v = F.col("value")
    agg = _with_quartiles(df, cols, [
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"),
        F.max(v).alias("max")], accuracy)
    out = agg.select("column_name", "count", "mean", "std", "min",
                     F.col("_q")[0].alias("p25"), F.col("_q")[1].alias("p50"),
                     F.col("_q")[2].alias("p75"), "max")
    return _ordered(out, cols, ["column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"])


def missing_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column NULL (or NaN) count and its percentage of all rows.
    One aggregate over the wide frame, reshaped with ``stack`` on one row."""
    cols = columns or df.columns
    fields = {f.name: f.dataType for f in df.schema.fields}

    def missing(c):
        x = col(c)
        if isinstance(fields[c], (T.DoubleType, T.FloatType)):
            return F.count_if(x.isNull() | F.isnan(x))
        return F.count_if(x.isNull())

    one = df.agg(F.count(F.lit(1)).alias("_n"), *[missing(c).alias(f"_m{i}") for i, c in enumerate(cols)])
    rows = F.inline(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                                       F.col(f"_m{i}").alias("missing"))
                              for i, c in enumerate(cols)]))
    return one.select("_n", rows).select(
        "position", "column_name", F.col("missing").cast("long").alias("missing"),
        (F.try_divide(F.col("missing") * 100.0, F.col("_n"))).alias("missing_pct"))


def shape_and_types(df: DataFrame) -> DataFrame:
    """Column positions, names, Spark type names and the row count."""
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    rows = F.inline(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                                       F.lit(f.dataType.simpleString()).alias("data_type"))
                              for i, f in enumerate(df.schema.fields)]))
    return n.select(rows, "n_rows")


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pairwise-complete Pearson for every pair ``i <= j``, long as
    ``(column_a, column_b, corr)``; the diagonal is 1, or NULL when constant.

    Two passes, no shuffle of rows. Pass 1 (one aggregate) gets each
    column's mean and whether it is constant. Pass 2 shifts every value by
    its column mean (conditioning) and, per Arrow batch, forms with numpy the
    Gram blocks of ``Z = [mask, x, x^2]`` (NULL -> mask 0, value 0):
    ``M'M`` (pair counts), ``X'M`` and ``X2'M`` (per-pair sums and sums of
    squares over the pair's complete rows) and ``X'X`` (cross products). A
    ``groupBy(index)`` sum merges the blocks -- partially inside each task --
    so 4p^2 numbers per task cross the network whatever the row count, and
    the cost per row is one BLAS product instead of O(p^2) SQL expressions.
    """
    import numpy as np
    import pandas as pd

    cols = analysis_columns(df, columns)
    k = len(cols)
    spark = df.sparkSession
    if k == 0:
        return spark.createDataFrame([], "column_a string, column_b string, corr double")
    base = df.selectExpr(*[f"CASE WHEN isnan(CAST({q(c)} AS DOUBLE)) THEN NULL ELSE CAST({q(c)} AS DOUBLE) END "
                           f"AS _x{i}" for i, c in enumerate(cols)])
    p1 = base.selectExpr(*[f"avg(_x{i}) AS _mu{i}" for i in range(k)],
                         *[f"min(_x{i}) = max(_x{i}) AS _k{i}" for i in range(k)]).collect()[0]
    mu = np.array([p1[f"_mu{i}"] if p1[f"_mu{i}"] is not None else 0.0 for i in range(k)])
    const = [p1[f"_k{i}"] is not False for i in range(k)]
    names = [f"_x{i}" for i in range(k)]
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", T.DoubleType())])

    def gram(it):
        acc = np.zeros((4, k, k))
        for pdf in it:
            x = pdf[names].to_numpy(dtype=np.float64)
            m = (~np.isnan(x)).astype(np.float64)
            xs = np.where(m > 0, x - mu, 0.0)
            acc[0] += m.T @ m
            acc[1] += xs.T @ m
            acc[2] += (xs * xs).T @ m
            acc[3] += xs.T @ xs
        yield pd.DataFrame({"i": np.arange(4 * k * k, dtype=np.int32), "v": acc.ravel()})

    g = np.zeros(4 * k * k)
    for r in base.mapInPandas(gram, schema).groupBy("i").agg(F.sum("v").alias("v")).collect():
        g[r["i"]] = r["v"]
    N, A, Q, P = g.reshape(4, k, k)
    rows = []
    for i in range(k):
        for j in range(i, k):
            if i == j:
                c = None if const[i] else 1.0
            elif const[i] or const[j] or N[i, j] <= 0:
                c = None
            else:
                n = N[i, j]
                sa, sb = A[i, j], A[j, i]
                va = Q[i, j] - sa * sa / n
                vb = Q[j, i] - sb * sb / n
                cov = P[i, j] - sa * sb / n
                c = float(cov / np.sqrt(va * vb)) if va > 0 and vb > 0 else None
            rows.append((cols[i], cols[j], c))
    return spark.createDataFrame(rows, "column_a string, column_b string, corr double")


def categorical_cardinality(df: DataFrame, approx: bool = False) -> DataFrame:
    """E5: distinct non-null values per string column."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, n_distinct long")
    fn = F.approx_count_distinct if approx else F.count_distinct
    one = df.agg(*[fn(col(c)).alias(f"_d{i}") for i, c in enumerate(cols)])
    rows = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                       F.col(f"_d{i}").cast("long").alias("n_distinct"))
                              for i, c in enumerate(cols)]))
    return one.select(rows)


def profile(df: DataFrame) -> dict[str, DataFrame]:
    """E14 ``describe_data``: the E1-E5 tables bundled (the quartiles and the
    correlation sums are computed when called)."""
    return {"shape": shape_and_types(df), "missing": missing_counts(df),
            "numeric_stats": describe(df), "correlation": correlation_matrix(df),
            "categorical": categorical_cardinality(df)}


def profile_long(df: DataFrame) -> DataFrame:
    """E14 as one long table ``(section, column_name, key, value)`` (value
    as text): the five E1-E5 tables stacked, each p-sized."""
    parts = profile(df)
    out = None
    for section, t in parts.items():
        ident = "column_name" if "column_name" in t.columns else None
        keys = [c for c in t.columns if c not in ("column_name",)]
        if section == "correlation":
            t = t.select(F.concat_ws("|", "column_a", "column_b").alias("column_name"), "corr")
            keys = ["corr"]
        elif ident is None:
            continue
        long = t.select("column_name", F.explode(F.map_from_arrays(
            F.array(*[F.lit(k) for k in keys]), F.array(*[F.col(k).cast("string") for k in keys]))).alias("key", "value"))
        long = long.select(F.lit(section).alias("section"), "column_name", "key", "value")
        out = long if out is None else out.unionByName(long)
    return out


# ---------------------------------------------------------------- outliers

def iqr_bounds(df: DataFrame, columns: list[str] | None = None, k: float = 1.5,
               accuracy: int | None = None, quartiles: dict | None = None) -> DataFrame:
    """Per column Q1, Q3 and the fences ``Q1 - k*IQR``, ``Q3 + k*IQR``
    (``quartiles``: those of the columns, where they are known)."""
    cols = analysis_columns(df, columns)
    rows = _bound_rows(_bounds(quartiles, cols, k) if quartiles is not None else _fences(df, cols, k, accuracy))
    return df.sparkSession.createDataFrame(rows, "column_name string, q1 double, median double, q3 double, iqr double, "
                                                 "lower_bound double, upper_bound double")


def _bound_rows(fences: dict[str, tuple]) -> list[tuple]:
    return [(c, q1, med, q3, None if q1 is None else q3 - q1, lo, hi) for c, (q1, med, q3, lo, hi) in fences.items()]


def iqr_outliers(df: DataFrame, columns: list[str] | None = None, k: float = 1.5,
                 accuracy: int | None = None) -> DataFrame:
    """E7 summary: per column outlier count, % of all rows, and bounds."""
    cols = analysis_columns(df, columns)
    fences = _fences(df, cols, k, accuracy)
    out = _wide(df, cols, lambda c, v: {
        "outlier_count": F.count_if((v < _number(fences[c][3])) | (v > _number(fences[c][4]))).cast("long"),
        "lower_bound": F.first(_number(fences[c][3])), "upper_bound": F.first(_number(fences[c][4]))})
    return out.orderBy("_pos").select("column_name", "outlier_count", F.try_divide(F.col("outlier_count") * 100.0, F.col("_n")).alias("outlier_pct"),
                                      "lower_bound", "upper_bound")


def iqr_flags(df: DataFrame, columns: list[str] | None = None, k: float = 1.5,
              accuracy: int | None = None, suffix: str = "_outlier") -> DataFrame:
    """E7 per-row flags: adds ``<c>_outlier`` booleans. The p fitted bounds
    are collected (bounded by the schema width) and become literals."""
    cols = analysis_columns(df, columns)
    b = {r["column_name"]: (r["lower_bound"], r["upper_bound"]) for r in iqr_bounds(df, cols, k, accuracy).collect()}
    flags = [((col(c) < F.lit(b[c][0])) | (col(c) > F.lit(b[c][1]))).alias(c + suffix) for c in cols]
    return df.select("*", *flags)


def zscore_stats(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    cols = analysis_columns(df, columns)
    v = F.col("value")
    return to_long(df, cols).groupBy("column_name").agg(
        F.avg(v).alias("mu"), F.stddev_pop(v).alias("sigma"),
        F.count(v).alias("n_valid"), F.count(F.lit(1)).alias("n_rows"))


def zscore_condition(v: Column, mu: Column, sigma: Column, n_valid: Column, n_rows: Column,
                     t: float) -> Column:
    """|v - mu| / sigma_pop > t; never true when the column has a NULL
    anywhere (scipy propagates NaN) or sigma is 0."""
    return ((n_valid == n_rows) & (sigma > 0) & (F.abs(v - mu) > F.lit(t) * sigma))


def zscore_outliers(df: DataFrame, columns: list[str] | None = None, t: float = 3.0) -> DataFrame:
    """E8 summary: per column count of |z| > t and % of non-null rows."""
    cols = analysis_columns(df, columns)
    stats = {r["column_name"]: r for r in zscore_stats(df, cols).collect()}
    out = _wide(df, cols, lambda c, v: {"outlier_count": _beyond(v, stats.get(c), t), "n_valid": F.count(v)})
    return out.orderBy("_pos").select("column_name", "outlier_count", F.try_divide(F.col("outlier_count") * 100.0, F.col("n_valid")).alias("outlier_pct"),
                                      F.lit(float(t)).alias("threshold"))


def _beyond(v: Column, s, t: float) -> Column:
    """How many values lie beyond t sigmas, with the column's numbers as literals."""
    if s is None or s["n_valid"] != s["n_rows"] or not s["sigma"]:
        return F.count_if(F.lit(False)).cast("long")
    return F.count_if(F.abs(v - _number(s["mu"])) > F.lit(float(t) * s["sigma"])).cast("long")


def outlier_comparison(df: DataFrame, columns: list[str] | None = None, k: float = 1.5,
                       t: float = 3.0, accuracy: int | None = None, quartiles: dict | None = None) -> DataFrame:
    """IQR vs z-score counts and percentages per column."""
    cols, v = analysis_columns(df, columns), F.col("value")
    if quartiles is None:
        # quartiles, mean and spread of one reading
        stats = {r["column_name"]: r for r in _with_quartiles(df, cols, [
            F.avg(v).alias("mu"), F.stddev_pop(v).alias("sigma"), F.count(v).alias("n_valid"), F.count(F.lit(1)).alias("n_rows")], accuracy).collect()}
        quartiles = {c: r["_q"] for c, r in stats.items()}
    else:
        stats = {r["column_name"]: r for r in zscore_stats(df, cols).collect()}
    fences = _bounds(quartiles, cols, k)
    out = _wide(df, cols, lambda c, v: {
        "iqr_count": F.count_if((v < _number(fences[c][3])) | (v > _number(fences[c][4]))).cast("long"),
        "z_count": _beyond(v, stats.get(c), t), "n_valid": F.count(v)})
    return out.orderBy("_pos").select(
        "column_name", "iqr_count", F.try_divide(F.col("iqr_count") * 100.0, F.col("_n")).alias("iqr_pct"),
        "z_count", F.try_divide(F.col("z_count") * 100.0, F.col("n_valid")).alias("z_pct"))


def histogram(df: DataFrame, columns: list[str] | None = None, bins: int = 50) -> DataFrame:
    """Equal-width density histogram over [min, max] (last bin closed);
    a constant column uses [v - .5, v + .5]. Non-empty bins only."""
    cols = analysis_columns(df, columns)
    long = to_long(df, cols).filter(F.col("value").isNotNull())
    rng = long.groupBy("column_name").agg(F.min("value").alias("_mn0"), F.max("value").alias("_mx0"),
                                          F.count(F.lit(1)).alias("_n"))
    const = F.col("_mn0") == F.col("_mx0")
    rng = rng.select("column_name", "_n",
                     F.when(const, F.col("_mn0") - 0.5).otherwise(F.col("_mn0")).alias("_mn"),
                     F.when(const, F.col("_mx0") + 0.5).otherwise(F.col("_mx0")).alias("_mx"))
    w = (F.col("_mx") - F.col("_mn")) / float(bins)
    j = long.join(F.broadcast(rng), "column_name")
    b = F.least(F.floor((F.col("value") - F.col("_mn")) / w), F.lit(bins - 1)).cast("int")
    out = j.groupBy("column_name", "_mn", "_mx", "_n", b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    w2 = (F.col("_mx") - F.col("_mn")) / float(bins)
    out = out.select("column_name", "bin", (F.col("_mn") + F.col("bin") * w2).alias("bin_lo"),
                     (F.col("_mn") + (F.col("bin") + 1) * w2).alias("bin_hi"),
                     F.col("count").cast("long").alias("count"),
                     (F.col("count") / (F.col("_n") * w2)).alias("density"))
    return out


def gaussian_overlay(df: DataFrame, columns: list[str] | None = None, points: int = 100) -> DataFrame:
    """Normal pdf(mu, sample sigma) at ``points`` even points over
    [min, max]; points come from ``sequence`` on the p-row parameter frame."""
    cols = analysis_columns(df, columns)
    v = F.col("value")
    st = to_long(df, cols).groupBy("column_name").agg(
        F.avg(v).alias("mu"), F.stddev_samp(v).alias("sigma"), F.min(v).alias("mn"), F.max(v).alias("mx"))
    pts = st.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    x = F.col("mn") + (F.col("mx") - F.col("mn")) * F.col("point") / float(points - 1)
    z = F.try_divide(F.lit(1.0) * (F.col("_x") - F.col("mu")), F.col("sigma"))
    pdf = F.exp(-0.5 * z * z) / (F.col("sigma") * math.sqrt(2 * math.pi))
    return pts.withColumn("_x", x).select("column_name", "point", F.col("_x").alias("x"), pdf.alias("pdf"))


def quartile_lines(df: DataFrame, columns: list[str] | None = None, k: float = 1.5,
                   accuracy: int | None = None, quartiles: dict | None = None) -> DataFrame:
    """Q1, median, Q3 and both IQR fences per column."""
    cols = analysis_columns(df, columns)
    out = iqr_bounds(df, cols, k, accuracy, quartiles).select("column_name", "q1", "median", "q3", "lower_bound",
                                                   "upper_bound")
    return _ordered(out, cols, ["column_name", "q1", "median", "q3", "lower_bound", "upper_bound"])


def boxplot_summary(df: DataFrame, columns: list[str] | None = None, k: float = 1.5,
                    accuracy: int | None = None, quartiles: dict | None = None) -> DataFrame:
    """Quartiles, whiskers (extreme values inside the fences) and the
    number of fliers beyond them."""
    cols = analysis_columns(df, columns)
    fences = _bounds(quartiles, cols, k) if quartiles is not None else _fences(df, cols, k, accuracy)
    lo, hi = (lambda c: _number(fences[c][3])), (lambda c: _number(fences[c][4]))
    out = _wide(df, cols, lambda c, v: {
        "q1": F.first(_number(fences[c][0])), "median": F.first(_number(fences[c][1])), "q3": F.first(_number(fences[c][2])),
        "whisker_low": F.min(F.when(v >= lo(c), v)), "whisker_high": F.max(F.when(v <= hi(c), v)),
        "n_fliers": F.count_if((v < lo(c)) | (v > hi(c))).cast("long"), "n_valid": F.count(v)})
    names = ["column_name", "q1", "median", "q3", "whisker_low", "whisker_high", "n_fliers"]
    return out.where("n_valid > 0").orderBy("_pos").select(*names)


def fliers(df: DataFrame, columns: list[str] | None = None, ids: list[str] | None = None,
           k: float = 1.5, accuracy: int | None = None) -> DataFrame:
    """E13 fliers: the rows beyond the fences, long ``(ids, column_name, value)``."""
    cols = analysis_columns(df, columns)
    bounds = iqr_bounds(df, cols, k, accuracy).select("column_name", "lower_bound", "upper_bound")
    v = F.col("value")
    j = to_long(df, cols, ids).join(F.broadcast(bounds), "column_name")
    return j.filter((v < F.col("lower_bound")) | (v > F.col("upper_bound"))).select(
        *(ids or []), "column_name", "value")
