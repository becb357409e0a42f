"""Query registrations, grouped by inventory section.

Every query reads the driver tables in full; the oracle next to it is an
independent DuckDB statement over the same tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ventana.operators import profile as E
from ventana.plans.oracles import (dm_pair_sql, dm_sql, preds_sql, qi, r6, with_dm)
from ventana.plans.registry import register
from ventana.sources import bindings as B
from ventana.sources.bindings import FEATURES, MONTHS, RAW_MONTHS, TARGET

# ======================================================== K1 demand matrix

register("k1_demand_matrix", "SELECT product_id, " + ", ".join(
    r6(qi(m), m) for m in MONTHS) + f" FROM ({dm_sql()})")(lambda s, d: B.dm(s, d))

register("k1_demand_matrix_null", "SELECT product_id, " + ", ".join(
    r6(qi(m), m) for m in MONTHS) + f" FROM ({dm_sql(fill=False)})")(lambda s, d: B.dm_null(s, d))

register("k1_demand_matrix_signed", "SELECT product_id, " + ", ".join(
    r6(qi(m), m) for m in MONTHS) + f" FROM ({dm_sql(signed=True)})")(lambda s, d: B.dm_signed(s, d))

register("k1_demand_matrix_pair", "SELECT codigo_almacen, almacen, codigo_producto, descripcion_producto, "
         "tipo_producto, descripcion_padre, " + r6("valor_promedio", "valor_promedio") + ", " + ", ".join(
             r6(qi(m), m) for m in RAW_MONTHS) + f" FROM ({dm_pair_sql()})")(lambda s, d: B.dm_pair(s, d))

register("k1_preds", f"SELECT product_id, model, {r6('y', 'y')}, {r6('p', 'p')} FROM ({preds_sql()})")(
    lambda s, d: B.preds(s, d))

# ======================================================== E profiling

E6_SQL = with_dm(
    ", s AS (SELECT column_name, avg(value) AS mu FROM u GROUP BY column_name), "
    "m AS (SELECT u.column_name, avg(power(value - mu, 2)) AS m2, avg(power(value - mu, 3)) AS m3, "
    "avg(power(value - mu, 4)) AS m4 FROM u JOIN s USING (column_name) GROUP BY u.column_name), "
    "a AS (SELECT column_name, avg(value) AS mean, stddev_samp(value) AS std_dev, min(value) AS mn, "
    "quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3, "
    "max(value) AS mx FROM u GROUP BY column_name) "
    "SELECT a.column_name, " + ", ".join([
        r6("mean", "mean"), r6("std_dev", "std_dev"), r6("mn", "min"), r6("q1", "q1"),
        r6("median", "median"), r6("q3", "q3"), r6("mx", "max"), r6("q3 - q1", "iqr"),
        r6("m3 / nullif(power(m2, 1.5), 0)", "skewness"),
        r6("m4 / nullif(power(m2, 2), 0) - 3", "kurtosis")]) +
    " FROM a JOIN m USING (column_name)")


@register("e6_statistics", E6_SQL)
def e6_statistics(spark, sf_dir):
    """K1 -> E6: the per-month statistics table of the demand matrix."""
    return E.column_statistics(B.dm(spark, sf_dir), MONTHS)


def _u(body: str, fill=True, signed=False, cols=None) -> str:
    return with_dm(", " + body, fill=fill, signed=signed, cols=cols)


@register("e1_describe", with_dm(
    " SELECT column_name, count(value)::BIGINT AS count, " + ", ".join([
        r6("avg(value)", "mean"), r6("stddev_samp(value)", "std"), r6("min(value)", "min"),
        r6("quantile_cont(value, 0.25)", "p25"), r6("quantile_cont(value, 0.5)", "p50"),
        r6("quantile_cont(value, 0.75)", "p75"), r6("max(value)", "max")]) +
    " FROM u GROUP BY column_name", fill=False, cols=["product_id"] + MONTHS))
def e1_describe(spark, sf_dir):
    """E1 on DM_NULL (so counts differ per month)."""
    return E.describe(B.dm_null(spark, sf_dir))


def _e2_sql() -> str:
    cols = ["product_id"] + MONTHS
    parts = [f"SELECT {i} AS position, '{c}' AS column_name, (count(*) - count({qi(c)}))::BIGINT AS missing, "
             f"{r6(f'(count(*) - count({qi(c)})) * 100.0 / count(*)', 'missing_pct')} FROM d"
             for i, c in enumerate(cols)]
    return f"WITH d AS MATERIALIZED ({dm_sql(fill=False)}) " + " UNION ALL ".join(parts)


@register("e2_missing", _e2_sql())
def e2_missing(spark, sf_dir):
    """E2 on DM_NULL: NULL counts and % of all rows, every column."""
    return E.missing_counts(B.dm_null(spark, sf_dir))


@register("e3_shape_types", (
    "SELECT (ordinal_position - 1)::INTEGER AS position, column_name, "
    "CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
    "WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' ELSE lower(data_type) END AS data_type, "
    "(SELECT count(*) FROM lineitem)::BIGINT AS n_rows "
    "FROM information_schema.columns WHERE table_name = 'lineitem'"))
def e3_shape_types(spark, sf_dir):
    """E3 on lineitem: positions, names, types, row count."""
    return E.shape_and_types(B.table(spark, sf_dir, "lineitem"))


def _e4_sql(fill: bool = True) -> str:
    parts = []
    for i, a in enumerate(MONTHS):
        for j in range(i, len(MONTHS)):
            b = MONTHS[j]
            if i == j:
                e = f"CASE WHEN stddev_pop({qi(a)}) > 0 THEN 1.0 END"
            else:
                e = (f"regr_sxy({qi(b)}, {qi(a)}) / nullif(sqrt(regr_sxx({qi(b)}, {qi(a)}) * "
                     f"regr_syy({qi(b)}, {qi(a)})), 0)")
            parts.append(f"SELECT '{a}' AS column_a, '{b}' AS column_b, {r6(e, 'corr')} FROM d")
    return f"WITH d AS MATERIALIZED ({dm_sql(fill=fill)}) " + " UNION ALL ".join(parts)


@register("e4_correlation_null", _e4_sql(fill=False))
def e4_correlation_null(spark, sf_dir):
    """E4 on DM_NULL: every pair uses only the rows where both are present."""
    return E.correlation_matrix(B.dm_null(spark, sf_dir), MONTHS)


@register("e4_correlation", _e4_sql())
def e4_correlation(spark, sf_dir):
    """E4 on DM: pairwise Pearson over all 21 months (i <= j)."""
    return E.correlation_matrix(B.dm(spark, sf_dir), MONTHS)


def _e5_sql() -> str:
    cols = ["almacen", "descripcion_producto", "tipo_producto", "descripcion_padre"]
    parts = [f"SELECT '{c}' AS column_name, count(DISTINCT {c})::BIGINT AS n_distinct FROM p" for c in cols]
    return f"WITH p AS MATERIALIZED ({dm_pair_sql()}) " + " UNION ALL ".join(parts)


@register("e5_cardinality", _e5_sql())
def e5_cardinality(spark, sf_dir):
    """E5 on DM_PAIR: distinct values of every string attribute."""
    return E.categorical_cardinality(B.dm_pair(spark, sf_dir))


_BOUNDS = ("b AS (SELECT column_name, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, "
           "quantile_cont(value, 0.75) AS q3 FROM u GROUP BY column_name), "
           "f AS (SELECT column_name, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM b) ")


@register("e7_iqr_outliers", _u(
    _BOUNDS + "SELECT u.column_name, count_if(value < lo OR value > hi)::BIGINT AS outlier_count, "
    + r6("count_if(value < lo OR value > hi) * 100.0 / count(*)", "outlier_pct") + ", "
    + r6("min(lo)", "lower_bound") + ", " + r6("min(hi)", "upper_bound")
    + " FROM u JOIN f USING (column_name) GROUP BY u.column_name", signed=True))
def e7_iqr_outliers(spark, sf_dir):
    """E7 on DM_SIGNED: IQR fences, outlier count and % of all rows."""
    return E.iqr_outliers(B.dm_signed(spark, sf_dir), MONTHS)


def _z_sql(t: float, fill: bool) -> str:
    return _u(
        "z AS (SELECT column_name, avg(value) AS mu, stddev_pop(value) AS sigma, count(value) AS nv, "
        "count(*) AS nr FROM u GROUP BY column_name) "
        "SELECT u.column_name, count_if(nv = nr AND sigma > 0 AND abs(value - mu) > "
        f"{t} * sigma)::BIGINT AS outlier_count, "
        + r6(f"count_if(nv = nr AND sigma > 0 AND abs(value - mu) > {t} * sigma) * 100.0 / nullif(min(nv), 0)",
             "outlier_pct") + f", {float(t)}::DOUBLE AS threshold"
        " FROM u JOIN z USING (column_name) GROUP BY u.column_name", fill=fill)


@register("e8_zscore_outliers", _z_sql(3.0, True))
def e8_zscore_outliers(spark, sf_dir):
    """E8 on DM, t = 3."""
    return E.zscore_outliers(B.dm(spark, sf_dir), MONTHS, 3.0)


@register("e8_zscore_outliers_null", _z_sql(3.0, False))
def e8_zscore_outliers_null(spark, sf_dir):
    """E8 on DM_NULL: a NULL anywhere in a month disables its flags."""
    return E.zscore_outliers(B.dm_null(spark, sf_dir), MONTHS, 3.0)


@register("e9_outlier_comparison", _u(
    _BOUNDS + ", z AS (SELECT column_name, avg(value) AS mu, stddev_pop(value) AS sigma, count(value) AS nv, "
    "count(*) AS nr FROM u GROUP BY column_name) "
    "SELECT u.column_name, count_if(value < lo OR value > hi)::BIGINT AS iqr_count, "
    + r6("count_if(value < lo OR value > hi) * 100.0 / count(*)", "iqr_pct") + ", "
    "count_if(nv = nr AND sigma > 0 AND abs(value - mu) > 3.0 * sigma)::BIGINT AS z_count, "
    + r6("count_if(nv = nr AND sigma > 0 AND abs(value - mu) > 3.0 * sigma) * 100.0 / nullif(min(nv), 0)", "z_pct")
    + " FROM u JOIN f USING (column_name) JOIN z USING (column_name) GROUP BY u.column_name"))
def e9_outlier_comparison(spark, sf_dir):
    """E9 on DM: IQR (k = 1.5) against z-score (t = 3)."""
    return E.outlier_comparison(B.dm(spark, sf_dir), MONTHS)


@register("e10_histogram", _u(
    "r0 AS (SELECT column_name, min(value) AS mn0, max(value) AS mx0, count(*) AS n FROM u "
    "WHERE value IS NOT NULL GROUP BY column_name), "
    "r AS (SELECT column_name, n, CASE WHEN mn0 = mx0 THEN mn0 - 0.5 ELSE mn0 END AS mn, "
    "CASE WHEN mn0 = mx0 THEN mx0 + 0.5 ELSE mx0 END AS mx FROM r0), "
    "h AS (SELECT u.column_name, mn, mx, n, least(floor((value - mn) / ((mx - mn) / 50.0)), 49)::INTEGER AS bin, "
    "count(*) AS cnt FROM u JOIN r USING (column_name) WHERE value IS NOT NULL GROUP BY ALL) "
    "SELECT column_name, bin, " + r6("mn + bin * ((mx - mn) / 50.0)", "bin_lo") + ", "
    + r6("mn + (bin + 1) * ((mx - mn) / 50.0)", "bin_hi") + ", cnt::BIGINT AS count, "
    + r6("cnt / (n * ((mx - mn) / 50.0))", "density") + " FROM h"))
def e10_histogram(spark, sf_dir):
    """E10 on DM: 50-bin density histogram per month."""
    return E.histogram(B.dm(spark, sf_dir), MONTHS, 50)


@register("e11_gaussian_overlay", _u(
    "st AS (SELECT column_name, avg(value) AS mu, stddev_samp(value) AS sigma, min(value) AS mn, "
    "max(value) AS mx FROM u GROUP BY column_name), "
    "pts AS (SELECT st.*, point::INTEGER AS point, mn + (mx - mn) * point / 99.0 AS x "
    "FROM st, range(100) t(point)) "
    "SELECT column_name, point, " + r6("x", "x") + ", "
    + r6("exp(-0.5 * ((x - mu) / nullif(sigma, 0)) * ((x - mu) / nullif(sigma, 0))) / (sigma * sqrt(2 * pi()))",
         "pdf") + " FROM pts"))
def e11_gaussian_overlay(spark, sf_dir):
    """E11 on DM: normal pdf at 100 points per month."""
    return E.gaussian_overlay(B.dm(spark, sf_dir), MONTHS, 100)


@register("e12_quartile_lines", _u(
    _BOUNDS + "SELECT column_name, " + ", ".join(r6(c, c) for c in ["q1", "median", "q3"]) + ", "
    + r6("lo", "lower_bound") + ", " + r6("hi", "upper_bound") + " FROM f"))
def e12_quartile_lines(spark, sf_dir):
    """E12 on DM: quartile and fence lines."""
    return E.quartile_lines(B.dm(spark, sf_dir), MONTHS)


@register("e13_boxplot", _u(
    _BOUNDS + "SELECT u.column_name, " + ", ".join(r6(f"min({c})", c) for c in ["q1", "median", "q3"]) + ", "
    + r6("min(value) FILTER (WHERE value >= lo)", "whisker_low") + ", "
    + r6("max(value) FILTER (WHERE value <= hi)", "whisker_high") + ", "
    "count(*) FILTER (WHERE value < lo OR value > hi)::BIGINT AS n_fliers "
    "FROM u JOIN f USING (column_name) WHERE value IS NOT NULL GROUP BY u.column_name", signed=True))
def e13_boxplot(spark, sf_dir):
    """E13 on DM_SIGNED: box-plot numbers per month."""
    return E.boxplot_summary(B.dm_signed(spark, sf_dir), MONTHS)


def _fliers_sql() -> str:
    from ventana.plans.oracles import long_sql
    return (f"WITH d AS MATERIALIZED ({dm_sql(signed=True)}), u AS MATERIALIZED ({long_sql('d', MONTHS, ['product_id'])}), "
            + _BOUNDS + "SELECT product_id, u.column_name, " + r6("value", "value")
            + " FROM u JOIN f USING (column_name) WHERE value < lo OR value > hi")


@register("e13_fliers", _fliers_sql())
def e13_fliers(spark, sf_dir):
    """E13 fliers on DM_SIGNED: every (product, month) beyond the fences."""
    return E.fliers(B.dm_signed(spark, sf_dir), MONTHS, ids=["product_id"])


@register("e15_column_subset", _u(
    "s AS (SELECT column_name, avg(value) AS mu FROM u GROUP BY column_name), "
    "m AS (SELECT u.column_name, avg(power(value - mu, 2)) AS m2, avg(power(value - mu, 3)) AS m3, "
    "avg(power(value - mu, 4)) AS m4 FROM u JOIN s USING (column_name) GROUP BY u.column_name), "
    "a AS (SELECT column_name, avg(value) AS mean, stddev_samp(value) AS std_dev, min(value) AS mn, "
    "quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3, "
    "max(value) AS mx FROM u GROUP BY column_name) "
    "SELECT a.column_name, " + ", ".join([
        r6("mean", "mean"), r6("std_dev", "std_dev"), r6("mn", "min"), r6("q1", "q1"),
        r6("median", "median"), r6("q3", "q3"), r6("mx", "max"), r6("q3 - q1", "iqr"),
        r6("m3 / nullif(power(m2, 1.5), 0)", "skewness"),
        r6("m4 / nullif(power(m2, 2), 0) - 3", "kurtosis")]) +
    " FROM a JOIN m USING (column_name)", cols=[TARGET, FEATURES[0], FEATURES[-1]]))
def e15_column_subset(spark, sf_dir):
    """A requested subset (one unknown name, one string column
    dropped by the numeric intersection) of the pair matrix's months."""
    d = B.dm(spark, sf_dir).withColumn("label_text", F.lit("x"))
    return E.column_statistics(d, [TARGET, "no_such_column", "label_text", FEATURES[0], FEATURES[-1]])
