"""Query registrations for sources (A), schema (B), cleaning (C),
preparation (D), splits (F), evaluation (H) and comparison (I).

Each query reads the driver tables in full (through the bindings of
``ventana.sources.bindings``); the oracle beside it is an independent DuckDB
statement. Where an oracle needs a whole-column statistic it uses a global
SQL window -- the Spark side never does.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ventana.functions.exprs import uniform_hash
from ventana.operators import clean as C
from ventana.operators import compare as I
from ventana.operators import evaluate as H
from ventana.operators import prep as D
from ventana.operators import schema as S
from ventana.operators import split as SP
from ventana.plans.oracles import dm_pair_sql, dm_sql, preds_sql, qi, r6
from ventana.plans.oracles import r6 as _r6
from ventana.plans.registry import register
from ventana.session import work_dir
from ventana.sources import bindings as B
from ventana.sources import io as A
from ventana.sources.bindings import FEATURES, MONTHS, RAW_MONTHS, TARGET

M_SCHEMA = "product_id long, " + ", ".join(f"{m} double" for m in MONTHS)


def _sel_months(src: str, exprs: dict | None = None, key: str = "product_id", names=None) -> str:
    names = names or MONTHS
    exprs = exprs or {}
    return f"SELECT {key}, " + ", ".join(r6(exprs.get(m, qi(m)), m) for m in names) + f" FROM {src}"


def _h(k: str) -> str:
    """DuckDB twin of ``uniform_hash``."""
    return f"(('0x' || substr(md5(({k})::VARCHAR || ':42'), 1, 8))::BIGINT / 4294967296.0)"


# =============================================================== A sources / sinks

@register("a1_read_csv", _sel_months(f"({dm_sql()})"))
def a1_read_csv(spark, sf_dir):
    """A1: DM written as CSV by Spark, read back with an explicit schema."""
    path = work_dir(spark, "a1") + "/dm.csv"
    A.save_data(B.dm(spark, sf_dir), path, "csv")
    return A.load_data(spark, path, M_SCHEMA)


@register("a2_read_json", _sel_months(f"({dm_sql(fill=False)})"))
def a2_read_json(spark, sf_dir):
    """A2: DM_NULL written as JSON records and read back (NULLs survive)."""
    path = work_dir(spark, "a2") + "/dm.json"
    A.save_data(B.dm_null(spark, sf_dir), path, "json")
    return A.load_data(spark, path, M_SCHEMA)


@register("a3_read_parquet", "SELECT l_orderkey, l_linenumber, " + r6("l_quantity", "l_quantity") + ", "
          + r6("l_extendedprice", "l_extendedprice") + " FROM lineitem WHERE l_returnflag = 'R'")
def a3_read_parquet(spark, sf_dir):
    """A3: typed read of the lineitem table; the filter and the 4-column
    projection reach the Parquet scan (PushedFilters / ReadSchema)."""
    li = A.load_data(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    return li.filter(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber", "l_quantity",
                                                          "l_extendedprice")


@register("a3_read_parquet_whole", "SELECT l_orderkey, l_linenumber, " + r6("l_quantity", "l_quantity") + ", "
          + r6("l_extendedprice", "l_extendedprice") + " FROM lineitem")
def a3_read_parquet_whole(spark, sf_dir):
    """A3: typed read of the lineitem table, all rows; the 4-column projection
    reaches the Parquet scan (ReadSchema)."""
    li = A.load_data(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    return li.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@register("a6_save_parquet_roundtrip", _sel_months(f"({dm_sql(signed=True)})"))
def a6_save_parquet_roundtrip(spark, sf_dir):
    """DM_SIGNED saved as Parquet and read back."""
    path = work_dir(spark, "a6") + "/dm_signed.parquet"
    A.save_data(B.dm_signed(spark, sf_dir), path, "parquet")
    return A.load_data(spark, path)


def _leaderboard_sql(where: str = "", rounded: bool = True) -> str:
    e = "(y - p)"
    r6 = _r6 if rounded else (lambda expr, name: f"({expr})::DOUBLE AS {qi(name)}")
    return (f"SELECT model, {r6(f'avg(abs({e}))', 'mae')}, {r6(f'sqrt(avg({e} * {e}))', 'rmse')}, "
            f"{r6(f'CASE WHEN var_pop(y) = 0 THEN (CASE WHEN sum({e} * {e}) = 0 THEN 1 ELSE 0 END) ELSE 1 - sum({e} * {e}) / (count(*) * var_pop(y)) END', 'r2')}, "
            f"{r6(f'avg({e} * {e})', 'mse')}, {r6(f'quantile_cont(abs({e}), 0.5)', 'medae')}, "
            f"{r6(f'CASE WHEN var_pop(y) = 0 THEN (CASE WHEN var_pop({e}) = 0 THEN 1 ELSE 0 END) ELSE 1 - var_pop({e}) / var_pop(y) END', 'evs')}, "
            f"round(avg(abs({e}) / greatest(abs(y), 2.220446049250313e-16)) * 1e-15, 6) AS mape_e15 "
            f"FROM ({preds_sql()}) {where} GROUP BY model")


@register("a7_leaderboard_sink", _leaderboard_sql())
def a7_leaderboard_sink(spark, sf_dir):
    """The H7 leaderboard written as one CSV file and read back."""
    lb = H.evaluate(B.preds(spark, sf_dir))
    path = work_dir(spark, "a7") + "/leaderboard.csv"
    A.save_small_table(lb, path)
    schema = "model string, " + ", ".join(f"{m} double" for m in H.METRICS)
    back = A.load_data(spark, path, schema)
    return back.select(*[c for c in back.columns if c != "mape"], (F.col("mape") * 1e-15).alias("mape_e15"))


# =============================================================== B schema

_PAIR_NORMALISED = ["codigo_almacen", "almacen", "codigo_producto", "descripcion_producto", "tipo_producto",
                    "descripcion_padre", "valor_promedio"] + [m.replace("-", "") for m in RAW_MONTHS]


def _pair_sel(cols_exprs: list[tuple[str, str]]) -> str:
    parts = []
    for expr, name in cols_exprs:
        parts.append(r6(expr, name) if name == "valor_promedio" or name[0].isdigit() else f"{expr} AS {qi(name)}")
    return "SELECT " + ", ".join(parts) + f" FROM ({dm_pair_sql()})"


@register("b1_normalize_names", _pair_sel(
    [(qi(c), c) for c in _PAIR_NORMALISED[:7]] + [(qi(m), m.replace("-", "")) for m in RAW_MONTHS]))
def b1_normalize_names(spark, sf_dir):
    """B1 on DM_PAIR: ``2000-1`` -> ``20001``; attribute names unchanged."""
    return S.normalize_column_names(B.dm_pair(spark, sf_dir))


@register("b2_select_usable", _pair_sel([(qi(m), m) for m in RAW_MONTHS]))
def b2_select_usable(spark, sf_dir):
    """B2 on DM_PAIR: keep the 21 month columns by normalised name."""
    return S.select_usable_columns(B.dm_pair(spark, sf_dir), RAW_MONTHS)[0]


@register("b3_remove_categorical", _pair_sel([(qi(m), m) for m in RAW_MONTHS]))
def b3_remove_categorical(spark, sf_dir):
    """B3 on DM_PAIR: the default attribute list goes."""
    return S.remove_categorical_columns(B.dm_pair(spark, sf_dir))[0]


@register("b4_numeric_only", _pair_sel([("codigo_almacen", "codigo_almacen"), ("codigo_producto", "codigo_producto"),
                                        ("valor_promedio", "valor_promedio")] + [(qi(m), m) for m in RAW_MONTHS]))
def b4_numeric_only(spark, sf_dir):
    """B4 on DM_PAIR: string attributes dropped."""
    return S.numeric_only(B.dm_pair(spark, sf_dir))[0]


@register("b5_single_target", "SELECT product_id, " + ", ".join(r6(qi(m), m) for m in FEATURES)
          + f", {r6(qi(TARGET), 'label')} FROM ({dm_sql()})")
def b5_single_target(spark, sf_dir):
    """B5 on DM: the target month becomes ``label``."""
    return S.prepare_target(B.dm(spark, sf_dir), TARGET)


_T1, _T2 = FEATURES[-1], TARGET


@register("b6_multi_target", "SELECT product_id, " + ", ".join(r6(qi(m), m) for m in FEATURES[:-1]) + ", "
          + r6(f"(coalesce({qi(_T1)}, 0) + coalesce({qi(_T2)}, 0)) / nullif(({qi(_T1)} IS NOT NULL)::INT + "
               f"({qi(_T2)} IS NOT NULL)::INT, 0)", "label") + f" FROM ({dm_sql(fill=False)})")
def b6_multi_target(spark, sf_dir):
    """B6 on DM_NULL: label = row mean of the last two months, NULLs skipped."""
    return S.prepare_target(B.dm_null(spark, sf_dir), [_T1, _T2])


@register("b9_analysis_columns", _pair_sel([(qi(m), m.replace("-", "")) for m in RAW_MONTHS]))
def b9_analysis_columns(spark, sf_dir):
    """B9 on normalised DM_PAIR: loose match of ``20001`` with ``2000-1``."""
    return S.analysis_columns_fallback(S.normalize_column_names(B.dm_pair(spark, sf_dir)), RAW_MONTHS)[0]


# =============================================================== C cleaning

_DUPES = "(SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders)"


@register("c1_remove_duplicates", f"SELECT DISTINCT * FROM {_DUPES}")
def c1_remove_duplicates(spark, sf_dir):
    """C1 on DUPES: full-row distinct."""
    return C.remove_duplicates(B.dupes(spark, sf_dir))


@register("c1_duplicate_stats", f"SELECT count(*)::BIGINT AS rows_initial, "
          f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {_DUPES}))::BIGINT AS rows_final, "
          f"(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {_DUPES})))::BIGINT AS duplicates_removed "
          f"FROM {_DUPES}")
def c1_duplicate_stats(spark, sf_dir):
    """C1 counters on DUPES."""
    return C.duplicate_stats(B.dupes(spark, sf_dir))


def _any_null_sql(cols) -> str:
    return " OR ".join(f"{qi(c)} IS NULL" for c in cols)


@register("c2_drop_any_null", _sel_months(f"({dm_sql(fill=False)}) WHERE NOT ({_any_null_sql(MONTHS)})"))
def c2_drop_any_null(spark, sf_dir):
    """C2 on DM_NULL: rows with any NULL month go."""
    return C.drop_any_null(B.dm_null(spark, sf_dir))


_NUM = ["product_id"] + MONTHS


@register("c3_non_negative", _sel_months(f"({dm_sql(signed=True)}) WHERE "
                                         + " AND ".join(f"{qi(c)} >= 0" for c in _NUM)))
def c3_non_negative(spark, sf_dir):
    """C3 on DM_SIGNED."""
    return C.keep_non_negative(B.dm_signed(spark, sf_dir))


def _range_sql(c, lo=1, hi=100000) -> str:
    return f"(({qi(c)} >= {lo} OR {qi(c)} = 0) AND {qi(c)} <= {hi})"


@register("c4_value_range", _sel_months(f"({dm_sql(signed=True)}) WHERE " + " AND ".join(_range_sql(c) for c in _NUM)))
def c4_value_range(spark, sf_dir):
    """C4 on DM_SIGNED with the default range (1, 100000)."""
    return C.keep_in_range(B.dm_signed(spark, sf_dir), 1, 100000)


def _c5_sql() -> str:
    branches = " ".join(f"WHEN NOT ({qi(c)} >= 0 AND {_range_sql(c)}) THEN 'rows_dropped_{c}'" for c in _NUM)
    tagged = (f"SELECT CASE WHEN {_any_null_sql(_NUM)} THEN 'rows_dropped_empty' {branches} END AS r "
              f"FROM ({dm_sql(signed=True)})")
    return (f"WITH t AS ({tagged}) "
            "SELECT r AS stat, count(*)::BIGINT AS rows FROM t WHERE r IS NOT NULL GROUP BY r "
            "UNION ALL SELECT 'rows_dropped_empty', 0::BIGINT WHERE NOT EXISTS "
            "(SELECT 1 FROM t WHERE r = 'rows_dropped_empty') "
            "UNION ALL SELECT 'total_rows_initial', count(*)::BIGINT FROM t "
            "UNION ALL SELECT 'total_rows_final', count(*) FILTER (WHERE r IS NULL)::BIGINT FROM t "
            "UNION ALL SELECT 'total_rows_dropped', count(*) FILTER (WHERE r IS NOT NULL)::BIGINT FROM t")


_FCFG = C.FilterConfig(remove_empty=True, remove_negative=True, value_range=(1, 100000))


@register("c5_filter_stats", _c5_sql())
def c5_filter_stats(spark, sf_dir):
    """C5 on DM_SIGNED: drops attributed to the first failing rule."""
    return C.filter_values(B.dm_signed(spark, sf_dir), _FCFG)[1]


@register("c6_drop_null_label", "SELECT product_id, " + ", ".join(r6(qi(m), m) for m in FEATURES)
          + f", {r6(qi(TARGET), 'label')} FROM ({dm_sql(fill=False)}) WHERE {qi(TARGET)} IS NOT NULL")
def c6_drop_null_label(spark, sf_dir):
    """C6 on DM_NULL with the target month as label."""
    return C.drop_null_label(S.prepare_target(B.dm_null(spark, sf_dir), TARGET))


def _c8_src() -> str:
    # DM_SIGNED with a NULL label where the target month had no sales at all
    d = dm_sql(signed=True)
    return (f"SELECT s.*, n.{qi(TARGET)} IS NULL AS _nolabel FROM ({d}) s "
            f"JOIN ({dm_sql(fill=False)}) n USING (product_id)")


def _c8_frame(spark, sf_dir):
    s = B.dm_signed(spark, sf_dir)
    n = B.dm_null(spark, sf_dir).select("product_id", F.col(TARGET).isNull().alias("_nolabel"))
    j = s.join(n, "product_id")
    y = F.when(F.col("_nolabel"), F.lit(None).cast("double")).otherwise(F.col(TARGET))
    return j.select("product_id", *FEATURES, y.alias("label"))


@register("c8_clean_rows", "SELECT product_id, " + ", ".join(r6(qi(m), m) for m in FEATURES)
          + f", {r6(f'greatest({qi(TARGET)}, 0)', 'label')} FROM ({_c8_src()}) WHERE NOT _nolabel")
def c8_clean_rows(spark, sf_dir):
    """C8 on DM_SIGNED (label NULL when the target month had no sales):
    dedup, drop NULL labels, clip negative labels."""
    return C.clean_rows(_c8_frame(spark, sf_dir))[0]


@register("c8_clean_stats",
          f"WITH t AS ({_c8_src()}) SELECT v.stat, x.rows FROM (VALUES ('rows_initial'), ('duplicates_removed'), "
          "('null_target_removed'), ('negative_target_clipped'), ('rows_final')) v(stat) JOIN ("
          "SELECT 'rows_initial' AS k, count(*)::BIGINT AS rows FROM t UNION ALL "
          "SELECT 'duplicates_removed', 0::BIGINT UNION ALL "
          "SELECT 'null_target_removed', count(*) FILTER (WHERE _nolabel)::BIGINT FROM t UNION ALL "
          f"SELECT 'negative_target_clipped', count(*) FILTER (WHERE NOT _nolabel AND {qi(TARGET)} < 0)::BIGINT FROM t "
          "UNION ALL SELECT 'rows_final', count(*) FILTER (WHERE NOT _nolabel)::BIGINT FROM t) x ON x.k = v.stat")
def c8_clean_stats(spark, sf_dir):
    """C8 counters (product ids are unique, so no duplicates)."""
    return C.clean_rows(_c8_frame(spark, sf_dir))[1]


# =============================================================== D preparation

def _glob(agg: str, c: str) -> str:
    return f"{agg}({qi(c)}) OVER ()"


@register("d1_impute_mean", _sel_months(f"({dm_sql(fill=False)})",
                                        {m: f"coalesce({qi(m)}, {_glob('avg', m)})" for m in MONTHS}))
def d1_impute_mean(spark, sf_dir):
    """D1 on DM_NULL."""
    return D.impute(B.dm_null(spark, sf_dir), "mean", MONTHS)


def _med_sql(fill: bool, signed: bool = False, body=None) -> str:
    qs = ", ".join(f"quantile_cont({qi(m)}, 0.5) AS {qi('md_' + m)}, quantile_cont({qi(m)}, 0.25) AS {qi('q1_' + m)}, "
                   f"quantile_cont({qi(m)}, 0.75) AS {qi('q3_' + m)}" for m in MONTHS)
    return f"WITH d AS ({dm_sql(fill=fill, signed=signed)}), q AS (SELECT {qs} FROM d) " + body


@register("d2_impute_median", _med_sql(False, body=_sel_months(
    "d, q", {m: f"coalesce({qi(m)}, {qi('md_' + m)})" for m in MONTHS})))
def d2_impute_median(spark, sf_dir):
    """D2 on DM_NULL: exact median (interpolated), not MLlib's Imputer."""
    return D.impute(B.dm_null(spark, sf_dir), "median", MONTHS)


def _d3_expr(m: str) -> str:
    return (f"coalesce(last_value({qi(m)} IGNORE NULLS) OVER (ORDER BY product_id ROWS BETWEEN UNBOUNDED PRECEDING "
            f"AND CURRENT ROW), first_value({qi(m)} IGNORE NULLS) OVER (ORDER BY product_id ROWS BETWEEN CURRENT ROW "
            f"AND UNBOUNDED FOLLOWING))")


@register("d3_forward_back_fill", _sel_months(f"({dm_sql(fill=False)})", {m: _d3_expr(m) for m in MONTHS}))
def d3_forward_back_fill(spark, sf_dir):
    """D3 on DM_NULL in product order: a NULL month takes the previous
    product's value, leading NULLs the next one's."""
    return D.forward_back_fill(B.dm_null(spark, sf_dir), ["product_id"], MONTHS)


@register("d4_residual_fill", _sel_months(f"({dm_sql(fill=False)})",
                                          {m: f"coalesce({qi(m)}, {_glob('avg', m)}, 0)" for m in MONTHS}))
def d4_residual_fill(spark, sf_dir):
    """D4 on DM_NULL."""
    return D.residual_fill(B.dm_null(spark, sf_dir), MONTHS)


def _wins(m: str) -> str:
    q1, q3 = qi("q1_" + m), qi("q3_" + m)
    return f"least(greatest({qi(m)}, {q1} - 1.5 * ({q3} - {q1})), {q3} + 1.5 * ({q3} - {q1}))"


@register("d6_iqr_winsorise", _med_sql(True, True, _sel_months("d, q", {m: _wins(m) for m in MONTHS})))
def d6_iqr_winsorise(spark, sf_dir):
    """D6 on DM_SIGNED (k = 1.5)."""
    return D.iqr_winsorise(B.dm_signed(spark, sf_dir), MONTHS, 1.5)


def _z(m: str, t: float = 1.5) -> str:
    mu, sd = _glob("avg", m), _glob("stddev_pop", m)
    return (f"CASE WHEN count(*) OVER () = {_glob('count', m)} AND {sd} > 0 AND abs({qi(m)} - {mu}) > {t} * {sd} "
            f"THEN {mu} ELSE {qi(m)} END")


@register("d7_zscore_replace", _sel_months(f"({dm_sql()})", {m: _z(m) for m in MONTHS}))
def d7_zscore_replace(spark, sf_dir):
    """D7 on DM, t = 1.5 (the pipeline's shared default)."""
    return D.zscore_replace(B.dm(spark, sf_dir), MONTHS, 1.5)


@register("d7_zscore_replace_null", _sel_months(f"({dm_sql(fill=False)})", {m: _z(m) for m in MONTHS}))
def d7_zscore_replace_null(spark, sf_dir):
    """D7 on DM_NULL: a column with any NULL is left untouched."""
    return D.zscore_replace(B.dm_null(spark, sf_dir), MONTHS, 1.5)


@register("d8_clip_negative", _sel_months(f"({dm_sql(signed=True)})", {m: f"greatest({qi(m)}, 0)" for m in MONTHS}))
def d8_clip_negative(spark, sf_dir):
    """D8 on DM_SIGNED."""
    return D.clip_negative(B.dm_signed(spark, sf_dir), MONTHS)


@register("d8_negative_count", "SELECT (" + " + ".join(f"count(*) FILTER (WHERE {qi(m)} < 0)" for m in MONTHS)
          + f")::BIGINT AS negative_values FROM ({dm_sql(signed=True)})")
def d8_negative_count(spark, sf_dir):
    return D.negative_count(B.dm_signed(spark, sf_dir), MONTHS)


def _scaled(m: str, center: str, scale: str) -> str:
    return f"({qi(m)} - {center}) / CASE WHEN coalesce({scale}, 0) = 0 THEN 1 ELSE {scale} END"


@register("d9_standard_scaler", _sel_months(f"({dm_sql()})", {
    m: _scaled(m, _glob("avg", m), _glob("stddev_pop", m)) for m in MONTHS}))
def d9_standard_scaler(spark, sf_dir):
    """D9 on DM: population sigma, zero sigma -> 1."""
    return D.scale(B.dm(spark, sf_dir), "standardscaler", MONTHS)


@register("d10_minmax_scaler", _sel_months(f"({dm_sql()})", {
    m: _scaled(m, _glob("min", m), f"({_glob('max', m)} - {_glob('min', m)})") for m in MONTHS}))
def d10_minmax_scaler(spark, sf_dir):
    """D10 on DM: constant column -> 0."""
    return D.scale(B.dm(spark, sf_dir), "minmaxscaler", MONTHS)


def _robust_pair_sql() -> str:
    qs = ", ".join(f"quantile_cont({qi(m)}, 0.5) AS {qi('md_' + m)}, quantile_cont({qi(m)}, 0.75) - "
                   f"quantile_cont({qi(m)}, 0.25) AS {qi('iqr_' + m)}" for m in RAW_MONTHS)
    sel = ", ".join(r6(_scaled(m, qi("md_" + m), qi("iqr_" + m)), m) for m in RAW_MONTHS)
    return (f"WITH d AS ({dm_pair_sql()}), q AS (SELECT {qs} FROM d) "
            f"SELECT codigo_almacen, codigo_producto, {sel} FROM d, q")


@register("d11_robust_scaler", _robust_pair_sql())
def d11_robust_scaler(spark, sf_dir):
    """D11 on DM_PAIR: every month has IQR 0 there, so it divides by 1."""
    d = B.dm_pair(spark, sf_dir).select("codigo_almacen", "codigo_producto", *[F.col(f"`{m}`") for m in RAW_MONTHS])
    return D.scale(d, "robust", RAW_MONTHS)


def _d12_sql() -> str:
    d = f"SELECT *, {_h('product_id')} AS u FROM ({dm_sql()})"
    stats = ", ".join(f"avg({qi(m)}) AS {qi('mu_' + m)}, stddev_pop({qi(m)}) AS {qi('sd_' + m)}" for m in MONTHS)
    sel = ", ".join(r6(_scaled(m, qi("mu_" + m), qi("sd_" + m)), m) for m in MONTHS)
    return (f"WITH d AS ({d}), s AS (SELECT {stats} FROM d WHERE u < 0.6) "
            f"SELECT product_id, {sel} FROM d, s WHERE u >= 0.8")


@register("d12_fitted_scaler_reuse", _d12_sql())
def d12_fitted_scaler_reuse(spark, sf_dir):
    """The scaler fitted on the train split of DM, its parameter table
    saved as Parquet, reloaded and applied to the test split."""
    d = SP.split_data(B.dm(spark, sf_dir), "product_id")
    params = D.fit_scaler(d.filter("split = 'train'"), "standardscaler", MONTHS)
    path = work_dir(spark, "d12") + "/scaler.parquet"
    A.save_data(params, path, "parquet")
    test = d.filter("split = 'test'").drop("split")
    return D.apply_scaler(test, A.load_data(spark, path))


def _flags_sql(src: str, cols: list[str], expr) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, ({expr(c)}) AS is_constant FROM ({src})" for c in cols)


@register("d13_constant_flags", _flags_sql(dm_pair_sql(), _PAIR_NORMALISED[:7] + RAW_MONTHS,
                                           lambda c: f"count(DISTINCT {qi(c)}) = 1"))
def d13_constant_flags(spark, sf_dir):
    """D13 on DM_PAIR: which columns the operator finds constant."""
    d = B.dm_pair(spark, sf_dir)
    found = set(D.constant_columns(d))
    return spark.createDataFrame([(c, c in found) for c in d.columns], "column_name string, is_constant boolean")


_X2 = f"{FEATURES[-1]}_x2"


def _d14_sql(thr: float = 0.95) -> str:
    cols = MONTHS + [_X2]
    d = f"SELECT *, 2 * {qi(FEATURES[-1])} AS {qi(_X2)} FROM ({dm_sql()})"
    pairs = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            pairs.append(f"SELECT '{b}' AS c, abs(regr_sxy({qi(b)}, {qi(a)}) / nullif(sqrt(regr_sxx({qi(b)}, {qi(a)}) "
                         f"* regr_syy({qi(b)}, {qi(a)})), 0)) > {thr} AS hit FROM d")
    return (f"WITH d AS MATERIALIZED ({d}), p AS ({' UNION ALL '.join(pairs)}) "
            "SELECT v.column_name, coalesce(bool_or(p.hit), false) AS dropped FROM (VALUES "
            + ", ".join(f"('{c}')" for c in cols) + ") v(column_name) LEFT JOIN p ON p.c = v.column_name "
            "GROUP BY v.column_name")


@register("d14_correlated_features", _d14_sql())
def d14_correlated_features(spark, sf_dir):
    """D14 on DM plus a derived copy (2 x last feature month): |corr| > 0.95
    with an earlier column drops the later one."""
    d = B.dm(spark, sf_dir).withColumn(_X2, 2 * F.col(FEATURES[-1]))
    cols = MONTHS + [_X2]
    dropped = set(D.correlated_columns(d, 0.95, cols))
    return spark.createDataFrame([(c, c in dropped) for c in cols], "column_name string, dropped boolean")


def _d15_sql() -> str:
    feats = [m.replace("-", "") for m in RAW_MONTHS[:-1]]
    src = (f"SELECT codigo_almacen, codigo_producto, " + ", ".join(f"{qi(m)} AS {qi(m.replace('-', ''))}"
                                                                   for m in RAW_MONTHS[:-1]) + f" FROM ({dm_pair_sql()})")
    sel = ", ".join(r6(_scaled(f, _glob("avg", f), _glob("stddev_pop", f)), f) for f in feats)
    return f"SELECT codigo_almacen, codigo_producto, {sel} FROM ({src})"


@register("d15_process_pipeline", _d15_sql())
def d15_process_pipeline(spark, sf_dir):
    """D15 on DM_PAIR (raw month names): normalise names, keep the usable
    feature months, drop attributes, mean-impute, clip negatives, residual
    fill, standard-scale; the pair key passes through."""
    cfg = D.PrepConfig(usable_columns=tuple(RAW_MONTHS[:-1]))
    prep = D.FeaturePrep(cfg, passthrough=["codigo_almacen", "codigo_producto"])
    _, out = prep.fit_transform(B.dm_pair(spark, sf_dir))
    return out


# =============================================================== F splits

@register("f1_split", f"SELECT product_id, CASE WHEN {_h('product_id')} < 0.6 THEN 'train' "
          f"WHEN {_h('product_id')} < 0.8 THEN 'val' ELSE 'test' END AS split FROM ({dm_sql()})")
def f1_split(spark, sf_dir):
    """F1 on DM: 60/20/20 by md5(product_id:42)."""
    return SP.split_data(B.dm(spark, sf_dir), "product_id").select("product_id", "split")


@register("f7_split_sizes", f"SELECT split, count(*)::BIGINT AS n_rows FROM (SELECT CASE WHEN {_h('product_id')} < 0.6 "
          f"THEN 'train' WHEN {_h('product_id')} < 0.8 THEN 'val' ELSE 'test' END AS split FROM ({dm_sql()})) "
          "GROUP BY split")
def f7_split_sizes(spark, sf_dir):
    return SP.split_sizes(SP.split_data(B.dm(spark, sf_dir), "product_id"))


def _f1_exact_sql() -> str:
    return (f"WITH r AS (SELECT product_id, row_number() OVER (ORDER BY {_h('product_id')}, product_id) - 1 AS r, "
            f"count(*) OVER () AS n FROM ({dm_sql()})), b AS (SELECT *, ceil(n * 0.2) AS nt FROM r), "
            "c AS (SELECT *, ceil((n - nt) * (0.2 / 0.8)) AS nv FROM b) "
            "SELECT product_id, CASE WHEN r < nt THEN 'test' WHEN r < nt + nv THEN 'val' ELSE 'train' END AS split FROM c")


@register("f1_split_exact", _f1_exact_sql())
def f1_split_exact(spark, sf_dir):
    """F1 exact sizes (ceil of the source's fractions) by hash rank."""
    return SP.split_data(B.dm(spark, sf_dir).select("product_id"), "product_id", exact=True)


@register("f2_hash_folds", f"SELECT product_id, least(floor({_h('product_id')} * 5), 4)::INTEGER AS fold FROM ({dm_sql()})")
def f2_hash_folds(spark, sf_dir):
    return SP.hash_folds(B.dm(spark, sf_dir).select("product_id"), "product_id", 5)


@register("f3_stratified_folds", f"SELECT product_id, label, ((row_number() OVER (PARTITION BY label ORDER BY "
          f"{_h('product_id')}, product_id) - 1) % 5)::INTEGER AS fold FROM (SELECT product_id, "
          f"({qi(TARGET)} > 0)::INTEGER AS label FROM ({dm_sql()}))")
def f3_stratified_folds(spark, sf_dir):
    """classes = target month has sales; round-robin inside each class."""
    d = B.dm(spark, sf_dir).select("product_id", (F.col(TARGET) > 0).cast("int").alias("label"))
    return SP.stratified_folds(d, "product_id", "label", 5)


def _contig_sql(k: int) -> str:
    return (f"WITH r AS (SELECT product_id, row_number() OVER (ORDER BY product_id) - 1 AS r, count(*) OVER () AS n "
            f"FROM ({dm_sql()})), b AS (SELECT *, n // {k} + 1 AS big, n // {k} AS small, n % {k} AS nb FROM r) "
            "SELECT product_id, (CASE WHEN r < nb * big THEN r // big ELSE nb + (r - nb * big) // small END)::INTEGER "
            "AS fold FROM b")


@register("f4_contiguous_folds", _contig_sql(5))
def f4_contiguous_folds(spark, sf_dir):
    """cv=5 over product order."""
    return SP.contiguous_folds(B.dm(spark, sf_dir).select("product_id"), ["product_id"], 5)


@register("f5_head_sample", f"SELECT product_id FROM (SELECT product_id, row_number() OVER (ORDER BY product_id) - 1 AS r, "
          f"count(*) OVER () AS n FROM ({dm_sql()})) WHERE r < greatest(n // 5, 1000)")
def f5_head_sample(spark, sf_dir):
    """first max(n // 5, 1000) products."""
    return SP.head_sample(B.dm(spark, sf_dir).select("product_id"), ["product_id"])


@register("f6_chunks", "SELECT l_orderkey, l_linenumber, ((row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1) "
          "// 2000)::INTEGER AS chunk FROM lineitem")
def f6_chunks(spark, sf_dir):
    """F6 on lineitem: 2000-row chunks in (order, line) order."""
    li = B.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return SP.chunk_ids(li, ["l_orderkey", "l_linenumber"], 2000)


@register("f8_row_index", "SELECT l_orderkey, l_linenumber, (row_number() OVER (ORDER BY l_shipdate, l_orderkey, "
          "l_linenumber) - 1)::BIGINT AS row_idx FROM lineitem")
def f8_row_index(spark, sf_dir):
    """F8 on lineitem: dense position in ship-date order, no single-partition window."""
    li = B.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return SP.row_index(li, ["l_shipdate", "l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber",
                                                                                  "row_idx")


# =============================================================== H evaluation

def _h7_cols(df):
    return df.select(*[c for c in df.columns if c != "mape"], (F.col("mape") * 1e-15).alias("mape_e15"))


@register("h7_leaderboard", _leaderboard_sql())
def h7_leaderboard(spark, sf_dir):
    """H1-H7 on PREDS: all metrics for the three naive predictors, one job."""
    return _h7_cols(H.evaluate(B.preds(spark, sf_dir)))


def _split_preds_sql() -> str:
    return (f"SELECT p.*, CASE WHEN {_h('product_id')} < 0.6 THEN 'train' WHEN {_h('product_id')} < 0.8 THEN 'val' "
            f"ELSE 'test' END AS split FROM ({preds_sql()}) p")


def _split_preds(spark, sf_dir):
    s = uniform_hash(F.col("product_id"))
    return B.preds(spark, sf_dir).withColumn("split", F.when(s < 0.6, "train").when(s < 0.8, "val").otherwise("test"))


@register("h7_leaderboard_by_split", _leaderboard_sql().replace(f"FROM ({preds_sql()})", f"FROM ({_split_preds_sql()})")
          .replace("SELECT model,", "SELECT model, split,").replace("GROUP BY model", "GROUP BY model, split"))
def h7_leaderboard_by_split(spark, sf_dir):
    """H7 per (model, split) in one aggregate."""
    return _h7_cols(H.evaluate(_split_preds(spark, sf_dir), by=["model", "split"]))


def _best_sql(metric: str, lower: bool) -> str:
    k = metric if lower else f"-{metric}"
    return (f"SELECT arg_min(model, (coalesce({k}, 'inf'::DOUBLE), model)) AS best_model FROM "
            f"({_leaderboard_sql().replace('round(', 'round(')})")


@register("h8_best_by_mae", _best_sql("mae", True))
def h8_best_by_mae(spark, sf_dir):
    return H.best_model(H.evaluate(B.preds(spark, sf_dir)), "mae")


@register("h8_best_by_r2", _best_sql("r2", False))
def h8_best_by_r2(spark, sf_dir):
    return H.best_model(H.evaluate(B.preds(spark, sf_dir)), "r2")


@register("h14_prediction_errors", "SELECT model, " + ", ".join([
    r6("avg(y - p)", "mean_error"), r6("stddev_pop(y - p)", "std_error"), r6("min(y - p)", "min_error"),
    r6("max(y - p)", "max_error"), r6("quantile_cont(y - p, 0.5)", "median_error"),
    r6("quantile_cont(y - p, 0.05)", "percentile_5"), r6("quantile_cont(y - p, 0.95)", "percentile_95")])
    + f" FROM ({preds_sql()}) GROUP BY model")
def h14_prediction_errors(spark, sf_dir):
    return H.prediction_errors(B.preds(spark, sf_dir), by=["model"])


# =============================================================== I comparison

def _first_rows_sql() -> str:
    lb = _leaderboard_sql(rounded=False).replace(f"FROM ({preds_sql()})", f"FROM ({_split_preds_sql()})") \
        .replace("SELECT model,", "SELECT model, split,").replace("GROUP BY model", "GROUP BY model, split")
    return (f"WITH lb AS ({lb}), f AS (SELECT split, arg_min(model, (mae, rmse, -r2, model)) AS m FROM lb "
            "GROUP BY split) SELECT CASE lb.split WHEN 'val' THEN 'A' ELSE 'B' END AS source, "
            "(CASE lb.split WHEN 'val' THEN 0 ELSE 1 END)::INTEGER AS source_rank, lb.model AS model_name, "
            "lb.mae, lb.rmse, lb.r2 FROM lb JOIN f ON lb.split = f.split AND lb.model = f.m "
            "WHERE lb.split IN ('val', 'test')")


def _result_sources(spark, sf_dir):
    """Two result tables derived from the data -- the leaderboards of
    the validation (source A) and test (source B) splits -- written as
    CSV, then loaded back through the source's header aliases."""
    base = work_dir(spark, "i1")
    sp = _split_preds(spark, sf_dir)
    out = None
    for rank, (split, src) in enumerate((("val", "A"), ("test", "B"))):
        lb = H.evaluate(sp.filter(F.col("split") == split))
        lb = lb.select(F.col("model").alias("Model"), F.col("mae").alias("MAE"), F.col("rmse").alias("RMSE"),
                       F.col("r2").alias("R2-Score"), "mse")
        path = f"{base}/{split}.csv"
        A.save_small_table(lb, path)
        one = I.load_result(spark, path, src, rank)
        out = one if out is None else out.unionByName(one)
    return out


@register("i1_first_rows", "SELECT source, source_rank, model_name, " + ", ".join(r6(c, c) for c in ["mae", "rmse", "r2"])
          + f" FROM ({_first_rows_sql()})", digits=6)
def i1_first_rows(spark, sf_dir):
    return _result_sources(spark, sf_dir)


@register("i2_winner", f"WITH r AS ({_first_rows_sql()}), s AS (SELECT * FROM r ORDER BY mae, source_rank) "
          "SELECT arg_min(source, (mae, source_rank)) AS winner_source, arg_min(model_name, (mae, source_rank)) AS "
          "winner_model, round(min(mae), 6) AS winner_mae, round(max(mae) FILTER (WHERE source <> "
          "(SELECT arg_min(source, (mae, source_rank)) FROM r)), 6) AS runner_up_mae, "
          "round((max(mae) - min(mae)) / max(mae) * 100.0, 6) AS improvement_mae_pct FROM r")
def i2_winner(spark, sf_dir):
    """The lower MAE of the two wins, improvement % over the other."""
    return I.winner(_result_sources(spark, sf_dir))


def _i3_sql() -> str:
    r = _first_rows_sql()
    parts = []
    for m, lower in (("mae", True), ("rmse", True), ("r2", False)):
        a = f"(SELECT {m} FROM r WHERE source_rank = 0)"
        b = f"(SELECT {m} FROM r WHERE source_rank = 1)"
        win = f"CASE WHEN {b} {'<' if lower else '>'} {a} THEN 'B' ELSE 'A' END"
        diff = f"({a} - {b})" if lower else f"({b} - {a})"
        pct = f"CASE WHEN {a} > 0 THEN {diff} / {a} * 100.0 ELSE 0 END" if lower else "NULL"
        parts.append(f"SELECT '{m}' AS metric, {r6(a, 'value_a')}, {r6(b, 'value_b')}, {win} AS winner, "
                     f"{r6(diff, 'difference')}, {r6(pct, 'difference_pct')}")
    return f"WITH r AS ({r}) " + " UNION ALL ".join(parts)


@register("i3_metric_differences", _i3_sql())
def i3_metric_differences(spark, sf_dir):
    return I.metric_differences(_result_sources(spark, sf_dir))


@register("i4_consolidated", "SELECT model_name, source, " + ", ".join(r6(c, c) for c in ["mae", "rmse", "r2"])
          + f" FROM ({_first_rows_sql()})")
def i4_consolidated(spark, sf_dir):
    return I.consolidated(_result_sources(spark, sf_dir))
