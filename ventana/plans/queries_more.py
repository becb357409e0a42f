"""Further registered queries: inputs on which an operator's rules bite
(NULL groups, NULL labels, repeated rows, NaN, ranges that cut), and outputs
of runs that SQL can check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ventana.models import cv as CV
from ventana.models.classic import LinearOLS
from ventana.operators import clean as C
from ventana.operators import evaluate as H
from ventana.operators import prep as D
from ventana.operators import profile as E
from ventana.operators import schema as S
from ventana.operators import split as SP
from ventana.plans.oracles import dm_pair_sql, dm_sql, long_sql, preds_sql, qi, r6
from ventana.plans.pipeline import RunConfig, run_profile, run_training, winner
from ventana.plans.registry import register
from ventana.session import work_dir
from ventana.sources import bindings as B
from ventana.sources import io as A
from ventana.sources.bindings import FEATURES, MONTHS, RAW_MONTHS, TARGET
from ventana.streaming.filedrop import accounts, score_stream, scored
from ventana.streaming.serve import Bundle

M3 = MONTHS[:3]


def _hash(key: str = "product_id") -> str:
    return f"(('0x' || substr(md5({key}::VARCHAR || ':42'), 1, 8))::BIGINT / 4294967296.0)"


def _cols(cols, table: str = "") -> str:
    return ", ".join(r6(f"{table}{qi(c)}", c) for c in cols)


# ------------------------------------------------------------------ cleaning

@register("c2_drop_any_null_some", f"SELECT product_id, {_cols(M3[:2])} FROM ({dm_sql(fill=False)}) "
          f"WHERE {qi(M3[0])} IS NOT NULL AND {qi(M3[1])} IS NOT NULL")
def c2_drop_any_null_some(spark, sf_dir):
    """C2 on two months of DM_NULL: some rows stay, some go."""
    return C.drop_any_null(B.dm_null(spark, sf_dir).select("product_id", *M3[:2]))


@register("c4_value_range_cut", f"SELECT product_id, {_cols(M3)} FROM ({dm_sql()}) WHERE "
          + " AND ".join(f"(({qi(c)} >= 20 OR {qi(c)} = 0) AND {qi(c)} <= 60)" for c in M3))
def c4_value_range_cut(spark, sf_dir):
    """C4 on three months of DM with (20, 60): both ends cut."""
    return C.keep_in_range(B.dm(spark, sf_dir).select("product_id", *M3), 20, 60, M3)


_NAN_SRC = f"SELECT product_id, {', '.join(f'CASE WHEN product_id % 7 = 3 THEN NULL ELSE {qi(c)} END AS {qi(c)}' for c in M3)} FROM ({dm_sql(signed=True)})"


def _with_nan(spark, sf_dir) -> DataFrame:
    """Three months of DM_SIGNED, NaN for every seventh product."""
    nan = F.lit(float("nan"))
    return B.dm_signed(spark, sf_dir).select("product_id", *[F.when(F.col("product_id") % 7 == 3, nan).otherwise(F.col(c)).alias(c) for c in M3])


@register("c3_non_negative_nan", f"SELECT product_id, {_cols(M3)} FROM ({_NAN_SRC}) WHERE "
          + " AND ".join(f"coalesce({qi(c)} >= 0, false)" for c in M3))
def c3_non_negative_nan(spark, sf_dir):
    """NaN is missing, so its row goes."""
    return C.keep_non_negative(_with_nan(spark, sf_dir), M3)


@register("d1_impute_mean_nan", f"SELECT product_id, " + ", ".join(r6(f"coalesce({qi(c)}, avg({qi(c)}) OVER ())", c) for c in M3)
          + f" FROM ({_NAN_SRC})")
def d1_impute_mean_nan(spark, sf_dir):
    """NaN is filled like NULL."""
    return D.impute(_with_nan(spark, sf_dir), "mean", M3)


def _hole(i: int, key: str = "product_id") -> str:
    return f"(({key} + {i}) % 7 = 3 OR ({key} + {i}) % 11 = 5)"


_HOLES_SRC = ("SELECT product_id, " + ", ".join(f"CASE WHEN {_hole(i)} THEN NULL ELSE {qi(c)} END AS {qi(c)}" for i, c in enumerate(M3))
              + f" FROM ({dm_sql(signed=True)})")


def _with_holes(spark, sf_dir) -> DataFrame:
    """Three months of DM_SIGNED with NaN in a seventh and NULL in an eleventh of every column's cells."""
    def cell(i: int, c: str):
        key, nan = F.col("product_id") + i, F.lit(float("nan"))
        return F.when(key % 7 == 3, nan).when(key % 11 == 5, F.lit(None)).otherwise(F.col(c)).alias(c)
    return B.dm_signed(spark, sf_dir).select("product_id", *[cell(i, c) for i, c in enumerate(M3)])


def _fence(c: str) -> str:
    a, b = f"(SELECT quantile_cont({qi(c)}, 0.25) FROM h)", f"(SELECT quantile_cont({qi(c)}, 0.75) FROM h)"
    return f"CASE WHEN {qi(c)} IS NOT NULL THEN least(greatest({qi(c)}, {a} - 1.5 * ({b} - {a})), {b} + 1.5 * ({b} - {a})) END"


@register("d6_iqr_winsorise_holes", f"WITH h AS MATERIALIZED ({_HOLES_SRC}) SELECT product_id, " + ", ".join(r6(_fence(c), c) for c in M3) + " FROM h")
def d6_iqr_winsorise_holes(spark, sf_dir):
    """Missing cells stay missing, the fences are those of the others."""
    return D.iqr_winsorise(_with_holes(spark, sf_dir), M3, 1.5)


@register("d15_iqr_holes", f"WITH h AS MATERIALIZED ({_HOLES_SRC}), w AS MATERIALIZED (SELECT product_id, " + ", ".join(f"{_fence(c)} AS {qi(c)}" for c in M3)
          + " FROM h), p AS (SELECT product_id, " + ", ".join(f"CASE WHEN {qi(c)} < 0 THEN 0 ELSE {qi(c)} END AS {qi(c)}" for c in M3)
          + " FROM w) SELECT product_id, " + ", ".join(r6(f"coalesce({qi(c)}, avg({qi(c)}) OVER (), 0)", c) for c in M3) + " FROM p")
def d15_iqr_holes(spark, sf_dir):
    """D15 without imputation, with IQR treatment: cells that are missing when
    clipped get the column mean of what clipping leaves."""
    cfg = D.PrepConfig(usable_columns=tuple(M3), handle_missing_values=None, outlier_method="iqr", feature_scaling=None)
    return D.FeaturePrep(cfg, passthrough=["product_id"]).fit_transform(_with_holes(spark, sf_dir))[1]


@register("c5_filter_stats_holes",
          "WITH t AS (SELECT CASE WHEN " + " OR ".join(f"{qi(c)} IS NULL" for c in M3) + " THEN 'rows_dropped_empty' "
          + " ".join(f"WHEN NOT {qi(c)} >= 0 THEN 'rows_dropped_{c}'" for c in M3) + f" END AS r FROM ({_HOLES_SRC})) "
          "SELECT r AS stat, count(*)::BIGINT AS rows FROM t WHERE r IS NOT NULL GROUP BY r "
          "UNION ALL SELECT 'rows_dropped_empty', 0::BIGINT WHERE NOT EXISTS (SELECT 1 FROM t WHERE r = 'rows_dropped_empty') "
          "UNION ALL SELECT 'total_rows_initial', count(*)::BIGINT FROM t "
          "UNION ALL SELECT 'total_rows_final', count(*) FILTER (WHERE r IS NULL)::BIGINT FROM t "
          "UNION ALL SELECT 'total_rows_dropped', count(*) FILTER (WHERE r IS NOT NULL)::BIGINT FROM t")
def c5_filter_stats_holes(spark, sf_dir):
    """Rows with a NULL or a NaN fall to the rule for empty cells."""
    return C.filter_values(_with_holes(spark, sf_dir), C.FilterConfig(remove_empty=True, remove_negative=True))[1]


@register("c5_negative_holes", "WITH t AS (SELECT CASE " + " ".join(f"WHEN NOT coalesce({qi(c)} >= 0, false) THEN 'rows_dropped_{c}'" for c in M3)
          + f" END AS r FROM ({_HOLES_SRC})) SELECT r AS stat, count(*)::BIGINT AS rows FROM t WHERE r IS NOT NULL GROUP BY r "
          "UNION ALL SELECT 'total_rows_initial', count(*)::BIGINT FROM t "
          "UNION ALL SELECT 'total_rows_final', count(*) FILTER (WHERE r IS NULL)::BIGINT FROM t "
          "UNION ALL SELECT 'total_rows_dropped', count(*) FILTER (WHERE r IS NOT NULL)::BIGINT FROM t")
def c5_negative_holes(spark, sf_dir):
    """C5 with the rule for negatives alone: a missing cell is not >= 0."""
    months = _with_holes(spark, sf_dir).select(*M3)
    return C.filter_values(months, C.FilterConfig(remove_negative=True))[1]


@register("c7_clip_label_holes", f"SELECT product_id, {r6(f'CASE WHEN {qi(M3[0])} < 0 THEN 0 ELSE {qi(M3[0])} END', 'label')} FROM ({_HOLES_SRC})")
def c7_clip_label_holes(spark, sf_dir):
    """A missing target stays missing."""
    return C.clip_negative_label(_with_holes(spark, sf_dir).select("product_id", F.col(M3[0]).alias("label")))


@register("c8_clean_rows_holes", f"SELECT {_cols(M3[1:])}, {r6(f'greatest({qi(M3[0])}, 0)', 'label')} FROM (SELECT DISTINCT {', '.join(map(qi, M3))} FROM ({_HOLES_SRC})) "
          f"WHERE {qi(M3[0])} IS NOT NULL")
def c8_clean_rows_holes(spark, sf_dir):
    """C8 without a key: NaN equals NULL among copies, a NaN label goes, NaN cells come back as NULL."""
    return C.clean_rows(_with_holes(spark, sf_dir).select(*M3[1:], F.col(M3[0]).alias("label")))[0]


@register("b6_multi_target_holes", f"SELECT product_id, {_cols(M3[2:])}, " + r6(
    f"(coalesce({qi(M3[0])}, 0) + coalesce({qi(M3[1])}, 0)) / nullif(({qi(M3[0])} IS NOT NULL)::INT + ({qi(M3[1])} IS NOT NULL)::INT, 0)", "label")
    + f" FROM ({_HOLES_SRC})")
def b6_multi_target_holes(spark, sf_dir):
    """NaN targets are skipped like NULL ones."""
    return A.nan_as_null(S.prepare_target(_with_holes(spark, sf_dir), M3[:2]))


@register("d5_drop_becomes_mean", f"WITH h AS MATERIALIZED ({_HOLES_SRC}), f AS (SELECT product_id, "
          + ", ".join(f"coalesce({qi(c)}, avg({qi(c)}) OVER ()) AS {qi(c)}" for c in M3) + " FROM h) SELECT product_id, "
          + ", ".join(r6(f"CASE WHEN {qi(c)} < 0 THEN 0 ELSE {qi(c)} END", c) for c in M3) + " FROM f")
def d5_drop_becomes_mean(spark, sf_dir):
    """After the split no row is dropped; 'drop' fills the column mean."""
    cfg = D.PrepConfig(usable_columns=tuple(M3), handle_missing_values="drop", feature_scaling=None)
    return D.FeaturePrep(cfg, passthrough=["product_id"]).fit_transform(_with_holes(spark, sf_dir))[1]


@register("a5_catalog_load", "SELECT l_returnflag, count(*)::BIGINT AS n_rows, " + r6("sum(l_quantity)", "units") + " FROM lineitem GROUP BY l_returnflag")
def a5_catalog_load(spark, sf_dir):
    """A5: a table by its configured name."""
    catalog = A.DatasetCatalog({"sales": f"{sf_dir}/lineitem.parquet"})
    return catalog.load(spark, "sales").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").cast("double").alias("units"))


_TWICE = (f"SELECT product_id, {qi(TARGET)} AS label FROM ({dm_sql(signed=True)}) UNION ALL "
          f"SELECT product_id, {qi(TARGET)} FROM ({dm_sql(signed=True)}) WHERE product_id % 3 = 0 UNION ALL "
          f"SELECT product_id, NULL FROM ({dm_sql(signed=True)}) WHERE product_id % 5 = 0")


def _twice(spark, sf_dir) -> DataFrame:
    """DM_SIGNED's label, a third of the rows twice, and rows without a label."""
    d = B.dm_signed(spark, sf_dir).select("product_id", F.col(TARGET).alias("label"))
    return d.unionByName(d.where("product_id % 3 = 0")).unionByName(
        d.where("product_id % 5 = 0").withColumn("label", F.lit(None).cast("double")))


@register("c8_clean_rows_copies", f"SELECT DISTINCT product_id, {r6('greatest(label, 0)', 'label')} FROM ({_TWICE}) WHERE label IS NOT NULL")
def c8_clean_rows_copies(spark, sf_dir):
    """C8 where copies, missing and negative labels all occur."""
    return C.clean_rows(_twice(spark, sf_dir))[0]


@register("c8_clean_stats_copies",
          f"WITH t AS ({_TWICE}), d AS (SELECT DISTINCT * FROM t) SELECT 'rows_initial' AS stat, (SELECT count(*) FROM t)::BIGINT AS rows "
          "UNION ALL SELECT 'duplicates_removed', (SELECT count(*) FROM t) - (SELECT count(*) FROM d) "
          "UNION ALL SELECT 'null_target_removed', (SELECT count(*) FROM d WHERE label IS NULL) "
          "UNION ALL SELECT 'negative_target_clipped', (SELECT count(*) FROM d WHERE label < 0) "
          "UNION ALL SELECT 'rows_final', (SELECT count(*) FROM d WHERE label IS NOT NULL)")
def c8_clean_stats_copies(spark, sf_dir):
    return C.clean_rows(_twice(spark, sf_dir))[1]


@register("c7_clip_label", f"SELECT product_id, {r6(f'greatest({qi(TARGET)}, 0)', 'label')} FROM ({dm_sql(signed=True)})")
def c7_clip_label(spark, sf_dir):
    """C7 by itself."""
    return C.clip_negative_label(B.dm_signed(spark, sf_dir).select("product_id", F.col(TARGET).alias("label")))


@register("b8_template", f"SELECT * FROM (SELECT {', '.join(f'0.0::DOUBLE AS {qi(c)}' for c in RAW_MONTHS[:-1])}) WHERE false")
def b8_template(spark, sf_dir):
    """The empty table of DM_PAIR's usable columns."""
    return S.build_template(spark, [c for c in B.dm_pair(spark, sf_dir).columns if c in RAW_MONTHS[:-1]])


@register("b8_template_filled", f"SELECT {', '.join(r6(qi(c), c) for c in RAW_MONTHS[:-1])} FROM ({dm_pair_sql()})")
def b8_template_filled(spark, sf_dir):
    """The template takes up all rows of DM_PAIR by column name."""
    rows = B.dm_pair(spark, sf_dir)
    template = S.build_template(spark, RAW_MONTHS[:-1])
    return template.unionByName(rows.select(*[F.col(f"`{c}`") for c in reversed(template.columns)]))


# ---------------------------------------------------------------- preparation

_G = "CASE WHEN product_id % 4 = 0 THEN NULL ELSE product_id % 4 END"
_FB = (f"coalesce(last_value({qi(M3[0])} IGNORE NULLS) OVER (PARTITION BY g ORDER BY product_id), "
       f"first_value({qi(M3[0])} IGNORE NULLS) OVER (PARTITION BY g ORDER BY product_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))")


@register("d3_group_null", f"SELECT product_id, g, {r6(_FB, M3[0])} FROM (SELECT product_id, {_G} AS g, {qi(M3[0])} FROM ({dm_sql(fill=False)}))")
def d3_group_null(spark, sf_dir):
    """D3 per group, one of which is NULL."""
    g = F.when(F.col("product_id") % 4 != 0, F.col("product_id") % 4)
    d = B.dm_null(spark, sf_dir).select("product_id", g.alias("g"), M3[0])
    return D.forward_back_fill(d, ["product_id"], [M3[0]], ["g"])


@register("d4_residual_fill_empty", f"SELECT product_id, {r6(f'coalesce({qi(M3[0])}, avg({qi(M3[0])}) OVER (), 0)', M3[0])}, 0.0::DOUBLE AS nothing "
          f"FROM ({dm_sql(fill=False)})")
def d4_residual_fill_empty(spark, sf_dir):
    """D4 with a column of NULLs alone: it becomes 0."""
    d = B.dm_null(spark, sf_dir).select("product_id", M3[0], F.lit(None).cast("double").alias("nothing"))
    return D.residual_fill(d, [M3[0], "nothing"])


def _robust_sql() -> str:
    qs = ", ".join(f"quantile_cont({qi(m)}, 0.5) AS {qi('md_' + m)}, quantile_cont({qi(m)}, 0.75) - quantile_cont({qi(m)}, 0.25) AS {qi('iqr_' + m)}"
                   for m in MONTHS)
    sel = ", ".join(r6(f"({qi(m)} - {qi('md_' + m)}) / CASE WHEN {qi('iqr_' + m)} = 0 THEN 1 ELSE {qi('iqr_' + m)} END", m) for m in MONTHS)
    return f"WITH d AS MATERIALIZED ({dm_sql()}), q AS (SELECT {qs} FROM d) SELECT product_id, {sel} FROM d, q"


@register("d11_robust_scaler_spread", _robust_sql())
def d11_robust_scaler_spread(spark, sf_dir):
    """D11 on DM, whose months have a positive IQR."""
    return D.scale(B.dm(spark, sf_dir), "robust", MONTHS)


@register("d13_remove_constant", f"SELECT product_id, {_cols(M3)} FROM ({dm_sql()})")
def d13_remove_constant(spark, sf_dir):
    """A constant column goes, one of NULLs alone would stay (not added here)."""
    return D.remove_constant_features(B.dm(spark, sf_dir).select("product_id", *M3, F.lit(4.0).alias("same")))[0]


# Sums of seven months each, NULL where none had sales: spread as well as holes.
THIRDS = {f"third{i}": MONTHS[7 * i:7 * i + 7] for i in range(3)}


def _thirds_sql() -> str:
    def total(ms):
        some = " OR ".join(f"{qi(m)} IS NOT NULL" for m in ms)
        return f"CASE WHEN {some} THEN " + " + ".join(f"coalesce({qi(m)}, 0)" for m in ms) + " END"
    return "SELECT product_id, " + ", ".join(f"{total(ms)} AS {c}" for c, ms in THIRDS.items()) + f" FROM ({dm_sql(fill=False)})"


def _thirds(spark, sf_dir) -> DataFrame:
    def total(ms):
        return F.when(F.coalesce(*ms).isNotNull(), sum((F.coalesce(F.col(m), F.lit(0.0)) for m in ms), F.lit(0.0)))
    return B.dm_null(spark, sf_dir).select("product_id", *[total(ms).alias(c) for c, ms in THIRDS.items()])


def _d15_sql(kind: str) -> str:
    """Impute the mean, then measure, treat outliers, clip, scale."""
    cols = list(THIRDS)
    f = ", ".join(f"coalesce({qi(c)}, avg({qi(c)}) OVER ()) AS {qi(c)}" for c in cols)
    if kind == "iqr":
        q = ", ".join(f"quantile_cont({qi(c)}, 0.25) AS {qi('a_' + c)}, quantile_cont({qi(c)}, 0.75) AS {qi('b_' + c)}" for c in cols)
        w = ", ".join(f"least(greatest({qi(c)}, {qi('a_' + c)} - 1.5 * ({qi('b_' + c)} - {qi('a_' + c)})), "
                      f"{qi('b_' + c)} + 1.5 * ({qi('b_' + c)} - {qi('a_' + c)})) AS {qi(c)}" for c in cols)
    else:
        q = ", ".join(f"avg({qi(c)}) AS {qi('a_' + c)}, stddev_pop({qi(c)}) AS {qi('b_' + c)}" for c in cols)
        w = ", ".join(f"CASE WHEN abs({qi(c)} - {qi('a_' + c)}) > 1.5 * {qi('b_' + c)} THEN {qi('a_' + c)} ELSE {qi(c)} END AS {qi(c)}" for c in cols)
    p = ", ".join(f"greatest({qi(c)}, 0) AS {qi(c)}" for c in cols)
    z = ", ".join(r6(f"({qi(c)} - avg({qi(c)}) OVER ()) / CASE WHEN stddev_pop({qi(c)}) OVER () = 0 THEN 1 ELSE stddev_pop({qi(c)}) OVER () END", c)
                  for c in cols)
    return (f"WITH f AS MATERIALIZED (SELECT product_id, {f} FROM ({_thirds_sql()})), q AS (SELECT {q} FROM f), "
            f"w AS (SELECT product_id, {w} FROM f, q), p AS (SELECT product_id, {p} FROM w) SELECT product_id, {z} FROM p")


def _d15(spark, sf_dir, kind: str) -> DataFrame:
    cfg = D.PrepConfig(usable_columns=tuple(THIRDS), outlier_method=kind, outlier_threshold=1.5)
    return D.FeaturePrep(cfg, passthrough=["product_id"]).fit_transform(_thirds(spark, sf_dir))[1]


@register("d15_iqr_null", _d15_sql("iqr"))
def d15_iqr_null(spark, sf_dir):
    """D15 with IQR treatment: quartiles of the imputed columns."""
    return _d15(spark, sf_dir, "iqr")


@register("d15_zscore_null", _d15_sql("zscore"))
def d15_zscore_null(spark, sf_dir):
    """D15 with z-scores of the imputed columns."""
    return _d15(spark, sf_dir, "zscore")


# --------------------------------------------------------------------- splits

_L = f"CASE WHEN product_id % 3 = 0 THEN NULL ELSE ({qi(TARGET)} > 0)::INTEGER END"


@register("f3_null_label", f"SELECT product_id, label, ((row_number() OVER (PARTITION BY label ORDER BY {_hash()}, product_id) - 1) % 5)::INTEGER AS fold "
          f"FROM (SELECT product_id, {_L} AS label FROM ({dm_sql()}))")
def f3_null_label(spark, sf_dir):
    """rows without a label are dealt to folds as a class of their own."""
    y = F.when(F.col("product_id") % 3 != 0, (F.col(TARGET) > 0).cast("int"))
    return SP.stratified_folds(B.dm(spark, sf_dir).select("product_id", y.alias("label")), "product_id", "label", 5)


@register("f5_tuning_sample", f"SELECT product_id FROM (SELECT product_id, row_number() OVER (ORDER BY {_hash()}, product_id) AS r FROM ({dm_sql()})) WHERE r <= 500")
def f5_tuning_sample(spark, sf_dir):
    """The 500 rows of smallest key hash (a documented tuning bound)."""
    return SP.tuning_sample(B.dm(spark, sf_dir).select("product_id"), "product_id", 500)


# ----------------------------------------------------------- profile and runs

def _k3_sql(part: str) -> str:
    cols = [m.replace("-", "") for m in RAW_MONTHS]
    src = "SELECT " + ", ".join(f"{qi(m)} AS {qi(c)}" for m, c in zip(RAW_MONTHS, cols)) + f" FROM ({dm_pair_sql()})"
    pieces = []
    for c in cols:
        v = qi(c)
        if part == "statistics":
            pieces.append(f"SELECT '{c}' AS column_name, {r6(f'avg({v})', 'mean')}, {r6(f'stddev_samp({v})', 'std_dev')}, {r6(f'min({v})', 'min')}, "
                          f"{r6(f'quantile_cont({v}, 0.25)', 'q1')}, {r6(f'quantile_cont({v}, 0.5)', 'median')}, {r6(f'quantile_cont({v}, 0.75)', 'q3')}, "
                          f"{r6(f'max({v})', 'max')}, {r6(f'quantile_cont({v}, 0.75) - quantile_cont({v}, 0.25)', 'iqr')} FROM d")
        else:
            pieces.append(f"SELECT '{c}' AS column_name, {r6('a', 'q1')}, {r6('m', 'median')}, {r6('b', 'q3')}, {r6('a - 1.5 * (b - a)', 'lower_bound')}, "
                          f"{r6('b + 1.5 * (b - a)', 'upper_bound')} FROM (SELECT quantile_cont({v}, 0.25) AS a, quantile_cont({v}, 0.5) AS m, "
                          f"quantile_cont({v}, 0.75) AS b FROM d)")
    return f"WITH d AS MATERIALIZED ({src}) " + " UNION ALL ".join(pieces)


@register("k3_profile_statistics", _k3_sql("statistics"))
def k3_profile_statistics(spark, sf_dir):
    """K3's statistics table (without the two moments E6 checks)."""
    return run_profile(B.dm_pair(spark, sf_dir), RAW_MONTHS)["statistics"].drop("skewness", "kurtosis")


@register("k3_profile_quartiles", _k3_sql("quartiles"))
def k3_profile_quartiles(spark, sf_dir):
    """K3's quartile lines."""
    return run_profile(B.dm_pair(spark, sf_dir), RAW_MONTHS)["quartiles"]


@register("e14_profile_missing", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {qi(c)} IS NULL)::BIGINT AS missing, "
    f"{r6(f'count(*) FILTER (WHERE {qi(c)} IS NULL) * 100.0 / count(*)', 'missing_pct')} FROM ({dm_sql(fill=False)})" for c in ["product_id", *M3]))
def e14_profile_missing(spark, sf_dir):
    """E14's missing table, out of the bundle."""
    d = B.dm_null(spark, sf_dir).select("product_id", *M3)
    return E.profile(d)["missing"].select("column_name", "missing", "missing_pct")


_LB = (f"SELECT model, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse, 1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)) AS r2 "
       f"FROM ({preds_sql()}) GROUP BY model")


@register("a8_export_content", f"SELECT model, {r6('mae', 'mae')}, {r6('rmse', 'rmse')}, {r6('r2', 'r2')} FROM ({_LB})")
def a8_export_content(spark, sf_dir):
    """The leaderboard exported under its time stamp and read back."""
    path = A.export_results(H.evaluate(B.preds(spark, sf_dir)), work_dir(spark, "a8") + "/leaderboard")
    back = spark.read.option("header", "true").csv(path)
    return back.select("model", *[F.col(c).cast("double").alias(c) for c in ("mae", "rmse", "r2")])


# -------------------------------------------- models that SQL can follow: OLS

_F1 = FEATURES[-1]
_TRAIN = f"SELECT product_id, {qi(_F1)} AS x, {qi(TARGET)} AS y, {_hash()} AS u FROM ({dm_sql()})"
# folds by a seed of their own: with the split's, the training rows would fill three folds of five
_FOLDS = f"SELECT *, least(floor({_hash().replace(':42', ':43')} * 5), 4)::INTEGER AS fold FROM ({_TRAIN}) WHERE u < 0.6"
_FITS = ("SELECT f.fold AS f, regr_slope(t.y, t.x) AS s, regr_intercept(t.y, t.x) AS i FROM (SELECT DISTINCT fold FROM t) f "
         "JOIN t ON t.fold <> f.fold GROUP BY f.fold")


def _folded(spark, sf_dir) -> DataFrame:
    d = SP.split_data(B.dm(spark, sf_dir), "product_id").withColumnRenamed(TARGET, "label").where("split = 'train'")
    return SP.hash_folds(d.select("product_id", "label", _F1), "product_id", 5, seed=43)


@register("h9_cross_val_predict_one", f"WITH t AS MATERIALIZED ({_FOLDS}), m AS ({_FITS}) SELECT product_id, fold, {r6('y', 'label', 4)}, "
          f"{r6('i + s * x', 'prediction', 4)} FROM t JOIN m ON m.f = t.fold", digits=4)
def h9_cross_val_predict_one(spark, sf_dir):
    """H9 with one feature: each fold's line is regr_slope and regr_intercept of the others."""
    return CV.cross_val_predict(LinearOLS(), _folded(spark, sf_dir).cache(), [_F1], "fold", k=5).select("product_id", "fold", "label", "prediction")


_SCORES = (f"WITH t AS MATERIALIZED ({_FOLDS}), m AS ({_FITS}), p AS (SELECT m.f AS fold, CASE WHEN t.fold = m.f THEN 'test' ELSE 'train' END AS part, "
           "t.y, t.y - (m.i + m.s * t.x) AS e FROM t, m), "
           "g AS (SELECT fold, part, 1 - avg(e * e) / var_pop(y) AS r2, -avg(e * e) AS mse, -avg(abs(e)) AS mae FROM p GROUP BY fold, part), "
           "w AS (SELECT a.fold, a.r2 AS r2, a.mse AS mse, a.mae AS mae, b.r2 AS r2b, b.mse AS mseb, b.mae AS maeb FROM g a JOIN g b ON a.fold = b.fold "
           "AND a.part = 'test' AND b.part = 'train') ")
_SIX = (f"{r6('r2', 'test_r2', 4)}, {r6('mse', 'test_neg_mean_squared_error', 4)}, {r6('mae', 'test_neg_mean_absolute_error', 4)}, "
        f"{r6('r2b', 'train_r2', 4)}, {r6('mseb', 'train_neg_mean_squared_error', 4)}, {r6('maeb', 'train_neg_mean_absolute_error', 4)}")


def _cv(spark, sf_dir) -> DataFrame:
    return CV.cross_validate(LinearOLS(), _folded(spark, sf_dir).cache(), [_F1], "fold", 5, name="ols")


@register("h10_cross_validate_one", _SCORES + f"SELECT fold, 'ols' AS model, {_SIX} FROM w", digits=4)
def h10_cross_validate_one(spark, sf_dir):
    """H10 with one feature (the times left out)."""
    return _cv(spark, sf_dir).drop("fit_time", "score_time")


@register("h11_cv_scores_one", _SCORES + f"SELECT 'ols' AS model, {r6('avg(mae)', 'mean', 4)}, {r6('stddev_pop(mae)', 'std', 4)} FROM w", digits=4)
def h11_cv_scores_one(spark, sf_dir):
    return CV.cv_scores(_cv(spark, sf_dir)).select("model", "mean", "std")


@register("h12_compare_cv_one", _SCORES + f"SELECT 'ols' AS model, {r6('avg(mae)', 'mean', 4)}, {r6('stddev_pop(mae)', 'std', 4)}, "
          f"{r6('min(mae)', 'min', 4)}, {r6('max(mae)', 'max', 4)} FROM w", digits=4)
def h12_compare_cv_one(spark, sf_dir):
    return CV.compare_cv(_cv(spark, sf_dir))


@register("h13_cv_folds_one", _SCORES + f"SELECT 'ols' AS model, fold, {_SIX} FROM w", digits=4)
def h13_cv_folds_one(spark, sf_dir):
    return CV.cv_folds_table(_cv(spark, sf_dir))


def _stump_sql(rows: str, n: str) -> str:
    """The best cut of ``rows`` (x, r, u) on their training part, as one row (t, l, h): where, and the means on both sides."""
    return (f"{n}v AS (SELECT x, count(*) AS n, sum(r) AS s FROM {rows} WHERE u < 0.6 GROUP BY x), "
            f"{n}c AS (SELECT x, lead(x) OVER (ORDER BY x) AS above, sum(n) OVER (ORDER BY x) AS nl, sum(s) OVER (ORDER BY x) AS sl, "
            f"sum(n) OVER () AS n, sum(s) OVER () AS s FROM {n}v), "
            f"{n} AS MATERIALIZED (SELECT (x + above) / 2 AS t, sl / nl AS l, (s - sl) / (n - nl) AS h FROM {n}c WHERE above IS NOT NULL "
            f"ORDER BY round(nl * (n - nl) / n * pow(sl / nl - (s - sl) / (n - nl), 2), 6) DESC, x LIMIT 1)")


@register("g5_boosted_stumps_one", f"WITH t AS MATERIALIZED ({_TRAIN}), a AS MATERIALIZED (SELECT product_id, x, y, u, (SELECT avg(y) FROM t WHERE u < 0.6) AS f, "
          "y - (SELECT avg(y) FROM t WHERE u < 0.6) AS r FROM t), " + _stump_sql("a", "p")
          + ", b AS MATERIALIZED (SELECT product_id, x, y, u, f + 0.5 * CASE WHEN x <= p.t THEN p.l ELSE p.h END AS f, "
          "r - 0.5 * CASE WHEN x <= p.t THEN p.l ELSE p.h END AS r FROM a, p), " + _stump_sql("b", "q")
          + f" SELECT product_id, {r6('y', 'y', 4)}, {r6('f + 0.5 * CASE WHEN x <= q.t THEN q.l ELSE q.h END', 'p', 4)} FROM b, q", digits=4)
def g5_boosted_stumps_one(spark, sf_dir):
    """G5 with one feature, two rounds of one cut each at rate 0.5: the start
    is the mean, the second cut is that of the residuals; every row of DM."""
    d = SP.split_data(B.dm(spark, sf_dir), "product_id").withColumnRenamed(TARGET, "label")
    m = CV.get_spec("gradient_boosting", n_estimators=2, max_depth=1, learning_rate=0.5).fit(d.where("split = 'train'"), [_F1])
    return m.transform(d).select("product_id", F.col("label").alias("y"), F.col("prediction").alias("p"))


@register("g8_voting_of_unlike_models", f"WITH t AS MATERIALIZED ({_TRAIN}), c AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM t WHERE u < 0.6), "
          "a AS MATERIALIZED (SELECT *, y - (SELECT avg(y) FROM t WHERE u < 0.6) AS r FROM t), " + _stump_sql("a", "p")
          + f" SELECT product_id, {r6('y', 'y', 4)}, {r6('((i + s * x) + (SELECT avg(y) FROM t WHERE u < 0.6) + CASE WHEN x <= p.t THEN p.l ELSE p.h END) / 2', 'p', 4)} "
          "FROM a, c, p", digits=4)
def g8_voting_of_unlike_models(spark, sf_dir):
    """The mean of a least-squares line and a boosted cut of one feature, on every row of DM."""
    d = SP.split_data(B.dm(spark, sf_dir), "product_id").withColumnRenamed(TARGET, "label")
    bases = [("line", LinearOLS()), ("cut", CV.get_spec("gradient_boosting", n_estimators=1, max_depth=1, learning_rate=1.0))]
    m = CV.get_spec("voting_regressor", bases=bases).fit(d.where("split = 'train'"), [_F1])
    return m.transform(d).select("product_id", F.col("label").alias("y"), F.col("prediction").alias("p"))


# ------------------------------------------------------------------ K2 at length

_K2 = (f"SELECT codigo_almacen, codigo_producto, x, y, {_hash("codigo_almacen || '|' || codigo_producto")} AS u FROM (SELECT DISTINCT codigo_almacen, codigo_producto, "
       f"{qi(RAW_MONTHS[-2])} AS x, greatest({qi(RAW_MONTHS[-1])}, 0) AS y FROM ({dm_pair_sql()}))")


def _k2(spark, sf_dir):
    """A whole run on DM_PAIR with the one model whose result SQL can state:
    the least-squares line of the target month on the month before."""
    cfg = RunConfig(models=("logistic_regression",), prep=D.PrepConfig(usable_columns=(RAW_MONTHS[-2],)))
    pair = B.dm_pair(spark, sf_dir).select("codigo_almacen", "codigo_producto", *[F.col(f"`{m}`") for m in RAW_MONTHS[-2:]])
    return run_training(pair, RAW_MONTHS[-1], ["codigo_almacen", "codigo_producto"], cfg)


def _k2_metrics(split: str) -> str:
    return (f"WITH t AS MATERIALIZED ({_K2}), c AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM t WHERE u < 0.6), "
            f"e AS (SELECT y, i + s * x AS p FROM t, c WHERE {split}) SELECT 'logistic_regression' AS model, {r6('avg(abs(y - p))', 'mae', 4)}, "
            f"{r6('sqrt(avg((y - p) * (y - p)))', 'rmse', 4)}, {r6('1 - avg((y - p) * (y - p)) / var_pop(y)', 'r2', 4)} FROM e")


@register("k2_saved_leaderboard", _k2_metrics("u >= 0.6 AND u < 0.8"), digits=4)
def k2_saved_leaderboard(spark, sf_dir):
    """K2: the validation leaderboard as the run wrote it."""
    run = _k2(spark, sf_dir)
    folder = next(r["folder"] for r in run.stages if r["stage"] == "select")
    return A.load_data(spark, f"{folder}/leaderboard.csv", "model string, mae double, rmse double, r2 double")


@register("k2_saved_evaluation", _k2_metrics("u >= 0.8"), digits=4)
def k2_saved_evaluation(spark, sf_dir):
    """K2: the test metrics in the evaluation document that the run wrote."""
    run = _k2(spark, sf_dir)
    folder = next(r["folder"] for r in run.stages if r["stage"] == "test")
    one = A.read_json(spark, f"{folder}/evaluation.json", f"{run.best_model} struct<mae: double, rmse: double, r2: double>", True)
    return one.select(F.lit(run.best_model).alias("model"), F.col(f"{run.best_model}.*"))


@register("k2_saved_profile", "SELECT 'missing' AS section, column_name, key, value FROM (SELECT column_name, count(*) - count(value) AS missing FROM ("
          + long_sql(f"({dm_pair_sql()})", ["codigo_almacen", "codigo_producto", *RAW_MONTHS[-2:]]) + ") GROUP BY column_name) "
          "UNPIVOT (value FOR key IN (missing))")
def k2_saved_profile(spark, sf_dir):
    """K2: the missing counts of the profile that the run wrote."""
    run = _k2(spark, sf_dir)
    return run.profile.where("section = 'missing' and key = 'missing'").select("section", "column_name", F.lit("missing").alias("key"), F.col("value").cast("long").alias("value"))


@register("k2_winner_scores", f"WITH t AS MATERIALIZED ({_K2}), c AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM t WHERE u < 0.6) "
          f"SELECT codigo_almacen, codigo_producto, {r6('x', RAW_MONTHS[-2], 4)}, {r6('i + s * x', 'prediction_' + RAW_MONTHS[-1], 4)} FROM t, c", digits=4)
def k2_winner_scores(spark, sf_dir):
    """K2 -> J1: all rows of DM_PAIR scored by the bundle that the run wrote."""
    rows = B.dm_pair(spark, sf_dir).select("codigo_almacen", "codigo_producto", F.col(f"`{RAW_MONTHS[-2]}`"))
    return winner(spark, _k2(spark, sf_dir)).score(rows)


@register("j1_batch_scoring_one", f"WITH t AS MATERIALIZED ({_TRAIN}), c AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM t WHERE u < 0.6) "
          f"SELECT product_id, {r6('x', _F1, 4)}, {r6('i + s * x', 'prediction_' + TARGET, 4)} FROM t, c", digits=4)
def j1_batch_scoring_one(spark, sf_dir):
    """J1/J4 with one feature: prepared (scaled), fitted, saved, loaded, and
    every row of DM scored: scaling does not change a least-squares line."""
    bundle, rows = _one_feature_bundle(spark, sf_dir)
    return bundle.score(rows)


def _one_feature_bundle(spark, sf_dir):
    d = SP.split_data(B.dm(spark, sf_dir), "product_id").withColumnRenamed(TARGET, "label")
    prep = D.FeaturePrep(D.PrepConfig(usable_columns=(_F1,), stats_from="train"), passthrough=["product_id", "label"])
    pm, prepared = prep.fit_transform(d.where("split = 'train'").select("product_id", "label", _F1))
    path = work_dir(spark, "bundle")
    Bundle(pm, LinearOLS().fit(prepared, pm.features), "logistic_regression", [_F1], TARGET).save(spark, path)
    return Bundle.load(spark, path), d.select("product_id", _F1)


def _dropped_files(spark, sf_dir):
    """All rows of DM as uploads: in order, in another order with a column
    more, without the feature, with a word among the numbers; scored by a stream."""
    bundle, rows = _one_feature_bundle(spark, sf_dir)
    base = work_dir(spark, "j2")
    kind = F.col("product_id") % 5
    uploads = [rows.where(kind < 2), rows.where(kind == 2).select(_F1, F.lit("x").alias("note"), "product_id"),
               rows.where(kind == 3).select("product_id"),
               rows.where(kind == 4).select("product_id", F.when(F.col("product_id") % 10 == 4, F.lit("many")).otherwise(F.col(_F1).cast("string")).alias(_F1))]
    for upload in uploads:
        upload.coalesce(1).write.mode("append").option("header", "true").csv(f"{base}/in")
    score_stream(spark, bundle, f"{base}/in", f"{base}/out", checkpoint=f"{base}/ckpt", schema=rows.schema).awaitTermination()
    return f"{base}/out"


@register("j2_scored_by_name", f"WITH t AS MATERIALIZED ({_TRAIN}), c AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM t WHERE u < 0.6) "
          f"SELECT product_id, {r6('x', _F1, 4)}, {r6('i + s * x', 'prediction_' + TARGET, 4)} FROM t, c WHERE product_id % 5 < 3", digits=4)
def j2_scored_by_name(spark, sf_dir):
    """The rows of the accepted uploads, each read by its own header."""
    return scored(spark, _dropped_files(spark, sf_dir))


@register("j2_rejected_files", f"SELECT accepted, reason, sum(n)::BIGINT AS n_rows FROM (SELECT count(*) AS n, product_id % 5 < 3 AS accepted, CASE product_id % 5 "
          f"WHEN 3 THEN 'Missing columns: {_F1}' WHEN 4 THEN 'Unreadable values in ' || (SELECT count(*) FROM ({dm_sql()}) WHERE product_id % 10 = 4) || ' rows' END AS reason "
          f"FROM ({dm_sql()}) WHERE product_id % 5 <> 3 GROUP BY ALL UNION ALL SELECT 0, false, 'Missing columns: {_F1}') GROUP BY ALL")
def j2_rejected_files(spark, sf_dir):
    """What became of the uploads; rows are counted where a file could be read."""
    return accounts(spark, _dropped_files(spark, sf_dir)).groupBy("accepted", "reason").agg(F.sum("n_rows").alias("n_rows"))


@register("a1_read_csv_by_name", f"SELECT product_id, {', '.join(r6(qi(c), c) for c in MONTHS)} FROM ({dm_sql()})")
def a1_read_csv_by_name(spark, sf_dir):
    """A1: columns in reverse order and one more than the schema names."""
    path = work_dir(spark, "a1") + "/reversed.csv"
    d = B.dm(spark, sf_dir)
    d.select(F.lit("x").alias("note"), *reversed(d.columns)).write.option("header", "true").csv(path)
    return A.load_data(spark, path, d.schema)


@register("g8_voting_of_lines", f"WITH t AS MATERIALIZED (SELECT product_id, {qi(FEATURES[-1])} AS a, {qi(FEATURES[-2])} AS b, {qi(TARGET)} AS y, {_hash()} AS u "
          f"FROM ({dm_sql()})), m AS (SELECT regr_slope(y, a) AS s, regr_intercept(y, a) AS i FROM t WHERE u < 0.6) "
          f"SELECT product_id, {r6('i + s * a', 'p', 4)} FROM t, m", digits=4)
def g8_voting_of_lines(spark, sf_dir):
    """The vote of two equal lines is that line."""
    d = SP.split_data(B.dm(spark, sf_dir), "product_id").withColumnRenamed(TARGET, "label")
    m = CV.get_spec("voting_regressor", bases=[("one", LinearOLS()), ("two", LinearOLS())]).fit(d.where("split = 'train'").cache(), [_F1])
    return m.transform(d).select("product_id", F.col("prediction").alias("p"))

