"""Bindings of the driver tables to the source pipeline's input shape.

The source pipeline receives a ready-made wide table (one row per warehouse and
product, one column per month). Here it is derived from ``lineitem`` by
Spark, so every binding grows with the data it is computed from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventana.operators.reshape import demand_matrix, month_names

# The 21-month window (20 features + 1 target), mirroring the
# source workbook's 2024-1 ... 2025-9 on the driver data's calendar.
WINDOW_START = (2000, 1)
WINDOW_MONTHS = 21
MONTHS = month_names(WINDOW_START, WINDOW_MONTHS)            # m2000_01 ... m2001_09
RAW_MONTHS = month_names(WINDOW_START, WINDOW_MONTHS, "raw")  # 2000-1 ... 2001-9
FEATURES = MONTHS[:-1]
TARGET = MONTHS[-1]
RAW_FEATURES = RAW_MONTHS[:-1]
RAW_TARGET = RAW_MONTHS[-1]

# warehouse/product attribute names of the source workbook.
PAIR_ATTRIBUTES = ["codigo_almacen", "almacen", "codigo_producto", "descripcion_producto",
                   "tipo_producto", "descripcion_padre", "valor_promedio"]

# The naive predictors used as models for evaluation ops.
PRED_MODELS = ["last_month", "mean_last_3", "feature_mean"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lineitem(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity",
                                                   "l_returnflag", "l_shipdate")


def dm(spark: SparkSession, sf_dir: str, fill: float | None = 0.0) -> DataFrame:
    """DM: product_id + 21 months of sum(l_quantity), 0 when none."""
    li = _lineitem(spark, sf_dir)
    return demand_matrix(li, [F.col("l_partkey").alias("product_id")], "l_shipdate",
                         "l_quantity", WINDOW_START, WINDOW_MONTHS, fill=fill)


def dm_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DM_NULL: as DM, NULL when a month has no sales."""
    return dm(spark, sf_dir, fill=None)


def dm_signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DM_SIGNED: returned lines (l_returnflag = 'R') subtract."""
    li = _lineitem(spark, sf_dir)
    signed = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    return demand_matrix(li, [F.col("l_partkey").alias("product_id")], "l_shipdate",
                         signed, WINDOW_START, WINDOW_MONTHS, fill=0.0)


def dm_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DM_PAIR: one row per (supplier, part) with sales in the window, the
    workbook's attribute columns and raw month names (``2000-1`` ...).

    The month aggregate runs before the joins, so the joins see one row per
    pair; the dimension sides are broadcast only if AQE measures them under
    ``spark.sql.autoBroadcastJoinThreshold``.
    """
    li = _lineitem(spark, sf_dir)
    pairs = demand_matrix(li, [F.col("l_suppkey").alias("codigo_almacen"),
                               F.col("l_partkey").alias("codigo_producto")],
                          "l_shipdate", "l_quantity", WINDOW_START, WINDOW_MONTHS,
                          fill=0.0, style="raw", window_only=True)
    sup = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("codigo_almacen"),
                                                  F.col("s_name").alias("almacen"))
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("codigo_producto"),
        F.col("p_name").alias("descripcion_producto"),
        F.col("p_type").alias("tipo_producto"),
        F.col("p_brand").alias("descripcion_padre"),
        F.col("p_retailprice").alias("valor_promedio"))
    out = pairs.join(sup, "codigo_almacen", "left").join(part, "codigo_producto", "left")
    return out.select(*PAIR_ATTRIBUTES, *[F.col(f"`{m}`") for m in RAW_MONTHS])


def dupes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DUPES: three low-cardinality order attributes (many repeated rows)."""
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PREDS: long (product_id, model, y, p) for three naive predictors of
    the target month, produced from one scan of DM by ``stack``."""
    d = dm(spark, sf_dir)
    last3 = (F.col(FEATURES[-1]) + F.col(FEATURES[-2]) + F.col(FEATURES[-3])) / 3.0
    allm = sum(F.col(c) for c in FEATURES) / float(len(FEATURES))
    wide = d.select("product_id", F.col(TARGET).alias("y"),
                    F.col(FEATURES[-1]).alias("p0"), last3.alias("p1"), allm.alias("p2"))
    stacked = ", ".join(f"'{m}', p{i}" for i, m in enumerate(PRED_MODELS))
    return wide.selectExpr("product_id", f"stack({len(PRED_MODELS)}, {stacked}) as (model, p)", "y") \
               .select("product_id", "model", "y", "p")
