"""Reusable JVM-side column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_numeric(dt: T.DataType) -> bool:
    """Numbers count as numeric; booleans do not (pandas ``number`` rule)."""
    return isinstance(dt, T.NumericType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in ex]


def q(name: str) -> str:
    """Backtick-quote a column name for use in SQL expression strings."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(q(name))


def nan_to_null(c: Column) -> Column:
    """pandas treats NaN as missing; Spark does not. Normalise once."""
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def nan_as_null(df: DataFrame) -> DataFrame:
    """NaN -> NULL on float/double columns; other columns untouched (no-op
    projection when there are none, so the scan keeps its pushdown)."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not fl:
        return df
    return df.select(*[nan_to_null(col(c)).alias(c) if c in fl else col(c) for c in df.columns])


def uniform_hash(key: Column, seed: int = 42) -> Column:
    """Deterministic u in [0, 1) from md5(key:seed): stable under any
    repartitioning and reproducible in plain SQL."""
    h = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def row_mean_skip_nulls(cols: list[Column]) -> Column:
    """Row mean of several columns, nulls skipped, NULL when all are null."""
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cols])
    n = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cols])
    return F.try_divide(total, n.cast("double"))


def round_all(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (used for stable result tables)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(col(f.name), digits).alias(f.name))
        else:
            out.append(col(f.name))
    return df.select(*out)
