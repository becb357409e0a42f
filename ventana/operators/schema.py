"""B1-B9 -- schema operators and projections.

All of these are metadata-only (``toDF``/``select``/``drop``) except B6,
which is one column expression; none starts a job.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ventana.functions.exprs import col, is_numeric, nan_to_null, row_mean_skip_nulls

# The source workbook's attribute columns removed before training.
DEFAULT_CATEGORICAL = ["codigo_almacen", "almacen", "codigo_producto", "descripcion_producto", "cum",
                       "tipo_producto", "descripcion_padre", "valor_promedio", "valor_final"]

# What each form of a name leaves out, after lower-casing.
_LEFT_OUT = {"exact": re.compile(r"[^a-z0-9_]+"), "loose": re.compile(r"[\s_-]+")}


def normalize_name(name: str, form: str = "exact") -> str:
    """Lower-case, without what the form leaves out: ``exact`` keeps
    ``[a-z0-9_]`` (accented letters go, they are not transliterated);
    ``loose`` (B9's second try) drops white space, dashes and underscores."""
    return _LEFT_OUT[form].sub("", str(name).lower())


def loose_name(name: str) -> str:
    """B9's looser match."""
    return normalize_name(name, "loose")


def normalize_column_names(df: DataFrame) -> DataFrame:
    """B1: rename every column; two names that normalise alike raise."""
    new = [normalize_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"Columns {seen[n]!r} and {old!r} both normalise to {n!r}")
        seen[n] = old
    return df.toDF(*new)


def select_usable_columns(df: DataFrame, usable: list[str]) -> tuple[DataFrame, list[str]]:
    """B2: keep columns whose normalised name is listed, in the frame's
    order; when nothing matches, every column stays."""
    want = {normalize_name(u) for u in usable}
    kept = [c for c in df.columns if normalize_name(c) in want]
    if not kept:
        return df, []
    return df.select(*[col(c) for c in kept]), kept


def remove_categorical_columns(df: DataFrame, names: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Drop the listed attribute columns (normalised matching)."""
    drop = {normalize_name(n) for n in (names if names is not None else DEFAULT_CATEGORICAL)}
    removed = [c for c in df.columns if normalize_name(c) in drop]
    return df.select(*[col(c) for c in df.columns if c not in removed]), removed


def numeric_only(df: DataFrame, keep: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Drop every non-numeric column (``keep`` names survive regardless,
    e.g. the row key)."""
    keep = set(keep or [])
    fields = df.schema.fields
    dropped = [f.name for f in fields if not is_numeric(f.dataType) and f.name not in keep]
    return df.select(*[col(f.name) for f in fields if f.name not in dropped]), dropped


def prepare_target(df: DataFrame, target: str | list[str], label: str = "label") -> DataFrame:
    """One frame with the features and a ``label`` column. One target
    is renamed; several become their row mean with NULLs and NaNs skipped (NULL
    when all are missing) and are removed from the features."""
    targets = [target] if isinstance(target, str) else list(target)
    missing = [t for t in targets if t not in df.columns]
    if missing:
        raise ValueError(f"Target column(s) not found: {missing}")
    values = [nan_to_null(col(t).cast("double")) for t in targets]
    y = values[0] if len(values) == 1 else row_mean_skip_nulls(values)
    rest = [col(c) for c in df.columns if c not in targets]
    return df.select(*rest, y.alias(label))


def validate_columns(df: DataFrame, required: list[str]) -> tuple[bool, str]:
    """Exact-name check; lists what is missing."""
    have = set(df.columns)
    missing = [c for c in required if c not in have]
    if missing:
        return False, f"Missing columns: {', '.join(missing)}"
    return True, "All required columns present"


def build_template(spark: SparkSession, columns: list[str], dtype: T.DataType = T.DoubleType()) -> DataFrame:
    """Empty table with the expected columns."""
    schema = T.StructType([T.StructField(c, dtype, True) for c in columns])
    return spark.createDataFrame([], schema)


def analysis_columns_fallback(df: DataFrame, usable: list[str]) -> tuple[DataFrame, list[str]]:
    """The profile run's column choice -- loose name match against the
    usable list, else all numeric columns."""
    want = {loose_name(u) for u in usable}
    kept = [c for c in df.columns if loose_name(c) in want]
    if not kept:
        kept = [f.name for f in df.schema.fields if is_numeric(f.dataType)]
    return df.select(*[col(c) for c in kept]), kept


def literal_row_frame(spark: SparkSession, columns: list[str], values: dict | None = None) -> DataFrame:
    """J3 helper: one row, every column a double (default 0.0)."""
    values = values or {}
    row = [float(values.get(c, 0.0)) for c in columns]
    return spark.createDataFrame([row], T.StructType([T.StructField(c, T.DoubleType(), True) for c in columns]))


__all__ = ["DEFAULT_CATEGORICAL", "normalize_name", "normalize_column_names", "select_usable_columns",
           "remove_categorical_columns", "numeric_only", "prepare_target", "validate_columns",
           "build_template", "analysis_columns_fallback", "literal_row_frame"]
