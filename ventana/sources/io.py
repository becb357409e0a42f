"""A1-A8 -- file sources and sinks.

Readers go through ``spark.read`` so Parquet keeps its vectorised reader,
predicate pushdown and column pruning; CSV/JSON take an explicit schema when
one is given (inference is a full extra pass over the input). Every floating
column has NaN turned into NULL once, at load: pandas treats NaN as missing,
Spark does not (``NaN > 1`` is true and NaN poisons ``avg``/``max``).
"""

from __future__ import annotations

import datetime as _dt
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ventana.functions.exprs import col, nan_as_null

FORMATS = {".csv": "csv", ".json": "json", ".parquet": "parquet", ".pq": "parquet"}


def file_format(path: str) -> str:
    """A4: format from the extension; unknown -> ValueError like the source."""
    p = path.rstrip("/")
    ext = os.path.splitext(p)[1].lower()
    if ext not in FORMATS:
        raise ValueError(f"Unsupported file format: {ext or p}")
    return FORMATS[ext]


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A1: header row; types from ``schema``, else inferred (one extra pass).

    The header says which column is where, whatever the schema's order; further
    columns of the file are not read, a missing one raises. The files of a
    folder must share one header: Spark checks each file's against the first's
    and fails where they differ (``streaming.filedrop`` takes files one by one).
    """
    r = spark.read.option("header", "true")
    if schema is None:
        return nan_as_null(r.option("inferSchema", "true").csv(path))
    want = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    header = r.csv(path).columns  # one line of the first file
    if not header:
        return spark.createDataFrame([], want)
    missing = [c for c in want.names if c not in header]
    if missing:
        raise ValueError(f"Missing columns: {', '.join(missing)}")
    placed = T.StructType([T.StructField(c, want[c].dataType if c in want.names else T.StringType(), True) for c in header])
    return nan_as_null(r.schema(placed).option("enforceSchema", "false").csv(path).select(*[col(c) for c in want.names]))


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
              multi_line: bool | None = None) -> DataFrame:
    """A2: JSON records. One JSON array per file (pandas ``orient='records'``)
    needs ``multiLine``; JSON Lines does not. ``None`` sniffs the first byte."""
    if multi_line is None:
        multi_line = _starts_with_array(spark, path)
    r = spark.read.option("multiLine", "true" if multi_line else "false")
    if schema is not None:
        r = r.schema(schema)
    return nan_as_null(r.json(path))


def _starts_with_array(spark: SparkSession, path: str) -> bool:
    head = spark.read.text(path, wholetext=False).limit(1).collect()
    return bool(head) and head[0][0].lstrip().startswith("[")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A3: typed columnar read with pushdown."""
    return nan_as_null(spark.read.parquet(path))


def load_data(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A1-A4 ``load_data``: dispatch on the extension."""
    fmt = file_format(path)
    if fmt == "csv":
        return read_csv(spark, path, schema)
    if fmt == "json":
        return read_json(spark, path, schema)
    return read_parquet(spark, path)


def save_data(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> str:
    """A6 ``save_data``: CSV with header (no index), JSON records, Parquet.
    The source silently writes nothing for an unknown format; we raise."""
    fmt = fmt.lower().lstrip(".")
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", "true").csv(path)
    elif fmt == "json":
        w.json(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"Unsupported file format: {fmt}")
    return path


def save_small_table(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """One file for result tables whose size is bounded by the number of
    models or columns (never row-level data): ``coalesce(1)`` is safe here."""
    return save_data(df.coalesce(1), path, fmt)


def save_metrics_json(metrics: dict, path: str) -> str:
    """Evaluation dictionary -> one JSON document (one entry per model),
    written through the Hadoop file system, so to any storage Spark can reach."""
    spark = SparkSession.getActiveSession()
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(json.dumps(metrics, indent=2, default=float).encode()))
    finally:
        out.close()
    return path


def export_results(df: DataFrame, prefix: str, now: _dt.datetime | None = None, fmt: str = "csv") -> str:
    """A8 ``export_results_to_csv``: ``{prefix}_{yyyyMMdd_HHmmss}``; returns the path."""
    stamp = (now or _dt.datetime.now()).strftime("%Y%m%d_%H%M%S")
    path = f"{prefix}_{stamp}.{fmt}"
    return save_small_table(df, path, fmt)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through the Hadoop FileSystem, so it works for any scheme."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


class DatasetCatalog:
    """A5: named datasets -> paths; a missing file raises FileNotFoundError."""

    def __init__(self, paths: dict[str, str] | None = None):
        self.paths = dict(paths or {})

    def register(self, name: str, path: str) -> None:
        self.paths[name] = path

    def load(self, spark: SparkSession, name: str, schema=None) -> DataFrame:
        if name not in self.paths:
            raise FileNotFoundError(f"Dataset not configured: {name}")
        path = self.paths[name]
        if not path_exists(spark, path):
            raise FileNotFoundError(f"Dataset file not found: {path}")
        return load_data(spark, path, schema)


