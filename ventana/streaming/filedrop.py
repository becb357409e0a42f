"""J2 -- files dropped into a folder are checked, scored by column name and accounted for.

Every micro-batch takes the files that are new (at most ``max_files``, the
bound of everything that comes to the driver: paths, headers, row counts).
Each file stands for itself, as an upload does:

* its own header (CSV) or footer (Parquet) says which column is where, so
  files of one folder may order their columns differently and hold more of them;
* a file that lacks a column, repeats one, or holds a cell that is no number
  where one is needed is rejected whole and listed with the reason;
* files of one layout are read and scored together.

A batch writes the scored rows and the account of its files under
``batch_id=<n>`` and overwrites what an earlier attempt at the same batch left
there; Structured Streaming's checkpoint gives a file to one batch only. So a
query that dies anywhere and is started again leaves every row once.
"""

from __future__ import annotations

import csv
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ventana.functions.exprs import col, is_numeric, nan_as_null
from ventana.operators.schema import validate_columns
from ventana.session import work_dir

FILE, UNREADABLE = "_file", "_unreadable"
ACCOUNT = "file string, header string, accepted boolean, reason string, n_rows bigint"

Layout = tuple[str, ...]


def first_lines(batch: DataFrame) -> dict[str, str]:
    """file -> first line, of a batch of text rows with their place."""
    opening = batch.where("block = 0").withColumn("at", F.monotonically_increasing_id())
    return {r[FILE]: r.line for r in opening.groupBy(FILE).agg(F.min_by("value", "at").alias("line")).collect()}


def layout_of(header: str) -> Layout:
    return tuple(next(csv.reader([header.lstrip("﻿")]), []))


def objection(layout: Layout, schema: T.StructType) -> str | None:
    """Why a file of these columns cannot be scored; None if it can."""
    missing = [c for c in schema.names if c not in layout]
    if missing:
        return f"Missing columns: {', '.join(missing)}"
    twice = [c for c in schema.names if layout.count(c) > 1]
    return f"Repeated columns: {', '.join(twice)}" if twice else None


def read_layout(spark: SparkSession, files: list[str], layout: Layout, schema: T.StructType) -> DataFrame:
    """The schema's columns by name, FILE, and UNREADABLE: whether a cell that holds something does not parse."""
    raw = (spark.read.schema(T.StructType([T.StructField(f"_{i}", T.StringType(), True) for i in range(len(layout))]))
           .option("header", "true").csv(files).withColumn(FILE, F.col("_metadata.file_path")))
    cells = {c: F.nullif(F.trim(F.col(f"_{layout.index(c)}")), F.lit("")) for c in schema.names}
    values = {c: cells[c].try_cast(schema[c].dataType) for c in schema.names}
    unreadable = F.lit(False)
    for c in schema.names:
        unreadable = unreadable | (cells[c].isNotNull() & values[c].isNull())
    return raw.select(*[values[c].alias(c) for c in schema.names], FILE, unreadable.alias(UNREADABLE))


def read_footers(spark: SparkSession, files: list[str], schema: T.StructType) -> tuple[dict[str, str], dict[str, str]]:
    """Parquet: (file -> its columns as a line, file -> objection); numeric columns may be of any numeric type."""
    lines, against = {}, {}
    for f in files:
        own = spark.read.parquet(f).schema
        lines[f] = ",".join(own.names)
        why = objection(tuple(own.names), schema)
        odd = [c for c in schema.names if why is None and own[c].dataType != schema[c].dataType
               and not (is_numeric(own[c].dataType) and is_numeric(schema[c].dataType))]
        if why or odd:
            against[f] = why or f"Columns of another type: {', '.join(odd)}"
    return lines, against


def score_files(spark: SparkSession, files: list[str], lines: dict[str, str], against: dict[str, str], schema: T.StructType, fmt: str,
                score: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(scored rows of the accepted files, the account of all files)."""
    groups: dict[Layout, list[str]] = {}
    for f in files:
        if f not in against:
            groups.setdefault(layout_of(lines[f]) if fmt == "csv" else (), []).append(f)
    parts, counts = [], {}
    for layout, some in groups.items():
        if fmt == "csv":
            rows = read_layout(spark, some, layout, schema)
        else:
            rows = spark.read.parquet(some[0]) if len(some) == 1 else _aligned(spark, some, schema)
            rows = rows.select(*[col(c).cast(schema[c].dataType).alias(c) for c in schema.names], F.col("_metadata.file_path").alias(FILE)
                               if len(some) == 1 else F.col(FILE), F.lit(False).alias(UNREADABLE))
        found = rows.groupBy(FILE).agg(F.count(F.lit(1)).alias("n"), F.count_if(UNREADABLE).alias("bad")).collect()
        for r in found:
            counts[r[FILE]] = r.n
            if r.bad:
                against[r[FILE]] = f"Unreadable values in {r.bad} rows"
        good = [f for f in some if f not in against]
        if good:
            parts.append(rows.where(F.col(FILE).isin(good)).select(*schema.names) if len(good) < len(some) else rows.select(*schema.names))
    data = parts[0] if parts else spark.createDataFrame([], schema)
    for p in parts[1:]:
        data = data.unionByName(p)
    account = [(f, lines.get(f), f not in against, against.get(f), counts.get(f, 0)) for f in files]
    return score(nan_as_null(data)), spark.createDataFrame(account, ACCOUNT)


def _aligned(spark: SparkSession, files: list[str], schema: T.StructType) -> DataFrame:
    """Parquet files whose numeric columns may differ in type: each cast by itself."""
    parts = [spark.read.parquet(f).select(*[col(c).cast(schema[c].dataType).alias(c) for c in schema.names], F.col("_metadata.file_path").alias(FILE))
             for f in files]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def default_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.DoubleType(), True) for c in columns])


def score_stream(spark: SparkSession, bundle, in_dir: str, out_dir: str, fmt: str = "csv", checkpoint: str | None = None, schema=None,
                 available_now: bool = True, account_dir: str | None = None, max_files: int = 500):
    """Every new file in ``in_dir`` is checked, scored by column name and
    appended to ``out_dir`` (Parquet; read it with :func:`scored`); what became
    of each file is appended to ``account_dir`` (default ``<out_dir>.files``;
    read it with :func:`accounts`).

    ``schema`` names the columns a file must hold and their types; the default
    is the bundle's usable columns as doubles. Further columns of the schema (a
    row's key) are carried into the output, further columns of a file are not.
    A file without a single line is not seen; one with a header alone is
    accepted with no rows.
    """
    schema = default_schema(bundle.usable_columns) if schema is None else schema
    ok, why = validate_columns(spark.createDataFrame([], schema), bundle.usable_columns)
    if not ok:
        raise ValueError(why)
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"Unsupported file format: {fmt}")
    account_dir = account_dir or f"{out_dir.rstrip('/')}.files"
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    place = [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("block")]
    source = reader.text(in_dir).select("value", *place) if fmt == "csv" else reader.schema(schema).parquet(in_dir).select(*place)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        files = sorted(r[FILE] for r in batch.select(FILE).distinct().collect())
        if fmt == "csv":
            lines = first_lines(batch)
            against = {f: why for f in files if (why := objection(layout_of(lines[f]), schema))}
        else:
            lines, against = read_footers(session, files, schema)
        rows, account = score_files(session, files, lines, against, schema, fmt, bundle.score)
        rows.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")
        account.coalesce(1).write.mode("overwrite").parquet(f"{account_dir}/batch_id={batch_id}")

    w = source.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint or work_dir(spark, "stream-ckpt"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def scored(spark: SparkSession, out_dir: str) -> DataFrame:
    """The scored rows of all batches."""
    return spark.read.parquet(out_dir).drop("batch_id")


def accounts(spark: SparkSession, out_dir: str, account_dir: str | None = None) -> DataFrame:
    """``file, header, accepted, reason, n_rows, batch_id`` of every file met."""
    return spark.read.parquet(account_dir or f"{out_dir.rstrip('/')}.files")
