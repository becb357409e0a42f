"""C1-C8 -- row cleaning before the split (the only place rows are dropped).

Plan shape of ``clean_rows``: the duplicate removal is a hash aggregate on
all columns that also counts each row's multiplicity, so duplicates collapse
map-side (a row repeated in a third of the input leaves each task once) and
the initial row count is the sum of multiplicities -- no second scan. Every
filter rule becomes one ``reason`` expression evaluated in the same codegen
stage; the cleaned frame keeps ``reason IS NULL`` and the statistics are one
``groupBy(reason)`` over the same deduplicated rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ventana.functions.exprs import col, nan_as_null, nan_to_null, numeric_columns
from ventana.operators.schema import normalize_column_names

REASON = "_reason"


def remove_duplicates(df: DataFrame) -> DataFrame:
    """Full-row distinct (NULLs compare equal, like pandas)."""
    return df.dropDuplicates()


def duplicate_stats(df: DataFrame) -> DataFrame:
    """C1 counters: rows before/after and the number removed, one aggregate."""
    g = df.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_mult"))
    return g.agg(F.sum("_mult").cast("long").alias("rows_initial"),
                 F.count(F.lit(1)).cast("long").alias("rows_final")) \
            .withColumn("duplicates_removed", F.col("rows_initial") - F.col("rows_final"))


def any_null(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Whether a cell of the row is NULL (or NaN, once :func:`nan_as_null` has run)."""
    cols = columns or df.columns
    e = F.lit(False)
    for c in cols:
        e = e | col(c).isNull()
    return e


def drop_any_null(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL anywhere."""
    return df.na.drop("any")


def keep_non_negative(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Every numeric column ``>= 0`` (NULL fails, as NaN does in pandas)."""
    cols = columns or numeric_columns(df)
    e = F.lit(True)
    for c in cols:
        e = e & F.coalesce(nan_to_null(col(c).cast("double")) >= 0, F.lit(False))
    return df.filter(e)


def in_range(c: Column, lo: float | None, hi: float | None) -> Column:
    """C4 rule: ``(x >= lo or x = 0) and x <= hi``; None is unbounded.
    NULL and NaN yield false (the row is dropped)."""
    c = nan_to_null(c.cast("double"))
    e = F.lit(True)
    if lo is not None:
        e = e & ((c >= F.lit(lo)) | (c == 0))
    if hi is not None:
        e = e & (c <= F.lit(hi))
    return F.coalesce(e & c.isNotNull(), F.lit(False))


def keep_in_range(df: DataFrame, lo: float | None = 1, hi: float | None = 100000,
                  columns: list[str] | None = None) -> DataFrame:
    """C4: keep rows whose every numeric column passes the range rule."""
    cols = columns or numeric_columns(df)
    e = F.lit(True)
    for c in cols:
        e = e & in_range(col(c), lo, hi)
    return df.filter(e)


@dataclass(frozen=True)
class FilterConfig:
    """C5 switches; the source's defaults when filtering is requested."""
    remove_empty: bool = False
    remove_negative: bool = False
    value_range: tuple[float | None, float | None] | None = None


def filter_reason(df: DataFrame, cfg: FilterConfig, columns: list[str] | None = None) -> Column:
    """The first failing rule of each row, in the source's order:
    ``empty``, then each numeric column in frame order; NULL = kept."""
    cols = columns if columns is not None else numeric_columns(df)
    branches = []
    if cfg.remove_empty:
        branches.append(F.when(any_null(df), F.lit("rows_dropped_empty")))
    if cfg.remove_negative or cfg.value_range:
        for c in cols:
            ok = F.lit(True)
            if cfg.remove_negative:
                ok = ok & F.coalesce(col(c) >= 0, F.lit(False))
            if cfg.value_range:
                lo, hi = cfg.value_range
                ok = ok & in_range(col(c), lo, hi)
            branches.append(F.when(~ok, F.lit(f"rows_dropped_{c}")))
    if not branches:
        return F.lit(None).cast("string")
    return F.coalesce(*branches) if len(branches) > 1 else branches[0]


def filter_values(df: DataFrame, cfg: FilterConfig) -> tuple[DataFrame, DataFrame]:
    """C5 ``filter_values`` -> (kept rows, statistics ``(stat, rows)``).
    Each dropped row counts once, for its first failing rule; per-column
    entries with no drops are omitted; ``rows_dropped_empty`` is always
    present when that rule is on; totals close the table. NaN is missing and
    comes back as NULL."""
    df = nan_as_null(df)
    tagged = df.withColumn(REASON, filter_reason(df, cfg))
    kept = tagged.filter(F.col(REASON).isNull()).drop(REASON)
    stats = _reason_stats(tagged.groupBy(REASON).agg(F.count(F.lit(1)).alias("_n")), cfg)
    return kept, stats


def _reason_stats(counts: DataFrame, cfg: FilterConfig, mult: str = "_n") -> DataFrame:
    """Statistics table from ``(reason, n)``; tiny, stays in Spark."""
    totals = counts.agg(F.sum(mult).cast("long").alias("initial"),
                        F.sum(F.when(F.col(REASON).isNull(), F.col(mult))).cast("long").alias("final"))
    per = counts.filter(F.col(REASON).isNotNull()).select(F.col(REASON).alias("stat"),
                                                          F.col(mult).cast("long").alias("rows"))
    parts = [per]
    if cfg.remove_empty:
        parts.append(counts.agg(F.coalesce(F.sum(F.when(F.col(REASON) == "rows_dropped_empty", F.col(mult))),
                                           F.lit(0)).cast("long").alias("rows"))
                     .filter(F.col("rows") == 0).select(F.lit("rows_dropped_empty").alias("stat"), "rows"))
    tot = totals.select(F.inline(F.array(
        F.struct(F.lit("total_rows_initial").alias("stat"), F.coalesce("initial", F.lit(0)).cast("long").alias("rows")),
        F.struct(F.lit("total_rows_final").alias("stat"), F.coalesce("final", F.lit(0)).cast("long").alias("rows")),
        F.struct(F.lit("total_rows_dropped").alias("stat"),
                 (F.coalesce("initial", F.lit(0)) - F.coalesce("final", F.lit(0))).cast("long").alias("rows")))))
    parts.append(tot)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def present(df: DataFrame, c: str) -> Column:
    """The column with NaN as NULL."""
    return nan_to_null(col(c)) if df.schema[c].dataType.typeName() in ("double", "float") else col(c)


def clipped(y: Column) -> Column:
    # greatest() skips NULLs: by itself it would turn a missing target into 0
    return F.when(y.isNotNull(), F.greatest(y, F.lit(0.0)))


def drop_null_label(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows whose target is NULL or NaN go."""
    return df.filter(present(df, label).isNotNull())


def clip_negative_label(df: DataFrame, label: str = "label") -> DataFrame:
    """``max(y, 0)``; a missing target (NULL, NaN) stays missing, as NULL."""
    return df.withColumn(label, clipped(present(df, label)))


def clean_rows(df: DataFrame, cfg: FilterConfig | None = None, label: str = "label",
               normalize: bool = True) -> tuple[DataFrame, DataFrame]:
    """B1 -> C1 -> optional C2-C5 -> C6 -> C7, as one lazy plan.

    Returns the cleaned frame and a statistics table ``(stat, rows)`` with
    ``duplicates_removed``, the filter entries, ``null_target_removed``,
    ``negative_target_clipped``, ``rows_initial`` and ``rows_final``; both
    come from the same deduplicating aggregate (cache the frame to run it
    once when both are used). NaN is missing everywhere: it equals NULL among
    copies, fails the filters and the label check, and comes back as NULL.
    """
    cfg = cfg or FilterConfig()
    df = nan_as_null(df)
    if normalize:
        df = normalize_column_names(df)
        label = label.lower()
    feature_cols = [c for c in df.columns]
    dd = df.groupBy(*[col(c) for c in feature_cols]).agg(F.count(F.lit(1)).alias("_mult"))
    tagged = dd.withColumn(REASON, filter_reason(df, cfg))
    y = col(label)
    cleaned = tagged.filter(F.col(REASON).isNull() & y.isNotNull()) \
        .select(*[col(c) for c in feature_cols]) \
        .withColumn(label, clipped(y))
    counts = tagged.groupBy(REASON).agg(F.count(F.lit(1)).alias("_n"))
    fstats = _reason_stats(counts, cfg) if (cfg.remove_empty or cfg.remove_negative or cfg.value_range) else None
    base = tagged.agg(
        F.sum("_mult").cast("long").alias("rows_initial"),
        (F.sum("_mult") - F.count(F.lit(1))).cast("long").alias("duplicates_removed"),
        F.count_if(F.col(REASON).isNull() & y.isNull()).cast("long").alias("null_target_removed"),
        F.count_if(F.col(REASON).isNull() & (y < 0)).cast("long").alias("negative_target_clipped"),
        F.count_if(F.col(REASON).isNull() & y.isNotNull()).cast("long").alias("rows_final"))
    stats = base.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("stat"), F.col(n).alias("rows"))
        for n in ["rows_initial", "duplicates_removed", "null_target_removed",
                  "negative_target_clipped", "rows_final"]])))
    if fstats is not None:
        stats = stats.unionByName(fstats.filter(~F.col("stat").startswith("total_")))
    return cleaned, stats


__all__ = ["FilterConfig", "remove_duplicates", "duplicate_stats", "drop_any_null", "keep_non_negative",
           "keep_in_range", "in_range", "filter_reason", "filter_values", "drop_null_label",
           "clip_negative_label", "clean_rows"]
