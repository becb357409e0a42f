"""F1-F8 -- deterministic splits, folds, samples and row positions.

The random draw of the source (a seeded shuffle) becomes ``u = md5(key:seed)``
mapped to [0, 1): it depends only on the row's key, so it is identical
under any repartitioning, after a lost executor recomputes a task, and in
plain SQL. Positional ops (contiguous folds, "first m rows", chunks) use
the exact distributed row index of ``ventana.functions.ordering``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ventana.functions.exprs import col, uniform_hash
from ventana.functions.ordering import global_row_index

SPLIT, FOLD, U = "split", "fold", "_u"


def _key(keys: list[str] | str) -> Column:
    ks = [keys] if isinstance(keys, str) else list(keys)
    if len(ks) == 1:
        return col(ks[0])
    return F.concat_ws("|", *[col(k).cast("string") for k in ks])


def split_data(df: DataFrame, key: list[str] | str, val_size: float = 0.2, test_size: float = 0.2,
               seed: int = 42, exact: bool = False) -> DataFrame:
    """adds ``split`` in {train, val, test}. Hash mode: ``u < 1-v-t`` is
    train, then val, then test. ``exact`` gives the source's sizes (test =
    ceil(n*t), val = ceil((n-test)*v/(1-t))) by ranking u over the whole
    frame with the distributed row index."""
    u = uniform_hash(_key(key), seed)
    if not exact:
        tr = 1.0 - val_size - test_size
        s = F.when(u < tr, "train").when(u < tr + val_size, "val").otherwise("test")
        return df.withColumn(SPLIT, s)
    ranked = global_row_index(df.withColumn(U, u), [U] + ([key] if isinstance(key, str) else list(key)), "_r")
    n = ranked.count()
    n_test = math.ceil(n * test_size)
    n_val = math.ceil((n - n_test) * (val_size / (1 - test_size))) if test_size < 1 else 0
    r = F.col("_r")
    s = F.when(r < n_test, "test").when(r < n_test + n_val, "val").otherwise("train")
    return ranked.withColumn(SPLIT, s).drop("_r", U)


def split_sizes(df: DataFrame) -> DataFrame:
    """rows per split."""
    return df.groupBy(SPLIT).agg(F.count(F.lit(1)).cast("long").alias("n_rows"))


def hash_folds(df: DataFrame, key: list[str] | str, k: int = 5, seed: int = 42) -> DataFrame:
    """F2 (shuffled KFold): ``fold = floor(u * k)``."""
    return df.withColumn(FOLD, F.least(F.floor(uniform_hash(_key(key), seed) * k), F.lit(k - 1)).cast("int"))


def _contiguous_fold(r: Column, n: int, k: int) -> Column:
    """Folds of the source's KFold: the first ``n % k`` folds hold one extra row."""
    big, small = n // k + 1, n // k
    n_big = n % k
    edge = n_big * big
    if small == 0:
        return r.cast("int")
    return F.when(r < edge, F.floor(r / big)).otherwise(n_big + F.floor((r - edge) / small)).cast("int")


def contiguous_folds(df: DataFrame, order_by: list[str], k: int = 5) -> DataFrame:
    """what an integer ``cv=k`` means -- contiguous ranges of the row
    order, the first ``n % k`` folds one row larger."""
    ranked = global_row_index(df, order_by, "_r")
    n = ranked.count()
    return ranked.withColumn(FOLD, _contiguous_fold(F.col("_r"), n, k)).drop("_r")


def shuffled_folds_exact(df: DataFrame, key: list[str] | str, k: int = 5, seed: int = 42) -> DataFrame:
    """F2 exact sizes: contiguous folds over the hash order."""
    ks = [key] if isinstance(key, str) else list(key)
    d = df.withColumn(U, uniform_hash(_key(key), seed))
    return contiguous_folds(d, [U] + ks, k).drop(U)


def stratified_folds(df: DataFrame, key: list[str] | str, label: str = "label", k: int = 5,
                     seed: int = 42) -> DataFrame:
    """within each class, rows in hash order are dealt to folds
    round-robin. The position inside the class is the global row index
    minus the class's first index, so a class holding a third of all rows
    is not collected into one window task."""
    ks = [key] if isinstance(key, str) else list(key)
    d = df.withColumn(U, uniform_hash(_key(key), seed))
    ranked = global_row_index(d, [label, U] + ks, "_r")
    first = ranked.groupBy(col(label).alias("_label")).agg(F.min("_r").alias("_r0"))
    # rows without a label are a class of their own
    j = ranked.join(first, col(label).eqNullSafe(F.col("_label")))
    return j.withColumn(FOLD, ((F.col("_r") - F.col("_r0")) % k).cast("int")).drop("_r", "_r0", "_label", U)


def head_sample(df: DataFrame, order_by: list[str], fraction_div: int = 5, minimum: int = 1000) -> DataFrame:
    """the first ``max(n // 5, 1000)`` rows in ``order_by`` order, what
    the source's chunked network was tuned on. Nothing here fits on it: tuning
    uses :func:`tuning_sample`, whose bound is a parameter (default: all rows)."""
    ranked = global_row_index(df, order_by, "_r")
    n = ranked.count()
    m = max(n // fraction_div, minimum)
    return ranked.filter(F.col("_r") < m).drop("_r")


def tuning_sample(df: DataFrame, key: list[str] | str, rows: int | None = None, seed: int = 42) -> DataFrame:
    """The rows a model is tuned on: all of them, or the ``rows`` with the
    smallest key hash (independent of row order and partitioning)."""
    if rows is None:
        return df
    ks = [key] if isinstance(key, str) else list(key)
    ranked = global_row_index(df.withColumn(U, uniform_hash(_key(key), seed)), [U] + ks, "_r")
    return ranked.filter(F.col("_r") < rows).drop("_r", U)


def chunk_ids(df: DataFrame, order_by: list[str], size: int = 2000) -> DataFrame:
    """``chunk = row_position div size`` (ceil(n/size) chunks)."""
    ranked = global_row_index(df, order_by, "_r")
    return ranked.withColumn("chunk", F.floor(F.col("_r") / size).cast("int")).drop("_r")


def row_index(df: DataFrame, order_by: list[str], name: str = "row_idx") -> DataFrame:
    """F8: dense 0..n-1 position (index reset)."""
    return global_row_index(df, order_by, name)


__all__ = ["split_data", "split_sizes", "hash_folds", "contiguous_folds", "shuffled_folds_exact",
           "stratified_folds", "head_sample", "tuning_sample", "chunk_ids", "row_index", "SPLIT", "FOLD"]
