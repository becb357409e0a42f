"""Order-dependent work without a single-partition window.

``ordered_chunks`` range-partitions a frame on ``(partition_by, order_by,
tie)`` -- ``tie`` is a hash of the whole row, so a key value that holds a
third of all rows is still split over many chunks -- sorts each chunk, and
materialises ``(_chunk, _pos)`` with ``checkpoint()`` in the shared
checkpoint folder: range bounds come from sampling, so both consumers of the
chunk ids (the small per-chunk summary and the rows) must read the same
materialised assignment, also after an executor is lost.

On top of it:

* ``global_row_index``: exact dense 0..n-1 position = prefix sum of chunk
  sizes (one row per chunk, broadcast) + position inside the chunk.
* ``fill_forward_backward``: last non-NULL value at or before each row
  (then first at or after), per group: per-chunk summaries carry values
  across chunk borders; only the chunk summaries are windowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ventana.functions.exprs import col
from ventana.session import checkpoint_dir

CHUNK, POS, TIE = "_chunk", "_pos", "_tie"
_LOW33 = (1 << 33) - 1


def default_chunks(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def ordered_chunks(df: DataFrame, order_by: list[str], partition_by: list[str] | None = None,
                   n_chunks: int | None = None) -> DataFrame:
    """Adds ``_chunk`` (monotone in the sort order) and ``_pos`` (position
    inside the chunk); the result is checkpointed."""
    if not order_by:
        raise ValueError("an explicit order is required for an order-dependent operator")
    part = list(partition_by or [])
    n = n_chunks or default_chunks(df)
    tie = F.xxhash64(*[col(c) for c in df.columns])
    keys = [col(c) for c in part + list(order_by)] + [F.col(TIE)]
    ranged = df.withColumn(TIE, tie).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    # the low 33 bits of monotonically_increasing_id are the row's position
    # inside its partition, which after sortWithinPartitions is the sort order
    out = ranged.withColumn(CHUNK, F.spark_partition_id()) \
                .withColumn(POS, F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33)))
    checkpoint_dir(df.sparkSession)
    # persist first: a reliable checkpoint otherwise computes its input twice
    # (once for the action, once to write the files)
    out = out.persist()
    ck = out.checkpoint(eager=True)
    out.unpersist()
    return ck


def global_row_index(df: DataFrame, order_by: list[str], name: str = "row_idx",
                     n_chunks: int | None = None) -> DataFrame:
    """F8: exact 0-based position in ``order_by`` order (ties broken by a
    row hash). The offsets table has one row per chunk."""
    ch = ordered_chunks(df, order_by, None, n_chunks)
    sizes = ch.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("_size"))
    w = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(CHUNK, F.coalesce(F.sum("_size").over(w), F.lit(0)).alias("_off"))
    out = ch.join(F.broadcast(offsets), CHUNK).withColumn(name, (F.col("_off") + F.col(POS)).cast("long"))
    return out.drop(CHUNK, POS, TIE, "_off")


def fill_forward_backward(df: DataFrame, columns: list[str], order_by: list[str],
                          partition_by: list[str] | None = None, backward: bool = True,
                          n_chunks: int | None = None) -> DataFrame:
    """D3: each NULL takes the last non-NULL value before it (in order, per
    group); with ``backward`` the leading NULLs then take the first non-NULL
    value after them. All-NULL groups stay NULL."""
    part = list(partition_by or [])
    ch = ordered_chunks(df, order_by, part, n_chunks)
    gk = part + [CHUNK]
    sk = F.struct(F.col(POS))  # inside a chunk, _pos is the sort order
    summ_aggs = []
    for i, c in enumerate(columns):
        ok = col(c).isNotNull()
        summ_aggs.append(F.max_by(col(c), F.when(ok, sk)).alias(f"_l{i}"))
        summ_aggs.append(F.min_by(col(c), F.when(ok, sk)).alias(f"_f{i}"))
    summ = ch.groupBy(*[col(c) for c in gk]).agg(*summ_aggs)
    # Only growing frames (unbounded preceding .. current/-1): Spark evaluates
    # an unbounded-FOLLOWING frame in O(n^2) per partition, so the backward
    # direction is a forward scan in descending order.
    pw = Window.partitionBy(*[col(c) for c in part]) if part else Window
    before = pw.orderBy(F.col(CHUNK).asc()).rowsBetween(Window.unboundedPreceding, -1)
    after = pw.orderBy(F.col(CHUNK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select(*[col(c) for c in gk],
                        *[F.last(f"_l{i}", ignorenulls=True).over(before).alias(f"_cl{i}") for i in range(len(columns))],
                        *[F.last(f"_f{i}", ignorenulls=True).over(after).alias(f"_cf{i}") for i in range(len(columns))])
    # a NULL group is a group: its carried values must reach it
    carry = carry.withColumnsRenamed({g: f"_g{i}" for i, g in enumerate(gk)})
    same = F.lit(True)
    for i, g in enumerate(gk):
        same = same & col(g).eqNullSafe(F.col(f"_g{i}"))
    j = ch.join(carry, same, "left")
    wr = Window.partitionBy(*[col(c) for c in gk])
    upto = wr.orderBy(F.col(POS).asc()).rowsBetween(Window.unboundedPreceding, 0)
    fromh = wr.orderBy(F.col(POS).desc()).rowsBetween(Window.unboundedPreceding, 0)
    filled = {}
    for i, c in enumerate(columns):
        fwd = F.coalesce(F.last(col(c), ignorenulls=True).over(upto), F.col(f"_cl{i}"))
        if backward:
            fwd = F.coalesce(fwd, F.last(col(c), ignorenulls=True).over(fromh), F.col(f"_cf{i}"))
        filled[c] = fwd
    out = j.select(*[filled[c].alias(c) if c in filled else col(c) for c in df.columns])
    return out
