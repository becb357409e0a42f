"""Exact top-k inner products by a three-phase uniform threshold.

A vector's components are divided among ``m`` lists; a list's local score of
(query, row) is the inner product over its own components, and the score is
their sum.

1. Each list sends its best local entries. The rows named there get their
   whole score; the k-th best of these is a score that the k-th best of all
   rows cannot fall below.
2. That cutoff over ``m`` goes to every list, which sends all entries at or
   above it. A row that no list sends scores less than the cutoff: the
   entries sent are sufficient.
3. Rows sent by some lists only, whose bound (sent scores, and less than the
   threshold for each other list) still reaches the cutoff, have their missing
   local scores resolved exactly.

Queries and rows meet in blocks of a fixed number of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ventana.llm.common import pick
from ventana.session import materialise

ROWS, QUERIES = 4096, 256
#: Integers up to here are exact in a double.
EXACT = float(1 << 53)


def quantise(vectors: DataFrame, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, v``: floor(scale * x) of valid vectors as packed 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("vec").to_pylist()):
                if v is None or any(x is None for x in v):
                    continue
                x = np.asarray(v, dtype=np.float64)
                if np.isfinite(x).all():
                    ids.append(i)
                    out.append(np.floor(scale * x).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("vec_id").type), pa.array(out, pa.binary())], ["vec_id", "v"])

    src = pick(vectors, vec_id=id_col, vec=vec_col)
    return src.mapInArrow(run, f"vec_id {src.schema['vec_id'].dataType.simpleString()}, v binary")


def matrix(packed: pd.Series, dims: int) -> np.ndarray:
    """Rows of integers (a shorter vector is filled up with zeros); doubles
    where products and sums are exact in them."""
    if packed.map(len).eq(8 * dims).all():
        out = np.frombuffer(b"".join(packed), dtype="<i8").reshape(len(packed), dims)
    else:
        out = np.zeros((len(packed), dims), dtype=np.int64)
        for i, p in enumerate(packed):
            out[i, :len(p) // 8] = np.frombuffer(p, dtype="<i8")
    most = float(np.abs(out.astype(np.float64)).max(initial=0.0))
    return out.astype(np.float64) if most * most * max(1, dims) < EXACT else out


def local_scores(q: np.ndarray, c: np.ndarray, parts: list[slice]) -> np.ndarray:
    """list x query x row; integers."""
    if q.dtype != c.dtype:
        q, c = q.astype(np.int64), c.astype(np.int64)
    return np.stack([q[:, p] @ c[:, p].T for p in parts]).astype(np.int64)


def search(spark: SparkSession, vectors: DataFrame, every: int = 50, k: int = 5, lists: int = 2, scale: int = 256,
           id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible
    by ``every`` the ``k`` best other rows by integer inner product, ties to
    the smaller vec_id.

    Null vectors and those with null or non-finite components take no part.
    Vectors of unequal length are filled up with zeros. A repeated vec_id is a
    row of its own (a query as well, and its twin a candidate). A null vec_id
    is no query; as a candidate it comes before the others in ties. With fewer
    than k other rows all are returned; an empty table gives an empty result.
    Components are taken to stay below 2**27 after scaling, so that sums fit
    64 bits.
    """
    rows, _ = materialise(spark, quantise(vectors, scale, id_col, vec_col).withColumn(
        "uid", F.monotonically_increasing_id()), "topk-vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.octet_length("v")), F.lit(0)).alias("b")).first()
    dims = max(1, size.b // 8)
    cuts = [dims * i // lists for i in range(lists + 1)]
    parts = [slice(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]
    m = len(parts)
    # of equal vectors only the k + 1 smallest ids can be among anyone's k best
    same = Window.partitionBy("v").orderBy("vec_id", "uid")
    pool = rows.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1).drop("nth")
    row_blocks = max(1, -(-size.n // ROWS))
    query_blocks = max(1, -(-size.n // (every * QUERIES)))
    pool = (pool.withColumn("rb", F.pmod(F.xxhash64("uid"), F.lit(row_blocks)).cast("int"))
            .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))
    queries = (rows.where(F.col("vec_id") % every == 0)
               .withColumn("qb", F.pmod(F.xxhash64("uid"), F.lit(query_blocks)).cast("int")))
    met = queries.withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))

    def gather(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        """Phase 1: per query the whole scores of the rows at the heads of the local lists."""
        out = []
        if len(q) and len(c):
            uid = c["uid"].to_numpy()
            local = local_scores(matrix(q["v"], dims), matrix(c["v"], dims), parts)
            total = local.sum(axis=0)
            for i, own in enumerate(q["uid"]):
                heads = {int(j) for s in range(m) for j in _best(local[s, i], k + 1) if uid[j] != own}
                out += [(own, int(t)) for t in sorted((total[i, j] for j in heads), reverse=True)[:k]]
        return pd.DataFrame(out, columns=["quid", "total"])

    heads = met.groupBy("qb", "rb").cogroup(pool.groupBy("qb", "rb")).applyInPandas(gather, "quid bigint, total bigint")
    best = Window.partitionBy("quid").orderBy(F.desc("total"))
    kth = (heads.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k)
           .groupBy("quid").agg(F.min("total").alias("cutoff"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k))
    cutoffs = queries.join(kth, queries.uid == kth.quid, "left").select(*[queries[c] for c in queries.columns], "cutoff")
    cutoffs, _ = materialise(spark, cutoffs, "topk-cutoffs")
    met = cutoffs.withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))

    def collect(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        """Phase 2: the local entries at or above the threshold: the sum of
        those sent for a row, and which lists sent none."""
        out = []
        if len(q) and len(c):
            uid, ids = c["uid"].to_numpy(), c["vec_id"].to_numpy()
            local = local_scores(matrix(q["v"], dims), matrix(c["v"], dims), parts)
            for i, (own, cutoff) in enumerate(zip(q["uid"], q["cutoff"])):
                none = cutoff is None or np.isnan(cutoff)
                sent = np.ones((m, len(c)), bool) if none else local[:, i] * m >= cutoff
                known = np.where(sent, local[:, i], 0).sum(axis=0)
                # each list that sent nothing adds less than cutoff / m
                able = sent.any(axis=0) & (uid != own)
                if not none:
                    missing = (~sent).sum(axis=0)
                    able &= np.where(missing == 0, known >= cutoff, known * m + missing * int(cutoff) > int(cutoff) * m)
                for j in np.flatnonzero(able):
                    out.append((own, int(uid[j]), ids[j], int(known[j]), [s for s in range(m) if not sent[s, j]]))
        return pd.DataFrame(out, columns=["quid", "uid", "vec_id", "known", "missing"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    met = met.withColumn("cutoff", F.col("cutoff").cast("double"))
    entries = met.groupBy("qb", "rb").cogroup(pool.groupBy("qb", "rb")).applyInPandas(
        collect, f"quid bigint, uid bigint, vec_id {kind}, known bigint, missing array<int>")
    entries, _ = materialise(spark, entries, "topk-entries")

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Phase 3: the missing local scores."""
        for batch in batches:
            total = []
            q, c = (matrix(pd.Series(batch.column(x).to_pylist(), dtype=object), dims).astype(np.int64) for x in ("qv", "v"))
            for i, (known, missing) in enumerate(zip(batch.column("known").to_pylist(), batch.column("missing").to_pylist())):
                total.append(known + sum(int(q[i, parts[s]] @ c[i, parts[s]]) for s in missing))
            yield pa.RecordBatch.from_arrays([batch.column("quid"), batch.column("vec_id"), batch.column("uid"), pa.array(total, pa.int64())],
                                             ["quid", "vec_id", "uid", "score"])

    whole = entries.where(F.size("missing") == 0).select("quid", "vec_id", "uid", F.col("known").alias("score"))
    part = entries.where(F.size("missing") > 0)
    part = (part.join(rows.select("uid", "v"), "uid")
            .join(queries.select(F.col("uid").alias("quid"), F.col("v").alias("qv")), "quid")
            .select("quid", "vec_id", "uid", "known", "missing", "v", "qv")
            .mapInArrow(resolve, f"quid bigint, vec_id {kind}, uid bigint, score bigint"))
    final = Window.partitionBy("quid").orderBy(F.desc("score"), "vec_id", "uid")
    ranked = whole.unionByName(part).withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
    names = queries.select(F.col("uid").alias("quid"), F.col("vec_id").alias("query_id"))
    return ranked.join(names, "quid").select("query_id", "rank", "vec_id", "score")


def _best(scores: np.ndarray, n: int) -> np.ndarray:
    return np.argpartition(-scores, n - 1)[:n] if len(scores) > n else np.arange(len(scores))
