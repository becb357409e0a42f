"""Connected components over an edge table, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventana.session import materialise, remove


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable, for every node with an edge
    to a larger or smaller one (roots themselves are left out).

    ``edges`` has two long columns. Alternating star contraction: a node hands
    its larger neighbours to its smallest one, then the same for the smaller
    neighbours, until every edge points at its root. Each round is two
    aggregations with map-side minima and two joins that Spark may split where
    a node has very many edges; it is written to the shared folder, and the
    one before is removed.
    """
    a, b = (F.col(c) for c in edges.columns)
    now = edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now, path = materialise(spark, now, "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        larger = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        larger = larger.distinct()
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        stars = larger.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
        stars = stars.select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct()
        now, fresh = materialise(spark, stars, "edges")
        remove(spark, path)
        path = fresh
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark


def spanning(n: int, pairs) -> list[tuple[int, int]]:
    """(member, smallest member) of each set that ``pairs`` of 0..n-1 connect;
    at most n - 1 of them."""
    up = list(range(n))

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, j in pairs:
        i, j = top(i), top(j)
        if i != j:
            up[max(i, j)] = min(i, j)
    return [(i, top(i)) for i in range(n) if up[i] != i]
