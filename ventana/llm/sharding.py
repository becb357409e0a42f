"""Consistent-hash sharding with bounded loads, in DataFrame operations only.

The ring has ``vnodes`` virtual nodes per shard at hashed places. A row's key
is its text, so equal texts stand at one place. Each virtual node owns the arc
that ends at it. A shard admits the bytes of its own arcs in ring order until
it is full; what is left over continues clockwise to the next virtual node
whose shard has room. A full shard holds ``(1 + slack)`` times the mean, so
the sizes are near equal by construction, and only overflow moves.

Within an arc rows stand in the order of their places, equal texts side by
side, so a byte offset is a place in that order and a border between shards
cuts one text at most. The plan is a small table of byte ranges: (arc, from,
to, shard). It is made from the arcs' totals alone (``shards * vnodes`` rows,
whatever the data). Rows find their byte offset by a two-level prefix sum:
totals of buckets first, then a running sum inside a bucket. A bucket is a
sub-range of an arc; a text that holds more than 1 / HOT of all bytes (so there
are fewer than HOT of them) is cut out of its sub-range and salted by the part
of the table its rows were read from, so no bucket is one key's.
"""

from __future__ import annotations

import json
from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ventana.llm.common import pick
from ventana.session import materialise

LAW = "bytes"
SUBS, SALTS, CELL_BITS, HOT = 128, 64, 12, 4096
BUCKET = ["arc", "sub", "piece", "salt"]


def ring(spark: SparkSession, shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node in ring order."""
    # a shard's places are its own: another number of shards leaves them where they are
    nodes = (spark.range(shards * vnodes).select(F.floor(F.col("id") / vnodes).cast("int").alias("shard"), (F.col("id") % vnodes).alias("nth"))
             .select("shard", F.xxhash64(F.lit("vnode"), "shard", "nth").alias("place")))
    return sorted((r.place, r.shard) for r in nodes.collect())


def _arcs(spark: SparkSession, nodes: list[tuple[int, int]], hot: list[int]) -> DataFrame:
    """(cell, lo, hi, arc, first, width, turn, piece, hot): the ring's cells cut at
    the virtual nodes and around hot places; a place p lies in the one row of
    its cell with lo < p <= hi. ``first`` and ``width`` describe the arc itself,
    ``piece`` counts the cuts at hot places from the ring's lowest place on."""
    places, hot = [p for p, _ in nodes], sorted(hot)
    # a hot place is a piece of its own: cut before it and after it
    cuts = sorted({c for p in hot for c in (p - 1, p)})
    known = set(hot)
    step, low = 1 << (64 - CELL_BITS), -(1 << 63)
    rows = []
    for cell in range(1 << CELL_BITS):
        a, end = low + cell * step - 1, low + (cell + 1) * step - 1
        while a < end:
            i = bisect_left(places, a + 1)
            b = min(end, places[i]) if i < len(places) else end
            j = bisect_left(cuts, a + 1)
            b = min(b, cuts[j]) if j < len(cuts) else b
            arc = i % len(places)
            # what lies above the last virtual node belongs to the first arc and stands at its end
            first = places[i - 1] if i else low
            width = max(1, (places[i] if i < len(places) else -low) - first)
            turn = int(i == len(places))
            rows.append({"cell": cell, "lo": a if a >= low else None, "hi": b, "arc": arc, "first": first, "width": float(width),
                         "turn": turn, "piece": j, "hot": b in known and a == b - 1})
            a = b
    return _literal(spark, rows, "cell int, lo bigint, hi bigint, arc int, first bigint, width double, turn int, piece int, hot boolean")


def _literal(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table of constants."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{_ddl(schema)}>>")))


def _ddl(schema: str) -> str:
    return ", ".join(f"{n}: {t}" for n, t in (f.split() for f in schema.split(", ")))


def plan(loads: dict[int, int], nodes: list[tuple[int, int]], shards: int, capacity: int) -> list[dict]:
    """Byte ranges of the arcs and their shards. Own arcs first, in ring
    order; then each overflow goes on clockwise from where it arose."""
    room = [capacity] * shards
    out, over = [], []
    for arc, (_, shard) in enumerate(nodes):
        load = loads.get(arc, 0)
        take = min(load, room[shard])
        room[shard] -= take
        if take:
            out.append({"arc": arc, "from": 0, "to": take, "shard": shard})
        if take < load:
            over.append((arc, take, load))
    for arc, at, end in over:
        step = 1
        while at < end:
            shard = nodes[(arc + step) % len(nodes)][1]
            take = min(end - at, room[shard])
            room[shard] -= take
            if take:
                out.append({"arc": arc, "from": at, "to": at + take, "shard": shard})
            at, step = at + take, step + 1
    return out


def shard(spark: SparkSession, docs: DataFrame, shards: int = 16, vnodes: int = 64, slack: float = 0.001,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row.

    ``size`` is the text's UTF-8 bytes plus 1; ``slot`` counts from 0 without
    gaps within a shard. Every shard's size is at most ``(1 + slack)`` times
    the mean (and one row per byte range that ends in it). A null text counts
    as empty; empty texts share a place; repeated rows and null doc_ids are
    placed like any others (equal ones in either order); an empty table gives
    an empty one; other columns are not looked at. Copies of one text stand
    side by side: a shard's border in an arc cuts one text at most. Which copy
    of a text of more than 1 / HOT of all bytes comes first depends on how the
    table was read, else the smaller doc_id.
    """
    nodes = ring(spark, shards, vnodes)
    text = F.coalesce(F.col("text"), F.lit(""))
    base = pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("place"),
        F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.lit(SALTS)).cast("int").alias("spread"))
    base, _ = materialise(spark, base, "shard-places")
    weights = base.groupBy("place").agg(F.sum("size").alias("bytes"))
    whole = base.agg(F.sum("size")).first()[0] or 0
    hot = [r.place for r in weights.where(F.col("bytes") > whole / HOT).collect()]  # fewer than HOT
    base = base.withColumn("cell", F.shiftrightunsigned("place", 64 - CELL_BITS).cast("int"))
    # cells count from the lowest signed place
    base = base.withColumn("cell", F.col("cell").bitwiseXOR(F.lit(1 << (CELL_BITS - 1))))
    # at most 2 ** CELL_BITS + shards * vnodes + 2 HOT rows
    arcs = F.broadcast(_arcs(spark, nodes, hot).withColumnRenamed("cell", "arc_cell"))
    base = base.join(arcs, (F.col("cell") == F.col("arc_cell")) & (F.col("place") <= F.col("hi"))
                     & (F.col("lo").isNull() | (F.col("place") > F.col("lo"))))
    part = (F.col("place").cast("double") - F.col("first").cast("double")) / F.col("width") * SUBS
    base = base.withColumn("sub", F.greatest(F.lit(0), F.least(F.lit(SUBS - 1), F.floor(part).cast("int"))) + F.col("turn") * SUBS)
    base = base.withColumn("salt", F.when(F.col("hot"), F.col("spread")).otherwise(0)).select("doc_id", "size", "text_crc32", "place", *BUCKET)

    totals = base.groupBy(*BUCKET).agg(F.sum("size").alias("bytes"))
    loads = {r.arc: r.bytes for r in totals.groupBy("arc").agg(F.sum("bytes").alias("bytes")).collect()}
    capacity = int(sum(loads.values()) / shards * (1 + slack)) + 1
    ranges = _literal(spark, plan(loads, nodes, shards, capacity), "arc int, from bigint, to bigint, shard int")
    ranges = ranges.select(F.col("arc").alias("plan_arc"), "from", "to", "shard")

    before = Window.partitionBy("arc").orderBy("sub", "piece", "salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*BUCKET, F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bucket_start"))
    inside = Window.partitionBy(*BUCKET).orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = base.join(starts, BUCKET).withColumn("at", F.col("bucket_start") + F.sum("size").over(inside) - F.col("size"))
    # at most a row per arc and one more per shard that an overflow passes
    placed = placed.join(F.broadcast(ranges), (F.col("arc") == F.col("plan_arc")) & (F.col("at") >= F.col("from")) & (F.col("at") < F.col("to")))
    placed = placed.select("doc_id", "size", "text_crc32", "shard", "place", "at", *BUCKET)

    counts = placed.groupBy("shard", *BUCKET).agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("shard").orderBy(*BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("shard", *BUCKET, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("slot_base"))
    own = Window.partitionBy(*BUCKET, "shard").orderBy("at")
    return (placed.withColumn("rank", F.row_number().over(own))
            .join(bases, [*BUCKET, "shard"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("slot_base") + F.col("rank") - 1).alias("slot")))
