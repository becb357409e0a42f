"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors with cosine at least c lie within eps = sqrt(2 - 2c) of each
other. They are turned to their principal axes, given the grid cell (of side
eps) of their leading coordinates and sorted by it. The order is cut into
sequence intervals with a bounding box each. Two intervals meet only where
their boxes come within eps; there they are halved again and again, halves
whose boxes are farther apart than eps are skipped, and the rest are compared.

Equal vectors count as one with a weight, so copies are never expanded. An
interval is one row of a table in the shared folder, and a task reads some of
these against some others (a cartesian product of the files' splits): whatever
the number of meetings, no vector is shuffled for one, and disk grows with the
vectors. A task returns counts and a spanning forest of all its meetings: as many
rows as it has vectors at most, whatever the number of links. Vectors of single
precision are kept in it; two 64-bit hashes of the unit vector name a class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ventana.llm.common import pick
from ventana.llm.graph import components
from ventana.session import materialise

#: Vectors of a sequence interval, and their bytes at most; vectors at which the halving ends.
INTERVAL, BYTES, LEAF = 4096, 4_000_000, 512
#: Leading principal dimensions in the grid.
GRID = 8
#: Single-precision products are trusted beyond this distance from the threshold.
MARGIN = 1e-4


def unit_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, str]:
    """``vec_id, v, k1, k2``: every row; v is the packed vector and the keys are
    hashes of its unit vector, null for vectors that link with nothing. And v's numpy type."""
    src = pick(vectors, vec_id=id_col, vec=vec_col)
    kind = "<f4" if src.schema["vec"].dataType.elementType == T.FloatType() else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, unit = [], []
            for v in batch.column("vec").to_pylist():
                x = None if v is None or any(c is None for c in v) else np.asarray(v, dtype=np.float64)
                ok = x is not None and len(x) and np.isfinite(x).all() and x.any()
                raw.append(x.astype(kind).tobytes() if ok else None)
                unit.append(units(x[None, :]).tobytes() if ok else None)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(raw, pa.binary()), pa.array(unit, pa.binary())], ["vec_id", "v", "x"])

    made = src.mapInArrow(run, f"vec_id {src.schema['vec_id'].dataType.simpleString()}, v binary, x binary")
    known = F.col("x").isNotNull()
    return made.select("vec_id", "v", F.when(known, F.xxhash64("x")).alias("k1"), F.when(known, F.xxhash64(F.lit(1), "x")).alias("k2")), kind


def units(x: np.ndarray) -> np.ndarray:
    """The rows, finite and not zero, at length 1."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def unpacked(v: list[bytes], kind: str, dims: int) -> np.ndarray:
    return units(np.frombuffer(b"".join(v), dtype=kind).reshape(-1, dims).astype(np.float64))


def principal_axes(reps: DataFrame, kind: str, dims: int) -> np.ndarray:
    """Columns: the axes of the vectors' second moments, largest first. Sums
    of products are added up by Spark; dims x dims numbers come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((dims, dims))
        for batch in batches:
            x = unpacked(batch.column("v").to_pylist(), kind, dims)
            gram += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(dims * dims), pa.int32()), pa.array(gram.ravel())], ["at", "value"])

    gram = np.zeros(dims * dims)
    for r in reps.select("v").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect():
        gram[r.at] = r.value
    # rounded: the order of the sums must not change the grid between two computations of it
    values, axes = np.linalg.eigh(np.round(gram.reshape(dims, dims), 6))
    return axes[:, np.argsort(-values, kind="stable")]


def _box_far(a: tuple, b: tuple, eps: float) -> bool:
    gap = np.maximum(0.0, np.maximum(a[0] - b[1], b[0] - a[1]))
    return float(gap @ gap) > eps * eps * (1 + 1e-6) + 1e-9


def _meet(x: np.ndarray, y: np.ndarray, same: bool, cosine: float, eps: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of near vectors; within one interval each pair once."""
    xs, ys = x.astype(np.float32), y.astype(np.float32)
    halt = max(1, LEAF)
    boxes: dict[tuple, tuple] = {}

    def box(side: int, z: np.ndarray, a: int, b: int) -> tuple:
        key = (side, a, b)
        if key not in boxes:
            boxes[key] = (z[a:b].min(axis=0), z[a:b].max(axis=0))
        return boxes[key]

    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        if a >= b or c >= d or (same and a >= d) or _box_far(box(0, x, a, b), box(1, y, c, d), eps):
            continue
        if b - a > halt or d - c > halt:
            p, q = (a + b) // 2 if b - a > halt else b, (c + d) // 2 if d - c > halt else d
            todo += [(i, j, k, n) for i, j in ((a, p), (p, b)) for k, n in ((c, q), (q, d))]
            continue
        near = xs[a:b] @ ys[c:d].T
        i, j = np.nonzero(near >= cosine - MARGIN)
        if not len(i):
            continue
        close = near[i, j] < cosine + MARGIN
        i, j = i + a, j + c
        keep = i < j if same else np.ones(len(i), bool)
        at = np.flatnonzero(close & keep)
        for u in range(0, len(at), 65536):
            w = at[u:u + 65536]
            keep[w] = np.einsum("ij,ij->i", x[i[w]], y[j[w]]) >= cosine
        if keep.any():
            yield i[keep], j[keep]


def join(spark: SparkSession, vectors: DataFrame, cosine: float = 0.95,
         id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept``: one row per input row.

    ``n_links`` counts the other rows with cosine >= ``cosine``;
    ``component_id`` is the smallest vec_id reachable by links (itself
    included); ``kept`` tells whether that is its own. Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing, and
    vectors of unequal length are not compared. Repeated rows are copies that
    link with each other (with one vec_id they share a component and are all
    kept). A null vec_id is passed by in minima; a component of null ids alone
    has a null id and kept is false. An empty table gives an empty one.
    """
    rows, kind = unit_vectors(vectors, id_col, vec_col)
    reps = rows.where("k1 is not null").groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"), F.first("v").alias("v"))
    reps, _ = materialise(spark, reps.withColumn("uid", F.monotonically_increasing_id()), "grid-classes")
    links = [_links(spark, reps.where(F.octet_length("v") == r.size), kind, r.size // np.dtype(kind).itemsize, cosine)
             for r in reps.select(F.octet_length("v").alias("size")).distinct().orderBy("size").collect()]
    met = links[0] if links else spark.createDataFrame([], MET)
    for more in links[1:]:
        met = met.unionByName(more)
    met, _ = materialise(spark, met, "grid-links")
    found = met.groupBy("uid").agg(F.sum("links").alias("links"))
    roots = components(spark, met.where("root is not null").select("uid", "root"))
    classes = (reps.join(found, "uid", "left").join(roots, reps.uid == roots.node, "left")
               .select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                       F.coalesce("root", "uid").alias("root"), "least"))
    names = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = classes.join(names, "root").select("k1", "k2", "n_links", "component_id")
    out = rows.where("k1 is not null").select("vec_id", "k1", "k2").join(classes, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("k1 is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


MET = "uid bigint, links bigint, root bigint"


def _links(spark: SparkSession, reps: DataFrame, kind: str, dims: int, cosine: float) -> DataFrame:
    """``uid, links, root``: per task of meetings each vector's weighted links
    there, and the smallest vector it hangs together with."""
    axes = principal_axes(reps, kind, dims)
    eps = float(np.sqrt(max(0.0, 2 - 2 * cosine))) or 1e-9
    lead, most = min(GRID, dims), min(INTERVAL, max(LEAF, BYTES // (dims * np.dtype(kind).itemsize)))
    cells = [f"c{i}" for i in range(lead)]

    def grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.floor((unpacked(batch.column("v").to_pylist(), kind, dims) @ axes[:, :lead]) / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("weight"), batch.column("v"),
                                              *[pa.array(cell[:, i]) for i in range(lead)]], ["uid", "weight", "v", *cells])

    placed = reps.select("uid", "weight", "v").mapInArrow(
        grid, "uid bigint, weight bigint, v binary, " + ", ".join(f"{c} int" for c in cells))
    n = reps.count()
    placed = placed.repartitionByRange(max(1, -(-n // most)), *cells, "uid").sortWithinPartitions(*cells, "uid")

    def intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per sequence interval: its vectors and their box."""
        part, held, number, waiting = TaskContext.get().partitionId(), 0, 0, []

        def cut() -> pa.RecordBatch:
            t = pa.Table.from_batches(waiting)
            v = t.column("v").to_pylist()
            y = unpacked(v, kind, dims) @ axes
            uid, weight = (t.column(c).to_numpy().astype("<i8").tobytes() for c in ("uid", "weight"))
            return pa.RecordBatch.from_arrays([pa.array([(part << 32) + number], pa.int64()), *[pa.array([b], pa.binary()) for b in (uid, weight, b"".join(v))],
                                               *[pa.array([b.tolist()], pa.list_(pa.float64())) for b in (y.min(axis=0), y.max(axis=0))]],
                                              ["interval", "uid", "weight", "v", "low", "high"])

        for batch in batches:
            while batch.num_rows:
                take = min(most - held, batch.num_rows)
                waiting.append(batch.select(["uid", "weight", "v"]).slice(0, take))
                batch, held = batch.slice(take), held + take
                if held == most:
                    yield cut()
                    waiting, held, number = [], 0, number + 1
        if waiting:
            yield cut()

    cut, _ = materialise(spark, placed.mapInArrow(
        intervals, "interval bigint, uid binary, weight binary, v binary, low array<double>, high array<double>"), "grid-intervals")
    other = cut.select(*[F.col(c).alias(f"{c}_2") for c in cut.columns])

    def beyond(low: str, high: str):
        return F.zip_with(low, high, lambda a, b: F.greatest(a - b, F.lit(0.0)))

    # apart in a dimension: one of the two is zero
    gap = F.aggregate(F.concat(beyond("low", "high_2"), beyond("low_2", "high")), F.lit(0.0), lambda s, g: s + g * g)
    near = cut.hint("shuffle_replicate_nl").join(other, (F.col("interval") <= F.col("interval_2")) & (gap <= eps * eps * (1 + 1e-6) + 1e-9))

    def meet(rows: Iterator[Row]) -> Iterator[tuple]:
        at: dict[int, np.ndarray] = {}  # an interval's vectors by their number in this task
        uids: list[np.ndarray] = []
        links, up = np.zeros(0, np.int64), []

        def top(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        def side(number: int, uid: bytes, weight: bytes, v: bytes) -> tuple:
            nonlocal links
            if number not in at:
                ids = np.frombuffer(uid, "<i8")
                at[number] = np.arange(len(up), len(up) + len(ids))
                uids.append(ids)
                up.extend(range(len(up), len(up) + len(ids)))
                links = np.concatenate([links, np.zeros(len(ids), np.int64)])
            return at[number], np.frombuffer(weight, "<i8"), unpacked([bytes(v)], kind, dims) @ axes

        before, first = None, None
        for r in rows:
            if r.interval != before:
                before, first = r.interval, side(r.interval, r.uid, r.weight, r.v)
            same = r.interval == r.interval_2
            (a, wa, x), (b, wb, y) = first, first if same else side(r.interval_2, r.uid_2, r.weight_2, r.v_2)
            for i, j in _meet(x, y, same, cosine, eps):
                np.add.at(links, a[i], wb[j])
                np.add.at(links, b[j], wa[i])
                i, j = a[i], b[j]
                # what hangs together already is passed by
                some, place = np.unique(np.concatenate([i, j]), return_inverse=True)
                roots = np.array([top(k) for k in some.tolist()])[place]
                apart = roots[:len(i)] != roots[len(i):]
                for k, m in zip(i[apart].tolist(), j[apart].tolist()):
                    k, m = top(k), top(m)
                    if k != m:
                        up[max(k, m)] = min(k, m)
        if not uids:
            return
        uid, root = np.concatenate(uids), np.array([top(k) for k in range(len(up))])
        least = np.full(len(up), np.iinfo(np.int64).max)
        np.minimum.at(least, root, uid)
        least = least[root]
        for k in np.flatnonzero(links).tolist():
            yield int(uid[k]), int(links[k]), None if least[k] == uid[k] else int(least[k])

    met = near.select("interval", "uid", "weight", "v", "interval_2", "uid_2", "weight_2", "v_2").rdd.mapPartitions(meet)
    return spark.createDataFrame(met, MET, verifySchema=False)
