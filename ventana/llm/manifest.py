"""A Merkle manifest of a dataset, by time-forward processing.

Every row is a leaf digest. The leaves of a group (a source), in order, are
the first level of a tree of fan-out three, whose last node is the group's
root; the groups' roots, in order, are the leaves of one tree more.

A tree is a graph of nodes with labels in topological order. Time-forward
processing visits them by label: a priority queue ordered by label holds the
digests that children have sent, a node takes its own out, hashes them and
sends the result on. The reversed sweep visits labels from the root down: a
node's proof suffix (the siblings met on the way to the root) goes to each of
its children with the child's own siblings in front.

The queue lies outside any one task's memory: levels are cut into slabs of a
fixed number of levels (``SLAB``), a slab's nodes into blocks of ``3 ** SLAB``
nodes each, which are whole subtrees. What passes from block to block is written to the shared
folder and dealt by Spark's sorted shuffle; what stays within a block passes
through a heap of at most 1.5 x 3 ** SLAB messages. A group of any size is as
many blocks as it needs, and the number of slabs is the logarithm of the
largest group. Only sizes of slabs and the number of them come to the driver.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ventana.functions.ordering import CHUNK, POS, ordered_chunks
from ventana.llm.common import pick
from ventana.session import materialise

FANOUT, SLAB = 3, 7
#: The columns that a leaf's digest covers, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- one block

class Block:
    """The nodes of one block: ``count`` items and ``levels`` levels above
    them. Labels run level by level, from the items to the block's top."""

    def __init__(self, items: list[str], levels: int):
        self.size = [len(items)]
        for _ in range(levels):
            self.size.append(-(-self.size[-1] // FANOUT))
        self.first = [sum(self.size[:k]) for k in range(len(self.size) + 1)]
        self.items, self.levels = items, levels

    def parent(self, label: int, k: int) -> int:
        return self.first[k + 1] + (label - self.first[k]) // FANOUT

    def forward(self) -> str:
        """All nodes by label: digests go to parents through the queue. The top's digest."""
        self.digests: list[str] = []
        queue: list[tuple[int, int, str]] = []  # (label of the receiver, of the sender, digest)
        k = 0
        for label in range(self.first[-1]):
            k += label >= self.first[k + 1]
            if k == 0:
                own = self.items[label]
            else:
                parts = []
                while queue and queue[0][0] == label:
                    parts.append(heapq.heappop(queue)[2])
                own = digest("".join(parts))
            self.digests.append(own)
            if k < self.levels:
                heapq.heappush(queue, (self.parent(label, k), label, own))
        return self.digests[-1]

    def backward(self, suffix: str) -> list[str]:
        """All nodes by falling label: proof suffixes go to children through the queue. The items' proofs."""
        queue: list[tuple[int, str]] = [(1 - self.first[-1], suffix)]
        proofs, k = [""] * len(self.items), self.levels
        for label in range(self.first[-1] - 1, -1, -1):
            k -= label < self.first[k]
            own = heapq.heappop(queue)[1]
            if k == 0:
                proofs[label] = own
                continue
            a = self.first[k - 1] + FANOUT * (label - self.first[k])
            children = range(a, min(a + FANOUT, self.first[k]))
            for c in children:
                heapq.heappush(queue, (-c, "".join(self.digests[s] for s in children if s != c) + own))
        return proofs


def levels_of(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    k = 0
    while n > 1:
        n, k = -(-n // FANOUT), k + 1
    return k


def slab_levels(n: int, slab: int) -> int:
    """Levels that a block rises where its tree has ``n`` nodes: all that are left, if the tree is one block."""
    return slab if n > FANOUT ** slab else levels_of(n)


# ---------------------------------------------------------------- the forest

def climb(spark: SparkSession, items: DataFrame, slab: int, name: str) -> tuple[DataFrame, list[DataFrame]]:
    """``tree, digest`` of every tree's root, and the layers that lead there.
    ``items``: ``tree, n`` (the tree's leaves), ``place`` (from 0), ``digest``."""
    layers, roots, layer, size = [], None, items.select("tree", "n", "place", "digest"), FANOUT ** slab

    def up(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        n = int(rows["n"].iloc[0])
        top = Block(rows["digest"].tolist(), slab_levels(n, slab)).forward()
        return pd.DataFrame({"tree": [key[0]], "n": [-(-n // size)], "place": [key[1]], "digest": [top]})

    while True:
        layers.append(layer)
        block = F.floor(F.col("place") / size).cast("long").alias("block")
        layer, _ = materialise(spark, layer.groupBy("tree", block).applyInPandas(up, "tree string, n long, place long, digest string"),
                               f"{name}-layer")
        done = layer.where("n = 1").select("tree", "digest")
        roots = done if roots is None else roots.unionByName(done)
        layer = layer.where("n > 1")
        if layer.isEmpty():
            return roots, layers


def descend(spark: SparkSession, layers: list[DataFrame], above: DataFrame, leaves: DataFrame, carried: list[str], slab: int, name: str) -> DataFrame:
    """The reversed sweep: ``leaves`` (the first layer's rows with more
    columns) with their ``proof`` and, from ``above`` (``tree, suffix`` and the
    columns ``carried``, a row per tree), those columns."""
    size, spec = FANOUT ** slab, above.select("tree", *carried).schema
    more = "".join(f", {f.name} {f.dataType.simpleString()}" for f in spec.fields[1:])

    def down(key: tuple, rows: pd.DataFrame, top: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return rows.assign(**{c: None for c in ["proof", *carried]})
        rows = rows.sort_values("place")
        block = Block(rows["digest"].tolist(), slab_levels(int(rows["n"].iloc[0]), slab))
        block.forward()
        rows = rows.assign(proof=block.backward(top["suffix"].iloc[0]))
        return rows.assign(**{c: [top[c].iloc[0]] * len(rows) for c in carried})

    place = F.floor(F.col("place") / size).cast("long")
    waiting = None  # proofs of the layer above, which are the suffixes of this one's blocks
    for k in range(len(layers) - 1, -1, -1):
        rows = leaves if k == 0 else layers[k]
        # a tree's topmost block gets its suffix from `above`, the others from the layer above
        top = above.join(rows.where(f"place = 0 and n <= {size}").select("tree"), "tree", "left_semi").select(
            "tree", F.lit(0).cast("long").alias("block"), "suffix", *carried)
        if waiting is not None:
            top = top.unionByName(waiting.select("tree", F.col("place").alias("block"), F.col("proof").alias("suffix"), *carried))
        top = top.select(*[F.col(c).alias(c) for c in top.columns])  # columns of its own: both sides may come from one layer
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
        waiting = (rows.withColumn("block", place).groupBy("tree", "block").cogroup(top.groupBy("tree", "block"))
                   .applyInPandas(lambda key, a, b: down(key, a.drop(columns="block"), b), f"{kinds}, proof string{more}"))
        if k:
            waiting, _ = materialise(spark, waiting, f"{name}-proofs")
    return waiting


def encoded(c: Column) -> Column:
    """A field as its digest covers it: ``-``, or UTF-8 byte count, ``:``, value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in fields]).cast("binary"), 256)


def numbered(df: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``place`` in the tree's order, from 0, and ``n``, the tree's rows. Rows
    are dealt by ranges of (tree, order, row hash): a tree that holds a large
    share of all rows lies in many ranges. Offsets are counted per range and
    tree."""
    dealt = ordered_chunks(df, order, [tree])
    counts = dealt.groupBy(CHUNK, tree).agg(F.count(F.lit(1)).alias("rows"), F.min(POS).alias("begin"))
    before = Window.partitionBy(tree).orderBy(CHUNK)
    offsets = counts.select(CHUNK, tree, (F.coalesce(F.sum("rows").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("begin")).alias("shift"),
                            F.sum("rows").over(Window.partitionBy(tree)).alias("n"))
    return dealt.join(offsets, [CHUNK, tree]).withColumn("place", F.col("shift") + F.col(POS)).select(*df.columns, "n", "place")


def manifest(spark: SparkSession, docs: DataFrame, tamper: Callable[[Column, Column], Column] | None = None, fields: tuple[str, ...] = FIELDS,
             id_col: str = "doc_id", group_col: str = "source", text_col: str = "text", slab: int = SLAB) -> DataFrame:
    """``doc_id, source, leaf, tampered_leaf, place, n, subroot, source_place,
    n_sources, root, proof``: every row's leaf digest, its place among the
    ``n`` leaves of its group, the group's root, that one's place among the
    ``n_sources`` groups, the manifest's root, and the proof: the digests of
    the siblings level by level to the root, left to right, as one string.
    ``tampered_leaf`` is the digest of the row with ``tamper`` (of the id and
    the text) as its text; null where that is the same text.

    Groups are ordered by UTF-8 bytes, null first; leaves by id (null first),
    rows of one id by their digests, so repeated rows are leaves each. Null
    and empty values have different digests. An empty table has no root and
    gives no rows. Texts of any length are hashed where they are read and go no
    further; other columns are not looked at.
    """
    names = list(dict.fromkeys((id_col, group_col, text_col, *fields)))
    src = pick(docs, **{f"f{i}": c for i, c in enumerate(names)})
    at = {c: F.col(f"f{i}") for i, c in enumerate(names)}
    own, changed = leaf([at[c] for c in fields]), F.lit(None).cast("string")
    if tamper is not None:
        other = tamper(at[id_col], at[text_col])
        changed = F.when(~other.eqNullSafe(at[text_col]), leaf([other if c == text_col else at[c] for c in fields]))
    # a string that keeps null apart and before everything else
    tree = F.when(at[group_col].isNull(), F.lit("")).otherwise(F.concat(F.lit(":"), at[group_col].cast("string")))
    rows = src.select(tree.alias("tree"), at[id_col].alias("doc_id"), own.alias("digest"), changed.alias("tampered_leaf"))
    rows, _ = materialise(spark, rows, "manifest-digests")  # ranges are drawn from a sample: the texts are read once all the same
    leaves, _ = materialise(spark, numbered(rows, "tree", ["doc_id", "digest"]), "manifest-leaves")
    subroots, layers = climb(spark, leaves, slab, "manifest")
    subroots, _ = materialise(spark, subroots.select(F.lit("").alias("all"), F.col("tree").alias("name"), "digest"), "manifest-subroots")
    tops = numbered(subroots, "all", ["name"]).select(F.col("all").alias("tree"), "n", "place", "digest", "name")
    tops, _ = materialise(spark, tops, "manifest-tops")
    root, top_layers = climb(spark, tops, slab, "manifest-top")
    above = root.select("tree", F.lit("").alias("suffix"), F.col("digest").alias("root"))
    sources = descend(spark, top_layers, above, tops, ["root"], slab, "manifest-top")
    sources = sources.select(F.col("name").alias("tree"), F.col("proof").alias("suffix"), F.col("digest").alias("subroot"),
                             F.col("place").alias("source_place"), F.col("n").alias("n_sources"), "root")
    sources, _ = materialise(spark, sources, "manifest-sources")
    out = descend(spark, layers, sources, leaves, ["subroot", "source_place", "n_sources", "root"], slab, "manifest")
    return out.select("doc_id", F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias("source"), F.col("digest").alias("leaf"),
                      "tampered_leaf", "place", "n", "subroot", "source_place", "n_sources", "root", "proof")


def folded(start: Column, proof: Column, places: list[tuple[Column, Column]]) -> Column:
    """The root that a leaf and its proof lead to: from ``start``, level by
    level, the digest of the run with the siblings of the proof around it.
    ``places``: (place, nodes) in the leaf's tree, then in the tree above it."""
    at, done = start, F.lit(1)
    for place, n in places:
        begin = F.struct(at.alias("own"), place.cast("long").alias("place"), n.cast("long").alias("n"), done.cast("int").alias("at"))
        # one more than the logarithm says, against rounding: a step with one node left changes nothing
        levels = F.sequence(F.lit(1), (F.ceil(F.log(float(FANOUT), n)) + 1).cast("int"))

        def step(acc: Column, _: Column) -> Column:
            left = (acc["place"] % FANOUT).cast("int") * 64
            run = F.least(F.lit(FANOUT).cast("long"), acc["n"] - (acc["place"] - acc["place"] % FANOUT))
            right = (run.cast("int") - 1) * 64 - left
            up = F.sha2(F.concat(F.substring(proof, acc["at"], left), acc["own"], F.substring(proof, acc["at"] + left, right)).cast("binary"), 256)
            risen = F.struct(up.alias("own"), F.floor(acc["place"] / FANOUT).cast("long").alias("place"),
                             F.floor((acc["n"] + FANOUT - 1) / FANOUT).cast("long").alias("n"), (acc["at"] + left + right).alias("at"))
            return F.when(acc["n"] > 1, risen).otherwise(acc)

        whole = F.aggregate(levels, begin, step)
        at, done = whole["own"], whole["at"]
    return at
