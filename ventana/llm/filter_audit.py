"""How filters interact: what each removes in every order, by decision diagrams.

Documents become failure masks, one bit a filter, and masks are counted per
part in Spark; no order needs the documents again. Per part a count-weighted
decision diagram is built over the masks: a level per filter, a node per
distinct function of the filters below (equal ones are shared), a leaf per
distinct vector of counts, and in every node the counts of all it leads to.
The path that passes every filter carries what is left after each of them, and
its fail edges what each removes. An order is the order of the levels: all
orders are visited by swaps of two neighbouring levels, each of which rebuilds
the nodes of the upper one and leaves the rest alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ventana.llm.bpe import BATCH_CHARS
from ventana.llm.common import pick, spans, texts
from ventana.session import materialise

#: A filter of a text: its words, its whole UTF-8 form, its code points -> whether the text fails.
Failure = Callable[[list[bytes], bytes, int], bool]
UPPER = bytes(range(65, 91))
MARKS = re.compile(rb"[#$%&*|]")

#: The conditions on one text, by letter. Words are what stands between ASCII white space.
FAILURES: dict[str, Failure] = {
    "A": lambda words, raw, points: len(words) < 200,
    "B": lambda words, raw, points: 100 * len(set(words)) < 50 * len(words),
    "C": lambda words, raw, points: 100 * (len(raw) - len(raw.translate(None, UPPER))) > 3 * points,
    "D": lambda words, raw, points: MARKS.search(raw) is not None,
}
#: The condition on the whole table: a row of smaller id has the same text.
COPY = "E"


def masks(docs: DataFrame, labels: DataFrame, failures: dict[str, Failure] = FAILURES, id_col: str = "doc_id",
          text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part, mask, good, toxic, n``: rows by part, failure mask (bit k: the
    k-th of ``failures``; the bit after them: COPY) and the labels quality = 1
    and toxic = 1 of their id.

    Null parts are the empty string, null texts the empty text. A row with a
    null id is labelled by nothing and fails COPY never. Repeated rows count
    each; they are no copies of each other, nor are rows of one id. An id with
    several rows of labels has each label that any of them gives.

    Texts are read once, and only their digests go on. Rows are added up by
    id, digest and part before the labels join, and by digest and part before
    the smallest id of a text is found, so a text, an id or a repeated row
    that holds a large share of the table is added up where it is read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256
        checks = list(failures.values())
        for batch in spans(batches, "text", BATCH_CHARS):
            out, keys = [], []
            for t in texts(batch):
                raw = t.encode("utf-8", "surrogatepass")
                words = raw.split()  # bytes: space and 9 to 13 alone
                out.append(sum(1 << k for k, fails in enumerate(checks) if fails(words, raw, len(t))))
                keys.append(sha256(raw).digest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(keys, pa.binary()), pa.array(out, pa.int32())],
                                             ["doc_id", "part", "text_key", "mask"])

    src = pick(docs, doc_id=id_col, part=part_col, text=text_col).withColumn("part", F.coalesce(F.col("part").cast("string"), F.lit("")))
    kind = src.schema["doc_id"].dataType.simpleString()
    rows = (src.mapInArrow(run, f"doc_id {kind}, part string, text_key binary, mask int")
            .groupBy("doc_id", "text_key", "part", "mask").agg(F.count(F.lit(1)).alias("n")))
    # read twice below, without the texts
    rows, _ = materialise(docs.sparkSession, rows, "audit-masks")
    known = (pick(labels, label_id=id_col, quality="quality", toxic="toxic").where(F.col("label_id").isNotNull())
             .groupBy("label_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
                                      F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")))
    joined = rows.where("doc_id is not null").join(known, F.col("doc_id") == F.col("label_id"), "left").select(
        "doc_id", "text_key", "part", "mask", "n", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    # rows without an id meet nobody in the join: they would all wait in one task
    nameless = rows.where("doc_id is null").select("doc_id", "text_key", "part", "mask", "n", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    by_text = joined.unionByName(nameless).groupBy("text_key", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
    # of a text as many rows as parts and labels
    least = F.min("first.doc_id").over(Window.partitionBy("text_key"))
    passing = F.col("nameless") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = by_text.withColumn("least", least).select(
        "part", "mask", "good", "toxic", F.explode(F.array(
            F.struct(F.lit(0).alias("copy"), passing.alias("n")),
            F.struct(F.lit(1 << len(failures)).alias("copy"), (F.col("n") - passing).alias("n")))).alias("x"))
    return (split.where("x.n > 0").groupBy("part", (F.col("mask") + F.col("x.copy")).alias("mask"), "good", "toxic")
            .agg(F.sum("x.n").alias("n")))


# ---------------------------------------------------------------- the diagram

Counts = tuple[int, ...]


class Diagram:
    """A count-weighted decision diagram of masks. Level k tests the filter
    ``order[k]``; a node is (passing child, failing child), children being
    numbers of nodes of the next level, the last level's those of leaves."""

    def __init__(self, counts: dict[int, Counts], filters: int, width: int):
        self.order = list(range(filters))
        self.zero: Counts = (0,) * width
        #: per level the nodes' children, their counts, and the node of given children
        self.nodes: list[list[tuple[int, int]]] = [[] for _ in self.order]
        self.unique: list[dict] = [{} for _ in range(filters + 1)]
        self.sums: list[list[Counts]] = [[] for _ in range(filters + 1)]
        self.root = self._build(0, counts)

    def leaf(self, counts: Counts) -> int:
        table = self.unique[-1]
        if counts not in table:
            table[counts] = len(self.sums[-1])
            self.sums[-1].append(counts)
        return table[counts]

    def node(self, level: int, passing: int, failing: int) -> int:
        table, key = self.unique[level], (passing, failing)
        if key not in table:
            table[key] = len(self.nodes[level])
            self.nodes[level].append(key)
            below = self.sums[level + 1]
            self.sums[level].append(tuple(a + b for a, b in zip(below[passing], below[failing])))
        return table[key]

    def _build(self, level: int, counts: dict[int, Counts]) -> int:
        if level == len(self.order):
            return self.leaf(next(iter(counts.values()), self.zero))
        bit = 1 << self.order[level]
        return self.node(level, self._build(level + 1, {m: c for m, c in counts.items() if not m & bit}),
                         self._build(level + 1, {m: c for m, c in counts.items() if m & bit}))

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next: a node ((pp, pf),
        (fp, ff)) becomes ((pp, fp), (pf, ff)). Nodes of ``level`` keep their
        numbers and their counts, so nothing above changes; nodes of the next
        level are made anew, nothing below changes."""
        upper, lower = self.nodes[level], self.nodes[level + 1]
        self.nodes[level + 1], self.unique[level + 1], self.sums[level + 1] = [], {}, []
        for n, (p, f) in enumerate(upper):
            (pp, pf), (fp, ff) = lower[p], lower[f]
            upper[n] = (self.node(level + 1, pp, fp), self.node(level + 1, pf, ff))
        self.unique[level] = {children: n for n, children in enumerate(upper)}
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, Counts, Counts]]:
        """(filter, counts left after it, counts it removes) along the path that passes every filter."""
        at = self.root
        for level, f in enumerate(self.order):
            passing, failing = self.nodes[level][at]
            yield f, self.sums[level + 1][passing], self.sums[level + 1][failing]
            at = passing


def orders(n: int) -> Iterator[int]:
    """Swaps of neighbours (the place of the left one) that lead through all
    orders of n things, each met once: the largest thing that can move moves."""
    place = list(range(n))            # thing at each place
    way = [-1] * n
    while True:
        movable = [(x, i) for i, x in enumerate(place) if 0 <= i + way[x] < n and place[i + way[x]] < x]
        if not movable:
            return
        x, i = max(movable)
        j = i + way[x]
        place[i], place[j] = place[j], place[i]
        for y in range(x + 1, n):
            way[y] = -way[y]
        yield min(i, j)


def walk(counts: dict[int, Counts], names: str) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley) of every order and step; counts are (rows, good, toxic) by mask."""
    diagram = Diagram(counts, len(names), 3)
    fails = [sum(c[0] for m, c in counts.items() if m >> k & 1) for k in range(len(names))]
    alone = [counts.get(1 << k, diagram.zero)[0] for k in range(len(names))]
    shares = [0] * len(names)
    found = []

    def read() -> None:
        name = "".join(names[k] for k in diagram.order)
        for step, (k, kept, gone) in enumerate(diagram.steps(), 1):
            shares[k] += gone[0]
            found.append((name, step, kept[0], gone[0], fails[k] - gone[0], alone[k], gone[1], gone[2], k))

    read()
    for place in orders(len(names)):
        diagram.swap(place)
        read()
    return [(*row[:-1], shares[row[-1]]) for row in found]


COLUMNS = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit(counted: DataFrame, names: str) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley``: a row per part, order of the filters
    ``names`` and step, from what :func:`masks` returns (at most 2 ** filters
    x 4 rows a part). All orders are visited: their number grows with the
    factorial of the filters, so more than eight are refused. An empty table
    has no parts and gives an empty one."""
    if len(names) > 8:
        raise ValueError("every order is visited: at most 8 filters")

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        counts: dict[int, Counts] = {}
        for mask, good, toxic, n in zip(rows["mask"], rows["good"], rows["toxic"], rows["n"]):
            old = counts.get(int(mask), (0, 0, 0))
            counts[int(mask)] = (old[0] + int(n), old[1] + int(n) * bool(good), old[2] + int(n) * bool(toxic))
        out = pd.DataFrame(walk(counts, names), columns=COLUMNS)
        out.insert(0, "part", key[0])
        return out.astype({"step": np.int32})

    kinds = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COLUMNS[2:])
    return counted.groupBy("part").applyInPandas(run, kinds)
