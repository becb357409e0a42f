"""Jaccard self-join on word shingles with Bayesian candidate pruning.

1. Each text becomes a set of shingle hashes; equal sets are one class, with a
   weight. A class has a signature of 240 one-byte MinHash values.
2. Classes that agree in one of 40 bands of six values share a bucket, named
   by its smallest class. The distinct names a class got (at most 40) are the
   meetings it takes part in, so two classes meet however many bands they
   share, and the bucket that owns their pair is the smallest name they have
   in common.
3. In a meeting signatures are compared 16 values at a time. With m of n
   values equal and a uniform prior on the chance of a match, a pair is dropped
   once the posterior probability that its similarity reaches the threshold
   falls below ``TOLERANCE``. What is left is verified on the whole sets.
4. A meeting with many or long members is dealt out as pairs of blocks. It
   returns a count and a root per class and never the pairs.

A pair of similarity exactly 0.8 shares no band with probability
(1 - 0.8**6)**40 = 5e-6, and less above it.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventana.llm.bpe import BATCH_CHARS
from ventana.llm.common import pick, spans, texts
from ventana.llm.graph import components, spanning
from ventana.llm.shingles import MinHash, Shingler
from ventana.session import materialise

BANDS, ROWS, LOOK = 40, 6, 16
VALUES = BANDS * ROWS
TOLERANCE = 1e-6
#: A block of a meeting holds about so many classes, and so many shingles, at most.
BLOCK_CLASSES, BLOCK_SHINGLES = 1024, 1_000_000
#: A class of more than 1 / HOT of all rows is hot.
HOT, SALTS = 4096, 64


def needed(threshold: float) -> list[int]:
    """Per look the fewest equal values with which a pair goes on.

    A value is equal with chance q = s + (1 - s) / 256 at similarity s. With a
    uniform prior on q, P(q >= q0 | m of n equal) is the upper tail of
    Beta(m + 1, n - m + 1), which is P(Binomial(n + 1, q0) <= m)."""
    q0 = threshold + (1 - threshold) / 256
    out = []
    for n in range(LOOK, VALUES + 1, LOOK):
        tail, m = 0.0, -1
        while m < n:
            more = tail + comb(n + 1, m + 1) * q0 ** (m + 1) * (1 - q0) ** (n - m)
            if more >= TOLERANCE:
                break
            tail, m = more, m + 1
        out.append(m + 1)
    return out


def vertex(shingles: np.ndarray) -> int:
    """A class's 64-bit name: of its whole shingle set (order does not matter)."""
    with np.errstate(over="ignore"):
        a = int(np.bitwise_xor.reduce(shingles * np.uint64(0xD6E8FEB86659FD93)))
        b = int(np.add.reduce(shingles ^ (shingles >> np.uint64(29)), dtype=np.uint64))
    value = (a * 0x9E3779B97F4A7C15 ^ b * 0xC2B2AE3D27D4EB4F ^ len(shingles)) & ((1 << 64) - 1)
    value ^= value >> 31
    return value - (1 << 64) if value >= 1 << 63 else value


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, text_key, class, size, signature`` per row; a text without a
    word is of the class of its own hash and has no signature, null has no class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, minhash = Shingler(words), MinHash(VALUES)
        for batch in spans(batches, "text", BATCH_CHARS // 2):
            sets = [shingle(t) for t in texts(batch)]
            keys = [None if null else k for null, k in zip(batch.column("text").is_null().to_pylist(), batch.column("text_key").to_pylist())]
            full = [s for s in sets if len(s)]
            sig = iter(minhash(full) if full else ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array([vertex(s) if len(s) else k for s, k in zip(sets, keys)], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array([next(sig).tobytes() if len(s) else None for s in sets], pa.binary())],
                ["doc_id", "text_key", "class", "size", "signature"])

    src = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return src.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_key bigint, class bigint, size bigint, signature binary")


def sets_of(docs: DataFrame, words: int) -> DataFrame:
    """``class, shingles``: the whole sets of the given rows, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)
        for batch in spans(batches, "text", BATCH_CHARS // 2):
            sets = [shingle(t) for t in texts(batch)]
            sets = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([vertex(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             ["class", "shingles"])

    return docs.select("text").mapInArrow(run, "class bigint, shingles binary")


def compare(rows: pd.DataFrame, rep: int, first: int, second: int, threshold: float, least: list[int]) -> pd.DataFrame:
    """One meeting (or a pair of its blocks): links and a root per class."""
    rows = rows.sort_values(["block", "class"], ignore_index=True)
    n = len(rows)
    split = int((rows["block"] == first).sum()) if first != second else 0
    sig = np.frombuffer(b"".join(rows["signature"]), dtype=np.uint8).reshape(n, VALUES)
    sets = [np.frombuffer(b, dtype=np.uint64) for b in rows["shingles"]]
    size = np.array([len(s) for s in sets])
    weight = rows["weight"].to_numpy()
    names = [set(x) for x in rows["reps"]]
    ids, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    local = np.split(inverse, np.cumsum(size)[:-1])
    mark = np.zeros(len(ids), dtype=np.int64)
    links, pairs = np.zeros(n, dtype=np.int64), []
    for i in range(split if first != second else n):
        at = np.arange(max(i + 1, split), n)
        at = at[np.minimum(size[at], size[i]) >= threshold * np.maximum(size[at], size[i]) - 1e-9]
        same = np.zeros(len(at), dtype=np.int64)
        for look, fewest in enumerate(least):
            if not len(at):
                break
            part = slice(look * LOOK, (look + 1) * LOOK)
            same += (sig[at, part] == sig[i, part]).sum(axis=1)
            stay = same >= fewest
            at, same = at[stay], same[stay]
        # the meeting of the smallest common name owns the pair
        at = np.array([j for j in at if min(names[i] & names[j]) == rep], dtype=np.int64)
        if not len(at):
            continue
        mark[local[i]] = 1
        flat = np.concatenate([local[j] for j in at])
        common = np.add.reduceat(mark[flat], np.cumsum(size[at]) - size[at])
        mark[local[i]] = 0
        near = at[common >= threshold * (size[at] + size[i] - common) - 1e-9]
        links[i] += weight[near].sum()
        links[near] += weight[i]
        pairs += [(i, int(j)) for j in near]
    name = rows["class"].to_numpy()
    rank = np.argsort(np.argsort(name))
    order = np.sort(name)
    root = {int(order[a]): int(order[b]) for a, b in spanning(n, [(int(rank[i]), int(rank[j])) for i, j in pairs])}
    out = [(int(c), int(k), root.get(int(c))) for c, k in zip(name, links) if k]
    return pd.DataFrame({"class": pd.Series([r[0] for r in out], dtype="int64"), "links": pd.Series([r[1] for r in out], dtype="int64"),
                         "root": pd.Series([r[2] for r in out], dtype="Int64")})


def join(spark: SparkSession, docs: DataFrame, threshold: float = 0.8, words: int = 5,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_key, class_id, n_links, root`` for every row.

    ``n_links``: other rows whose shingle sets have a Jaccard similarity of at
    least ``threshold`` (copies included); ``class_id``: the smallest doc_id
    reachable by links, itself included; ``text_key``: the text's hash;
    ``root``: the same for all rows that links connect, null without a class.

    Words are lower-cased ``\\w+``; a text of fewer than ``words`` words is one
    shingle. A text without a word (empty, marks only) links with the texts
    equal to it and no others; null links with nothing and is its own class.
    Repeated rows are copies of each other. Null doc_ids are passed by in
    minima (a class of null ids alone has a null id). An empty table gives an
    empty one; other columns are not looked at.
    """
    src = pick(docs, doc_id=id_col, text=text_col)
    rows, _ = materialise(spark, signatures(src, words), "ngram-signatures")
    classes = rows.where("class is not null").groupBy("class").agg(
        F.count(F.lit(1)).alias("weight"), F.min("doc_id").alias("least"), F.first("size").alias("size"),
        F.first("signature").alias("signature"), F.min(F.struct("doc_id", "text_key")).alias("one"))
    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1)))
    bands = (classes.where("signature is not null").select("class", "signature", band.alias("band"))
             .select("class", F.xxhash64("band", F.expr(f"substring(signature, band * {ROWS} + 1, {ROWS})")).alias("bucket")))
    buckets = bands.groupBy("bucket").agg(F.min("class").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # at most BANDS names per class
    met = bands.join(buckets, "bucket").groupBy("class").agg(F.collect_set("rep").alias("reps"))
    met, _ = materialise(spark, met.join(classes.select("class", "weight", "size", "signature", "one").hint("merge"), "class"), "ngram-met")

    # whole sets of the classes that meet anyone: one text each
    one = met.select(F.col("one.doc_id").alias("one_id"), F.col("one.text_key").alias("one_key"))
    # every text is read and dealt out here: one plan at every size, as for the joins below
    chosen = src.withColumn("text_key", F.xxhash64("text")).join(
        one.hint("merge"), F.col("doc_id").eqNullSafe(F.col("one_id")) & (F.col("text_key") == F.col("one_key")), "left_semi")
    sets = sets_of(chosen, words).dropDuplicates(["class"])

    named = met.select("class", "size", "reps", F.explode("reps").alias("rep"))
    sizes = named.groupBy("rep").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_CLASSES), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    # a meeting of several blocks may be a hot key: its classes meet its block count in SALTS tasks
    large = sizes.select("rep", blocks.alias("blocks")).where("blocks > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = named.withColumn("salt", F.pmod(F.xxhash64("class"), F.lit(SALTS)).cast("int")).join(large, ["rep", "salt"], "left").withColumn(
        "blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    jobs = dealt.select("class", "reps", "rep", "block", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"))
    whole = met.select("class", "weight", "signature").join(sets, "class")
    least = needed(threshold)

    def meet(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return compare(group, key[0], key[1], key[2], threshold, least)

    # both sides grow with the data: one plan at every size
    found = jobs.join(whole.hint("merge"), "class").groupBy("rep", "first", "second").applyInPandas(meet, "class bigint, links bigint, root bigint")
    found, _ = materialise(spark, found, "ngram-links")
    roots = components(spark, found.where("root is not null").select("class", "root")).select(F.col("node").alias("class"), "root")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    named = (classes.select("class", "weight", "least").join(links, "class", "left").join(roots, "class", "left")
             .select("class", "least", "weight", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "class").alias("root")))
    # a hot component is one group of a minimum, which is added up before the shuffle
    ids = named.groupBy("root").agg(F.min("least").alias("class_id"))
    named, _ = materialise(spark, named.join(ids, "root").select("class", "class_id", "n_links", "root", "weight"), "ngram-classes")
    # fewer than HOT classes hold more than 1 / HOT of the rows each: their rows stay where they are
    whole = rows.count()
    hot = F.broadcast(named.where(F.col("weight") > whole / HOT))
    keyed = rows.where("class is not null").select("doc_id", "text_key", "class")
    out = keyed.join(hot, "class").unionByName(keyed.join(hot.select("class"), "class", "left_anti").join(named, "class"))
    alone = rows.where("class is null").select("doc_id", "text_key", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
                                               F.lit(None).cast("long").alias("root"))
    return out.select("doc_id", "text_key", "class_id", "n_links", "root").unionByName(alone)
