"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Select columns by exact name under new names: ``pick(df, id="doc_id")``.

    Works by position, so columns that differ only in case, are repeated or
    clash with an operator's own output names do no harm; the first column of
    that name is taken. Everything else is left behind (and never read).
    """
    places = {new: df.columns.index(old) for new, old in cols.items()}
    flat = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"_{i}").alias(new) for new, i in places.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A batch's strings; null counts as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def spans(batches: Iterator[pa.RecordBatch], weight: str, most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of the column
    ``weight`` at most, so that a worker's memory follows the longest row and
    not the number of rows Arrow puts together."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(weight)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = (np.cumsum(size) - size) // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """A batch's texts cut at ASCII white space: the distinct words, the number
    of each word in turn among these, and where each text's words end (null is
    empty)."""
    parts = pc.ascii_split_whitespace(pc.fill_null(column, ""))
    ends = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    number, ends = coded.indices.to_numpy(), ends[1:] - ends[0]
    nothing = coded.dictionary.index("").as_py()  # before leading and after trailing white space
    if nothing >= 0:
        keep = number != nothing
        number, ends = number[keep], np.concatenate([[0], np.cumsum(keep)])[ends]
    return coded.dictionary, number, ends


#: Octaves of a hash: rows whose hash begins with so many zero bits.
OCTAVES = 64


def smallest(df: DataFrame, hashed: Column, k: int, group: Column | None = None) -> DataFrame:
    """The rows of ``df`` (of every ``group``) with the smallest ``hashed``
    (64-bit hashes) that are about ``k`` to 2 k: all below a power of two that
    leaves at least k. A few counts are added up; no row is sorted or moved, so
    what a driver or a task is sent stays bounded whatever the input. Rows of
    equal hash stay together: make keys distinct first. Follow with an exact limit."""
    high = F.shiftrightunsigned(hashed, 1).cast("double") / F.lit(float(1 << 63))
    octave = F.when(high <= 0, F.lit(OCTAVES - 1)).otherwise(F.least(F.floor(-F.log2(high)), F.lit(OCTAVES - 1))).cast("int")
    group = F.lit(0) if group is None else group
    counts: dict = {}
    for r in df.groupBy(group.alias("g"), octave.alias("o")).agg(F.count(F.lit(1)).alias("n")).collect():
        counts.setdefault(r.g, {})[r.o] = r.n
    chosen = F.lit(False)
    for g, of in counts.items():
        least, total = OCTAVES, 0
        while least > 0 and total < k:
            least -= 1
            total += of.get(least, 0)
        chosen = chosen | (group.eqNullSafe(F.lit(g)) & (octave >= least))
    return df.where(chosen)


class Memo(dict):
    """A dictionary that computes what it lacks. At ``bound`` entries they
    become the older generation and a new one starts; keys met again move over,
    the others go with the next turn. A worker's memory stays bounded whatever
    the vocabulary, and common keys are computed once."""

    def __init__(self, compute, bound: int = 200_000):
        super().__init__()
        self.compute, self.bound, self.older = compute, bound, {}

    def __missing__(self, key):
        if len(self) >= self.bound:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value
