"""Packing token ids into fixed windows: concatenate and cut.

Pass one encodes every text and writes its ids with the offset inside its
partition. The partitions' totals (one row each) are summed up in order, which
gives every document its global offset. Pass two cuts at the multiples of the
window: a piece is what a document has inside one window, and a document that
crosses a window's end leaves a boundary record, its next piece, in the next.
Nothing is padded but the end of the last window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ventana.llm.bpe import BATCH_CHARS, read_vocabulary
from ventana.llm.common import pick, spans, split_words
from ventana.llm.word_bpe import WordIds
from ventana.session import materialise

#: Ids in one stored row: a longer document is stored in several, each cut apart.
SEGMENT = 1 << 16
END_ID = 1


class WordEncoder:
    """Ids of whole texts, made once per distinct word of a batch.

    The vocabulary's normaliser turns white space into spaces, its
    pre-tokeniser drops them and no match holds any, so a text's ids are those
    of its parts between white space, one after another. Arrow splits a batch
    and numbers its distinct parts; a gather by number lays out the ids.
    """

    def __init__(self, data: bytes, end_id: int = END_ID):
        self.words = WordIds(data)
        self.end = np.array([end_id], dtype="<u4").tobytes()

    def encode(self, column: pa.Array) -> tuple[np.ndarray, pa.Buffer]:
        """(bytes of ids per text, all ids one text after another): each text's ids and the end id; null is empty."""
        words, number, ends = split_words(column)
        ids, place = self.words.table(words)
        table = pa.concat_arrays([ids, pa.array([self.end], pa.large_binary())])
        taken = table.take(pa.array(np.insert(place[number], ends, len(ids))))
        at = np.frombuffer(taken.buffers()[1], dtype=np.int64)
        return np.diff(at[ends + np.arange(1, len(ends) + 1)], prepend=0), taken.buffers()[2]


_MADE: dict[tuple[int, int], WordEncoder] = {}


def encode(spark: SparkSession, docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
           text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Pass one: rows ``part, doc_id, doc_start, doc_tokens, at, n, ids`` with
    the ids of a document and ``end_id`` (packed little-endian unsigned 32-bit);
    ``at`` is the offset in the partition ``part``."""
    model = spark.sparkContext.broadcast(read_vocabulary(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (hash(model.value), end_id)
        if key not in _MADE:
            _MADE[key] = WordEncoder(model.value, end_id)
        part, at = TaskContext.get().partitionId(), 0
        for batch in spans(batches, "text", BATCH_CHARS):
            size, ids = _MADE[key].encode(batch.column("text"))
            total = size // 4
            rows = -(-total // SEGMENT)
            doc = np.repeat(np.arange(len(total)), rows)
            start = (np.arange(len(doc)) - (np.cumsum(rows) - rows)[doc]) * SEGMENT
            n = np.minimum(SEGMENT, total[doc] - start)
            first = np.cumsum(n) - n
            # rows in record batches of bounded bytes; their ids lie side by side
            group = first // (1 << 24)
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(doc)]
            for a, b in zip(cuts, cuts[1:]):
                if b == a:
                    continue
                begin = int(first[a])
                places = (4 * (np.append(first[a:b], first[b - 1] + n[b - 1]) - begin)).astype(np.int32)
                stored = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(places), ids.slice(4 * begin)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(b - a, part, np.int32)), batch.column("doc_id").take(pa.array(doc[a:b])), pa.array(start[a:b]),
                     pa.array(total[doc[a:b]]), pa.array(at + first[a:b]), pa.array(n[a:b]), stored],
                    ["part", "doc_id", "doc_start", "doc_tokens", "at", "n", "ids"])
            at += int(total.sum())

    src = pick(docs, doc_id=id_col, text=text_col)
    return src.mapInArrow(run, f"part int, doc_id {src.schema['doc_id'].dataType.simpleString()}, doc_start bigint, "
                               "doc_tokens bigint, at bigint, n bigint, ids binary")


def pack(spark: SparkSession, docs: DataFrame, tokenizer_path: str, window: int = 2048,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens, sequence_id, offset``: a row
    per piece, in windows of ``window`` ids that are full but for the last.

    A null or empty text is its end id alone; repeated rows and null doc_ids
    are packed like any others; an empty table gives an empty one; a text of
    any length is cut; other columns are not looked at. The ids are written to
    the shared folder once, so no text is encoded twice.
    """
    stored, _ = materialise(spark, encode(spark, docs, tokenizer_path, id_col, text_col), "packing-ids")
    totals = stored.groupBy("part").agg(F.sum("n").alias("n"))
    # one row per partition of pass one
    base = totals.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    whole = stored.join(F.broadcast(base), "part").withColumn("g", F.col("base") + F.col("at"))
    size = F.lit(window)
    cut = whole.withColumn("sequence_id", F.explode(F.sequence(
        F.floor(F.col("g") / size), F.floor((F.col("g") + F.col("n") - 1) / size))))
    cut = cut.withColumn("a", F.greatest(F.col("g"), F.col("sequence_id") * size)).withColumn(
        "length", F.least(F.col("g") + F.col("n"), (F.col("sequence_id") + 1) * size) - F.col("a"))
    return cut.select(
        "doc_id", (F.col("doc_start") + F.col("a") - F.col("g")).alias("start"), "length",
        F.expr("substring(ids, cast((a - g) * 4 + 1 as int), cast(length * 4 as int))").alias("ids"),
        "doc_tokens", "sequence_id", (F.col("a") - F.col("sequence_id") * size).alias("offset"))
