"""Document quality by supervised subword embeddings.

A word (a run without ASCII white space, case and marks kept) stands for
hashed features: the word itself and the character n-grams of the word between
marks of its ends. Two neighbours stand for one more, their hashed pair; a
word that follows itself is the same pair whatever the word. Every feature has
a learned vector; a document is the average of its features' vectors, and a
linear layer with softmax gives the classes' probabilities. Vectors and layer
are trained together by stochastic gradient descent in numpy, a document a
step, on the cross-entropy with a rate that falls linearly to zero.

Averaging and the linear layer commute, so reading a text needs per feature
only the vector's product with the layer: these are added up once per batch
and distinct word, and gathered by the word's number.

The training rows are a bounded sample (``Sample``); scoring reads every word
of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ventana.llm.bpe import BATCH_CHARS
from ventana.llm.common import pick, smallest, spans, split_words
from ventana.session import materialise

BITS, DIMENSIONS = 18, 16
BUCKETS = 1 << BITS
#: Lengths of the character n-grams; code points hashed side by side; the polynomials' base.
SHORTEST, LONGEST = 2, 5
PIECE = 1 << 19
PRIME = np.uint64(0x100000001B3)
THRESHOLD = 0.3


@dataclass(frozen=True)
class Sample:
    """The bound of the training sample: documents per class (those of
    smallest id hash) of at most so many characters, and passes over them.
    Only the model's training is bounded; scoring is not."""
    per_class: int = 600
    most_chars: int = 20_000
    epochs: int = 4
    rate: float = 2.0


def features(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, number of the word) of every word's features: the words
    themselves first, then their n-grams, in pieces of bounded size. Hashes
    are polynomials over code points, all places of a piece side by side."""
    a = 0
    while a < len(words):
        b, size = a, 0
        while b < len(words) and (size < PIECE or b == a):
            size += len(words[b]) + 2
            b += 1
        marked = "".join(["<" + w + ">" for w in words[a:b]])
        points = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        length = np.array([len(w) + 2 for w in words[a:b]])
        first = np.cumsum(length) - length
        of = np.repeat(np.arange(b - a), length)
        place = np.arange(len(points)) - first[of]
        power = np.cumprod(np.full(int(length.max()), PRIME, np.uint64))
        yield bucket(np.add.reduceat(points * power[place], first), 0), np.arange(a, b)
        left = length[of] - place  # code points of the word from here on
        h = points.copy()
        for k in range(2, LONGEST + 1):
            n = max(0, len(h) - k + 1)
            h[:n] = h[:n] * PRIME + points[len(points) - n:]
            if k >= SHORTEST:
                at = np.flatnonzero(left >= k)
                yield bucket(h[at], k), of[at] + a
        a = b


def bucket(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS)).astype(np.int64)


def pairs(number: np.ndarray, ends: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every two neighbours within a text, from the words'
    own buckets; a word that follows itself is the same pair whatever the word."""
    if len(number) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    inside = text[1:] == text[:-1]
    a, b = number[:-1][inside], number[1:][inside]
    h = np.where(a == b, 0, (word[a] + 1) * BUCKETS + word[b] + 1).astype(np.uint64)
    return bucket(h, LONGEST + 1), text[1:][inside]


class Model:
    """Feature vectors (BUCKETS x DIMENSIONS), the linear layer and its bias, and the classes they tell apart."""

    def __init__(self, vectors: np.ndarray, layer: np.ndarray, bias: np.ndarray):
        self.vectors, self.layer, self.bias = vectors, layer, bias
        self.product = np.ascontiguousarray((vectors @ layer).T.astype(np.float32))  # what a feature adds, a row per class

    def probabilities(self, average: np.ndarray) -> np.ndarray:
        """Softmax of the averages (texts x classes) of the features' products."""
        z = average + self.bias
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


    def sums(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(texts x classes, texts): the sums of the features' products and the numbers of features."""
        words, number, ends = split_words(column)
        words = words.to_pylist()
        classes = range(len(self.bias))
        total, count = np.zeros((len(ends), len(self.bias))), np.zeros(len(ends))
        if not words:
            return total, count
        # summed up per distinct word, then per text
        size, each, own = np.zeros(len(words)), np.zeros((len(self.bias), len(words))), []
        for n, (at, of) in enumerate(features(words)):
            size += np.bincount(of, minlength=len(words))
            for c in classes:
                each[c] += np.bincount(of, self.product[c][at], len(words))
            if n % (LONGEST - SHORTEST + 2) == 0:
                own.append(at)
        text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        at, of = pairs(number, ends, np.concatenate(own))
        count += np.bincount(text, size[number], len(ends)) + np.bincount(of, minlength=len(ends))
        for c in classes:
            total[:, c] = np.bincount(text, each[c][number], len(ends)) + np.bincount(of, self.product[c][at], len(ends))
        return total, count

    def read(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(texts x classes, texts): the classes' probabilities and the numbers of features."""
        total, count = self.sums(column)
        return self.probabilities(total / np.maximum(count, 1)[:, None]), count


def fit(rows: list[tuple[str, int]], sample: Sample = Sample(), classes: int = 2) -> Model:
    """A model from (text, class) rows; the same rows in the same order give
    the same model. Without any row, or with one class only, all texts get the
    share of each class (one half each without rows)."""
    rng = np.random.default_rng(13)
    labels = np.array([y for _, y in rows], dtype=np.int64)
    vectors, layer, bias = np.zeros((BUCKETS, DIMENSIONS)), np.zeros((DIMENSIONS, classes)), np.zeros(classes)
    share = np.bincount(labels, minlength=classes) / max(1, len(rows)) if len(rows) else np.full(classes, 1 / classes)
    if len(set(labels.tolist())) < 2:
        return Model(vectors, layer, np.log(np.maximum(share, 1e-6)))
    # the sample as a table of (text, feature, share of the text's features)
    words, number, ends = split_words(pa.array([t for t, _ in rows]))
    words = words.to_pylist()
    found = list(features(words))
    every, of = np.concatenate([f for f, _ in found]), np.concatenate([w for _, w in found])
    order = np.argsort(of, kind="stable")
    every, first = every[order], np.searchsorted(of[order], np.arange(len(words) + 1))
    own = np.concatenate([f for f, _ in found[::LONGEST - SHORTEST + 2]])
    joined, text = pairs(number, ends, own)
    bounds = np.searchsorted(text, np.arange(len(rows) + 1))
    inputs: list[tuple[np.ndarray, np.ndarray]] = []
    for n, (a, b) in enumerate(zip(np.append(0, ends[:-1]), ends)):
        used, times = np.unique(number[a:b], return_counts=True)
        parts = [every[first[w]:first[w + 1]] for w in used]
        both = np.concatenate([*parts, joined[bounds[n]:bounds[n + 1]]])
        share = np.concatenate([np.repeat(times, [len(p) for p in parts]), np.ones(bounds[n + 1] - bounds[n])])
        ids, at = np.unique(both, return_inverse=True)
        weight = np.bincount(at, share, len(ids))
        inputs.append((ids.astype(np.int32), (weight / max(1.0, weight.sum())).astype(np.float32)))
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((DIMENSIONS, classes))
    target = np.eye(classes)
    steps, step = sample.epochs * len(rows), 0
    for _ in range(sample.epochs):
        for n in rng.permutation(len(rows)):
            rate = sample.rate * (1 - step / steps)
            step += 1
            ids, weight = inputs[n]
            average = weight @ vectors[ids] if len(ids) else np.zeros(DIMENSIONS)
            z = average @ layer + bias
            e = np.exp(z - z.max())
            slope = target[labels[n]] - e / e.sum()
            back = layer @ slope
            layer += rate * np.outer(average, slope)
            bias += 0.1 * rate * slope
            # a feature's step is in proportion to its weight; the commonest one of the document takes the whole step
            if len(ids):
                vectors[ids] += np.outer(rate * weight / weight.max(), back).astype(np.float32)
    return Model(vectors, layer, bias)


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: Sample = Sample(), id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality", classes: int = 2) -> Model:
    """Fit on a bounded sample of the labelled documents: per class those
    ``sample.per_class`` with the smallest hash of their id, of ids in
    ``docs``. Labels that are no class, null ids and documents without text
    are passed by; an id with several labels has the smallest, one with
    several texts the smallest."""
    src = pick(docs, doc_id=id_col, text=text_col)
    known = pick(labels, label_id=id_col, label=label_col).where(F.col("label_id").isNotNull() & F.col("label").isin(*range(classes)))
    known = known.groupBy("label_id").agg(F.min("label").cast("int").alias("label"))
    present = src.select("doc_id").distinct()  # ids only: no text is read
    known = known.join(present, F.col("label_id") == F.col("doc_id"), "left_semi")
    known, _ = materialise(spark, known.withColumn("h", F.xxhash64("label_id")), "quality-labels")
    chosen = smallest(known, F.col("h"), 2 * sample.per_class, F.col("label"))
    rows = (src.where(F.length("text").between(1, sample.most_chars)).join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
            .groupBy("label_id", "label", "h").agg(F.min("text").alias("text")))
    # a few thousand rows
    first = Window.partitionBy("label").orderBy("h", "label_id")
    rows = rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= sample.per_class).select("label", "h", "label_id", "text")
    got = sorted(rows.collect(), key=lambda r: (r.h, str(r.label_id)))
    return fit([(r.text, r.label) for r in got], sample, classes)


def score(spark: SparkSession, docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, score, probabilities, n_features`` (and ``keep_<column>`` for
    the columns ``keep``): the probability of the last class, those of all
    classes, and over how many features the document was averaged.

    One pass, no shuffle. Null and empty texts (and white space) average
    nothing and score the bias alone; repeated rows and null doc_ids are
    scored like any others; an empty table gives an empty one; a text of any
    length is read whole; other columns are not looked at.
    """
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in spans(batches, "text", BATCH_CHARS):
            p, count = shared.value.read(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(p[:, -1]), pa.array(list(p), pa.list_(pa.float64())), pa.array(count.astype(np.int64)),
                 *[batch.column(f"keep_{c}") for c in keep]], ["doc_id", "score", "probabilities", "n_features", *[f"keep_{c}" for c in keep]])

    src = pick(docs, doc_id=id_col, text=text_col, **{f"keep_{c}": c for c in keep})
    kinds = "".join(f", keep_{c} {src.schema[f'keep_{c}'].dataType.simpleString()}" for c in keep)
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double, probabilities array<double>, "
                               "n_features bigint" + kinds)


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5
