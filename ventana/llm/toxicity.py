"""Toxicity by a linear-chain conditional random field over words.

Labels are given per document. Words are labelled from them: a feature of a
word (the word, its beginnings) that stands in labelled toxic documents far
more often than chance allows marks the words it covers, and toxic documents
without such a word are covered greedily by the purest features left. On
those token labels a two-state field is trained by maximum likelihood in
numpy: emissions from hashed features of the word, transitions between clean
and toxic. Forward-backward gives every word's marginal; a document's score is
a logistic function, fitted on the training documents, of the marginals' sum of
squares (which many faint ones do not raise) and maximum, and runs of marginals over one half are its offending spans.

The training rows are a bounded sample (``Sample``); scoring reads every word
of every text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventana.llm.bpe import BATCH_CHARS
from ventana.llm.common import Memo, pick, spans, texts

WORDS = re.compile(r"\w+")
#: Hashed emission weights; words of a segment of the blocked forward-backward.
BUCKETS, SEGMENT = 1 << 18, 256
THRESHOLD = 0.3
#: Likelihood-ratio statistic at which a feature counts as more than chance.
STRONG = 24.0


@dataclass(frozen=True)
class Sample:
    """The bound of the training sample: documents per class (those of
    smallest id hash) of at most so many characters, words per training
    window, windows per toxic document and of all clean ones, and gradient
    steps. Only the model's training is bounded; scoring is not."""
    per_class: int = 1200
    most_chars: int = 20_000
    window: int = 32
    toxic_windows: int = 3
    clean_windows: int = 4000
    rounds: int = 60


def features(word: str) -> list[str]:
    """The word, its beginnings and its end."""
    w = word.lower()
    return [w, *(f"^{w[:n]}" for n in (4, 5, 6) if len(w) > n), f"{w[-3:]}$"]


def slots(word: str) -> list[int]:
    return [crc32(f.encode()) % BUCKETS for f in features(word)]


# ---------------------------------------------------------------- the field

def marginals(emission: np.ndarray, sizes: np.ndarray, start: np.ndarray, move: np.ndarray) -> np.ndarray:
    """P(toxic) of every word. ``emission``: log-odds of all documents' words
    one after another; ``sizes``: words per document; ``start`` (2) and
    ``move`` (2 x 2, from x to): positive weights.

    Exact forward-backward in blocks: documents are cut into segments whose
    transfer matrices are multiplied side by side; messages then go over
    segments, and last through all segments side by side. The number of vector
    steps is SEGMENT plus the longest document's segments.
    """
    total = int(sizes.sum())
    if not total:
        return np.zeros(0)
    count = -(-sizes // SEGMENT)
    doc_first = np.cumsum(count) - count            # first segment of a document
    s = int(count.sum())
    doc = np.repeat(np.arange(len(sizes)), count)   # document of a segment
    nth = np.arange(s) - doc_first[doc]
    begin = (np.cumsum(sizes) - sizes)[doc] + nth * SEGMENT
    length = np.minimum(SEGMENT, sizes[doc] - nth * SEGMENT)
    steps = int(length.max())
    at = begin[:, None] + np.arange(steps)
    valid = np.arange(steps) < length[:, None]
    weight = np.exp(np.clip(emission, -30, 30))[np.where(valid, at, 0)]
    # step matrices: move into a word's state times its emission; a document's first word has `start` instead
    first = nth == 0

    def forward(f: np.ndarray, t: int) -> np.ndarray:
        """f: (..., segment, 2) messages before word t -> after it, normalised."""
        g = f @ move
        if t == 0:
            g = np.where(first[:, None], f.sum(axis=-1, keepdims=True) * start, g)
        g = np.stack([g[..., 0], g[..., 1] * weight[:, t]], axis=-1)
        return np.where(valid[:, t, None], g, f)

    # transfer matrices of whole segments, from each unit message
    unit = np.broadcast_to(np.eye(2)[:, None, :], (2, s, 2)).copy()
    for t in range(steps):
        unit = forward(unit, t)
        unit /= unit.sum(axis=(0, 2), keepdims=True)
    into = np.ones((s, 2))
    most = int(count.max())
    for n in range(1, most):
        here = np.flatnonzero(nth == n)
        f = np.einsum("si,isj->sj", into[here - 1], unit[:, here - 1])
        into[here] = f / f.sum(axis=1, keepdims=True)
    out_of = np.ones((s, 2))
    for n in range(most - 2, -1, -1):
        here = np.flatnonzero((nth == n) & (n + 1 < count[doc]))
        b = np.einsum("isj,sj->si", unit[:, here + 1], out_of[here + 1])
        out_of[here] = b / b.sum(axis=1, keepdims=True)
    alpha = np.empty((steps, s, 2))
    f = into
    for t in range(steps):
        f = forward(f, t)
        f = f / f.sum(axis=1, keepdims=True)
        alpha[t] = f
    p = np.empty((s, steps))
    b = out_of
    for t in range(steps - 1, -1, -1):
        both = alpha[t] * b
        p[:, t] = both[:, 1] / both.sum(axis=1)
        g = np.stack([b[:, 0], b[:, 1] * weight[:, t]], axis=1) @ move.T
        b = np.where(valid[:, t, None], g / g.sum(axis=1, keepdims=True), b)
    return p[valid]


def pair_marginals(emission: np.ndarray, start: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For equally long windows (n x T): P(toxic) per word, expected moves, and starts."""
    n, steps = emission.shape
    weight = np.stack([np.ones_like(emission), np.exp(np.clip(emission, -30, 30))], axis=2)
    alpha, beta = np.empty((steps, n, 2)), np.ones((steps, n, 2))
    f = start * weight[:, 0]
    alpha[0] = f / f.sum(axis=1, keepdims=True)
    for t in range(1, steps):
        f = (alpha[t - 1] @ move) * weight[:, t]
        alpha[t] = f / f.sum(axis=1, keepdims=True)
    moves = np.zeros((2, 2))
    for t in range(steps - 2, -1, -1):
        b = weight[:, t + 1] * beta[t + 1]
        joint = alpha[t][:, :, None] * move * b[:, None, :]
        moves += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = b @ move.T
        beta[t] = b / b.sum(axis=1, keepdims=True)
    p = alpha * beta
    p = p[:, :, 1] / p.sum(axis=2)
    return p.T, moves, np.array([(1 - p[0]).sum(), p[0].sum()])


# ---------------------------------------------------------------- training

def distinct(sets: list[set[str]]) -> list[int]:
    """The documents that are no near copies of an earlier one: fewer than
    half of eight minimal hashes of their words in common with it."""
    kept, seen = [], {}
    for n, words in enumerate(sets):
        hashes = np.array([crc32(w.encode()) for w in words], dtype=np.uint64)
        mins = [(k, int(((hashes * np.uint64(2 * k + 0x9E3779B1)) % np.uint64(4294967291)).min())) for k in range(1, 9)] if words else []
        if mins and max(Counter(d for m in mins for d in seen.get(m, ())).values(), default=0) >= 4:
            continue
        kept.append(n)
        for m in mins:
            seen.setdefault(m, []).append(n)
    return kept


def token_labels(docs: list[list[str]], toxic: list[int]) -> set[str]:
    """The features that mark a word as toxic. Near copies count once: what
    their common words say about the label is one document's say."""
    bad, good, left = Counter(), Counter(), []
    words = [{w.lower() for w in d} for d in docs]
    kept = distinct(words)
    marks_of = Memo(lambda w: features(w)[:-1])  # one copy of each feature's text
    for n in kept:
        own = {f for w in words[n] for f in marks_of[w]}
        (bad if toxic[n] else good).update(own)
        if toxic[n]:
            left.append(own)
    nb = len(left)
    ng = len(kept) - nb
    if not nb or not ng:
        return set()
    prior = nb / (nb + ng)

    def gain(f: str) -> float:
        """Likelihood ratio of the feature's documents against chance, if it leans to toxic."""
        b, g = bad[f], good[f]
        rate = b / (b + g)
        if rate < (1 + prior) / 2:
            return 0.0
        return 2 * (b * np.log(rate / prior) + (g * np.log((1 - rate) / (1 - prior)) if g else 0.0))

    marks = {f for f in bad if gain(f) >= STRONG}
    left = [s for s in left if not s & marks]
    while left:  # documents that no strong feature covers
        cover = Counter(f for s in left for f in s if good[f] == 0)
        f, n = max(cover.items(), key=lambda x: (x[1], -len(x[0]), x[0]), default=("", 0))
        if n < 3:
            break
        marks.add(f)
        left = [s for s in left if f not in s]
    return marks


class Model:
    """Emission weights, transitions and the document-level logistic function."""

    def __init__(self, weights: np.ndarray, bias: float, start: np.ndarray, move: np.ndarray, top: np.ndarray):
        self.weights, self.bias, self.start, self.move, self.top = weights, bias, start, move, top

    def emission(self, word: str) -> float:
        return self.bias + float(sum(self.weights[i] for i in slots(word)))

    def document(self, total: np.ndarray, most: np.ndarray) -> np.ndarray:
        z = self.top[0] + self.top[1] * np.log(total + 0.01) + self.top[2] * most
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: list[tuple[str, int]], sample: Sample = Sample()) -> Model:
    """A model from (text, toxic) rows; without one of the classes it scores everything low."""
    docs, toxic = [WORDS.findall(t or "") for t, _ in rows], [int(y) for _, y in rows]
    marks = token_labels(docs, toxic)
    start, move = np.array([1.0, 1.0]), np.ones((2, 2))
    if not marks:
        return Model(np.zeros(BUCKETS, np.float32), -8.0, start, move, np.array([-4.0, 0.0, 0.0]))
    known: dict[str, int] = {}
    marked: list[bool] = []
    idx: list[list[int]] = []
    rng = np.random.default_rng(7)
    windows, width = [], sample.window

    def number(word: str) -> int:
        w = word.lower()
        if w not in known:
            known[w] = len(known)
            idx.append((slots(w) + [BUCKETS] * 5)[:5])
            marked.append(any(f in marks for f in features(w)))
        return known[w]

    clean: list[list[int]] = []
    for words, y in zip(docs, toxic):
        ids = [number(w) for w in words]
        if y:
            at = taken = 0
            while at < len(ids) and taken < sample.toxic_windows:
                if marked[ids[at]]:
                    taken += 1
                    a = max(0, at - width // 2)
                    windows.append(ids[a:a + width])
                    at = a + width
                else:
                    at += 1
        elif ids:
            clean.append(ids)
    for _ in range(sample.clean_windows if clean else 0):
        ids = clean[rng.integers(len(clean))]
        a = int(rng.integers(max(1, len(ids) - width + 1)))
        windows.append(ids[a:a + width])
    pad = number("")  # a word without features ends short windows
    marked[pad] = False
    tokens = np.array([w + [pad] * (width - len(w)) for w in windows])
    labels = np.array(marked)[tokens]
    feats = np.array(idx)
    weights, bias, trans, first = np.zeros(BUCKETS + 1), -2.0, np.zeros((2, 2)), np.zeros(2)
    square = {"w": np.full(BUCKETS + 1, 1e-8), "b": 1e-8, "t": np.full((2, 2), 1e-8), "s": np.full(2, 1e-8)}
    true_moves = np.zeros((2, 2))
    np.add.at(true_moves, (labels[:, :-1].astype(int).ravel(), labels[:, 1:].astype(int).ravel()), 1)
    true_first = np.array([(~labels[:, 0]).sum(), labels[:, 0].sum()])
    n = tokens.size
    for _ in range(sample.rounds):  # full-batch AdaGrad on the log-likelihood
        by_word = weights[feats].sum(axis=1) + bias
        p, moves, firsts = pair_marginals(by_word[tokens], np.exp(first), np.exp(trans))
        slope = np.bincount(tokens.ravel(), (labels - p).ravel(), len(feats))
        g = np.bincount(feats.ravel(), np.repeat(slope, feats.shape[1]), BUCKETS + 1) / n * 100 - 1e-5 * weights
        g[BUCKETS] = 0
        for key, grad in (("w", g), ("b", slope.sum() / n * 100), ("t", (true_moves - moves) / n * 100), ("s", (true_first - firsts) / n * 100)):
            square[key] = square[key] + grad * grad
            step = 0.5 * grad / np.sqrt(square[key])
            if key == "w":
                weights += step
            elif key == "b":
                bias += step
            elif key == "t":
                trans += step
            else:
                first += step
    model = Model(weights[:BUCKETS].astype(np.float32), float(bias), np.exp(first), np.exp(trans), np.zeros(3))
    total, most = aggregate(model, docs, Memo(model.emission))
    x = np.stack([np.ones(len(total)), np.log(total + 0.01), most], axis=1)
    y = np.array(toxic, dtype=float)
    top = np.zeros(3)
    for _ in range(25):  # Newton steps, lightly damped
        q = 1 / (1 + np.exp(-np.clip(x @ top, -30, 30)))
        h = (x * (q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(3)
        top = top + np.linalg.solve(h, x.T @ (y - q) - 0.1 * top)
    model.top = top
    return model


def aggregate(model: Model, docs: list[list[str]], memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    p, sizes = tag(model, docs, memo)
    total, most = np.zeros(len(docs)), np.zeros(len(docs))
    full = np.flatnonzero(sizes)
    if len(full):
        begin = (np.cumsum(sizes) - sizes)[full]
        total[full], most[full] = np.add.reduceat(p * p, begin), np.maximum.reduceat(p, begin)
    return total, most


def tag(model: Model, docs: list[list[str]], memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(d) for d in docs], dtype=np.int64)
    look = memo.__getitem__
    emission = np.fromiter((look(w) for d in docs for w in d), dtype=np.float64, count=int(sizes.sum()))
    return marginals(emission, sizes, model.start, model.move), sizes


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: Sample = Sample(), id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on a bounded sample of the labelled documents: per class those
    ``sample.per_class`` with the smallest hash of their id. Labels other than
    0 and 1 and documents without text are passed by."""
    known = pick(labels, doc_id=id_col, toxic=label_col).where(F.col("toxic").isin(0, 1)).select(
        F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
    chosen = None
    for y in (0, 1):
        some = known.where(F.col("toxic") == y).orderBy(F.xxhash64("label_id"), "label_id").limit(2 * sample.per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    rows = (pick(docs, doc_id=id_col, text=text_col).where(F.length("text") <= sample.most_chars)
            .join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("label_id", "text", "toxic"))
    got = []
    for y in (0, 1):
        part = rows.where(F.col("toxic") == y).orderBy(F.xxhash64("label_id"), "text").limit(sample.per_class)
        got += [(r.text, r.toxic) for r in part.collect()]
    return fit(got, sample)


def score(spark: SparkSession, docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, score, toxic_words, spans`` (and ``keep_<column>`` for the columns ``keep``): the
    document's score, the marginals' sum of squares, and the (start, end)
    offsets, in code points, of runs of words with a marginal over one half.

    One pass, no shuffle. Null and empty texts have no words and the lowest
    score; repeated rows and null doc_ids are scored like any others; an empty
    table gives an empty one; other columns are not looked at.
    """
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field, memo = shared.value, Memo(shared.value.emission)
        for batch in spans(batches, "text", BATCH_CHARS):
            rows = texts(batch)
            words = [WORDS.findall(t) for t in rows]
            p, sizes = tag(field, words, memo)
            ends = np.cumsum(sizes)
            total, most = np.zeros(len(rows)), np.zeros(len(rows))
            full = np.flatnonzero(sizes)
            if len(full):
                total[full] = np.add.reduceat(p * p, (ends - sizes)[full])
                most[full] = np.maximum.reduceat(p, (ends - sizes)[full])
            found: list[list[dict]] = [[] for _ in rows]
            for i in np.flatnonzero(most > 0.5):
                bad = p[ends[i] - sizes[i]:ends[i]] > 0.5
                last = -2
                for w, m in enumerate(WORDS.finditer(rows[i])):
                    if bad[w]:
                        if last == w - 1:
                            found[i][-1]["end"] = m.end()
                        else:
                            found[i].append({"start": m.start(), "end": m.end()})
                        last = w
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(field.document(total, most)), pa.array(total), pa.array(found, kind),
                 *[batch.column(f"keep_{c}") for c in keep]], ["doc_id", "score", "toxic_words", "spans", *[f"keep_{c}" for c in keep]])

    src = pick(docs, doc_id=id_col, text=text_col, **{f"keep_{c}": c for c in keep})
    kinds = "".join(f", keep_{c} {src.schema[f'keep_{c}'].dataType.simpleString()}" for c in keep)
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double, toxic_words double, "
                              "spans array<struct<start: bigint, end: bigint>>" + kinds)


def fold(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 4."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4
