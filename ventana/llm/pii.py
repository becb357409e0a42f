"""Personal data: fixed rules, and a character-level BiLSTM with a CRF on top.

The rules give the base spans. A bidirectional LSTM over character classes
with CRF transitions is trained in numpy on windows of a bounded sample, and
adds spans of the same four kinds that the rules miss. What these look like it
learns from the base spans and from copies of them written in ways that break
the rules (``broken``): other separators, a missing plus, a spaced ``@``. What
a rule dropped (a number that fails its check digit) is no span in training.
A share of the sample is held out; ``report`` gives precision and recall of
each kind on its broken spans.

Every kind holds a digit or an ``@`` by definition. A stretch of text without
either can hold no span, whatever the network says, so windows are laid over
all stretches within ``REACH`` of such a character, and over the whole of a
run without spaces that reaches farther: overlapping, each decoded
to label probabilities, which are then averaged per character (the middle of a
window weighs most) and read off over the whole text, so that a span crossing
windows is one span.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ventana.llm.bpe import BATCH_CHARS
from ventana.llm.common import pick, smallest, spans, texts
from ventana.session import materialise, remove

KINDS = ["email", "ip", "card", "phone"]
WINDOW, STRIDE, REACH = 64, 32, 24
#: Mean label probability that an added span needs.
SURE = 0.9

SIGNAL = re.compile(r"[0-9@]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match starts where a run of digits does: it would succeed from there if from anywhere in the run
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]  # index in KINDS, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The rules: leftmost non-overlapping matches per kind that pass their checks."""
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:  # an @ has one leftmost local part: all its characters before, after the last match
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        done = m.end() if m else at + 1
        if m:
            out.append((0, start, done))
        at = text.find("@", done)
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 37:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            out.append((3, m.start(), m.end()))
    return out


#: Ways of writing a kind that its rule does not match, each as (what stands for, what): see ``broken``.
DOTS = [", ", "[.]", " . ", ":", "-", "(.)"]
GROUPS = [".", "/", "_", "  ", "--", " - "]
ATS = [" @ ", "[@]", "(@)", "@ "]


def broken(kind: int, span: str, rng: np.random.Generator) -> str:
    """A base span written so that no rule finds it whole."""
    pick_one = lambda ways: ways[int(rng.integers(len(ways)))]
    if kind == 0:
        return span.replace("@", pick_one(ATS))
    if kind == 1:
        return span.replace(".", pick_one(DOTS))
    digits = "".join(c for c in span if "0" <= c <= "9")
    if kind == 2:
        return pick_one(GROUPS).join(digits[i:i + 4] for i in range(0, len(digits), 4))
    area, rest = digits[-10:-7] or digits[:1], digits[-7:]
    code = digits[:-10]
    return pick_one([f"{code} ({area}) {rest[:3]}-{rest[3:]}", f"({area}) {rest[:3]}-{rest[3:]}", f"00{code} {area} {rest[:3]} {rest[3:]}",
                     f"+{code}/{area}/{rest[:3]}-{rest[3:]}", f"{area}.{rest[:3]}.{rest[3:]}"]).strip()


def rewritten(text: str, found: list[Span], rng: np.random.Generator) -> tuple[str, list[Span]]:
    """The text with its (non-overlapping) spans broken, and where they are now;
    spans that a rule still finds in part are left out."""
    parts, spans, done, size = [], [], 0, 0
    for kind, a, b in sorted(found, key=lambda s: s[1]):
        if a < done:
            continue
        new = broken(kind, text[a:b], rng)
        size += a - done
        parts += [text[done:a], new]
        spans.append((kind, size, size + len(new)))
        size += len(new)
        done = b
    out = "".join([*parts, text[done:]])
    still = base_spans(out)
    return out, [s for s in spans if not any(y < s[2] and s[1] < z for _, y, z in still)]


# ---------------------------------------------------------------- the network

#: Character classes, one each for the marks that matter.
MARKS = "@.-+()_% \n:/,"


def _class_table() -> np.ndarray:
    table = np.full(128, 5 + len(MARKS), dtype=np.int8)  # other ASCII
    for c in range(128):
        ch = chr(c)
        if ch.isdigit():
            table[c] = 1
        elif ch.islower():
            table[c] = 2
        elif ch.isupper():
            table[c] = 3
        elif ch in MARKS:
            table[c] = 5 + MARKS.index(ch)
    return table


SPACES = [5 + MARKS.index(c) for c in " \n"]
CLASSES = 6 + len(MARKS)  # 0 outside the text, 1-3 above, 4 beyond ASCII, then the marks, then the rest
_TABLE = _class_table()


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(codes < 128, _TABLE[np.minimum(codes, 127)], 4).astype(np.int8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Two LSTMs (left to right and back), a linear layer, CRF transitions."""

    def __init__(self, hidden: int = 16, seed: int = 5):
        rng, h, n = np.random.default_rng(seed), hidden, len(KINDS) + 1
        self.h = h
        self.p = {"out": rng.normal(0, 0.3, (2 * h, n)), "bias": np.zeros(n), "move": np.zeros((n, n)), "first": np.zeros(n)}
        for d in "fb":
            self.p["x" + d] = rng.normal(0, 0.3, (CLASSES, 4 * h))
            self.p["h" + d] = rng.normal(0, 0.3, (h, 4 * h))
            self.p["c" + d] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)])

    def _lstm(self, x: np.ndarray, d: str, keep: bool):
        """x: windows x time of classes -> hidden states (time first), and what the way back needs."""
        n, steps = x.shape
        h = self.h
        state, cell = np.zeros((n, h)), np.zeros((n, h))
        hs, kept = np.empty((steps, n, h)), []
        table = self.p["x" + d] + self.p["c" + d]
        for t in range(steps):
            g = table[x[:, t]] + state @ self.p["h" + d]
            s = sigmoid(g[:, :3 * h])
            i, f, o, u = s[:, :h], s[:, h:2 * h], s[:, 2 * h:], np.tanh(g[:, 3 * h:])
            before, cell = cell, f * cell + i * u
            tc = np.tanh(cell)
            if keep:
                kept.append((i, f, o, u, before, tc, state))
            state = o * tc
            hs[t] = state
        return hs, kept

    def _lstm_back(self, x: np.ndarray, d: str, grad: np.ndarray, kept: list, g: dict) -> None:
        h, steps = self.h, x.shape[1]
        dh, dc = np.zeros_like(grad[0]), np.zeros_like(grad[0])
        for t in range(steps - 1, -1, -1):
            i, f, o, u, before, tc, state = kept[t]
            dh = dh + grad[t]
            dc = dc + dh * o * (1 - tc * tc)
            da = np.concatenate([dc * u * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - u * u)], axis=1)
            np.add.at(g["x" + d], x[:, t], da)
            g["c" + d] += da.sum(axis=0)
            g["h" + d] += state.T @ da
            dh, dc = da @ self.p["h" + d].T, dc * f

    def emissions(self, x: np.ndarray, keep: bool = False):
        forward, kf = self._lstm(x, "f", keep)
        backward, kb = self._lstm(x[:, ::-1], "b", keep)
        both = np.concatenate([forward, backward[::-1]], axis=2)
        return both @ self.p["out"] + self.p["bias"], (both, kf, kb)

    def chain(self, e: np.ndarray):
        """Label probabilities (time x window x label) and expected moves of the CRF."""
        steps, n, k = e.shape
        w = np.exp(e - e.max(axis=2, keepdims=True))
        move = np.exp(self.p["move"])
        alpha, beta = np.empty_like(w), np.ones_like(w)
        a = np.exp(self.p["first"]) * w[0]
        alpha[0] = a / a.sum(axis=1, keepdims=True)
        for t in range(1, steps):
            a = (alpha[t - 1] @ move) * w[t]
            alpha[t] = a / a.sum(axis=1, keepdims=True)
        moves = np.zeros((k, k))
        for t in range(steps - 2, -1, -1):
            b = w[t + 1] * beta[t + 1]
            scale = ((alpha[t] @ move) * b).sum(axis=1, keepdims=True)
            moves += move * (alpha[t].T @ (b / scale))
            b = b @ move.T
            beta[t] = b / b.sum(axis=1, keepdims=True)
        p = alpha * beta
        return p / p.sum(axis=2, keepdims=True), moves

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """windows x time x label."""
        parts = [self.chain(self.emissions(x[a:a + 2048])[0])[0].transpose(1, 0, 2) for a in range(0, len(x), 2048)]
        return np.concatenate(parts) if parts else np.zeros((0, WINDOW, len(KINDS) + 1))

    def gradient(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the log-likelihood of labels y (windows x time), per window."""
        e, (both, kf, kb) = self.emissions(x, keep=True)
        p, moves = self.chain(e)
        k = e.shape[2]
        de = (np.eye(k)[y.T] - p) / len(x)
        g = {name: np.zeros_like(v) for name, v in self.p.items()}
        np.add.at(g["move"], (y[:, :-1].ravel(), y[:, 1:].ravel()), 1.0)
        g["move"] = (g["move"] - moves) / len(x)
        g["first"] = de[0].sum(axis=0)
        g["out"] = np.einsum("tnh,tnk->hk", both, de)
        g["bias"] = de.sum(axis=(0, 1))
        dh = de @ self.p["out"].T
        self._lstm_back(x, "f", dh[:, :, :self.h], kf, g)
        self._lstm_back(x[:, ::-1], "b", dh[::-1, :, self.h:], kb, g)
        return g


@dataclass(frozen=True)
class Sample:
    """The bound of the training sample: documents with a digit or an @ of at
    most so many characters, windows of them, and epochs over these."""
    documents: int = 600
    most_chars: int = 20_000
    windows: int = 2400
    epochs: int = 9
    held_out: float = 0.2


def fit(rows: list[str], sample: Sample = Sample()) -> Network:
    """Train on windows around the base spans, around broken copies of them, and around other digits."""
    rng = np.random.default_rng(11)
    xs, ys, plain_x, plain_y = [], [], [], []
    whole = [(text, base_spans(text)) for text in rows]
    copies = [rewritten(text, found, rng) for _ in range(3) for text, found in whole if found]
    both = [(text, found, True) for text, found in whole] + [(text, found, False) for text, found in copies if found]
    for text, found, original in [both[i] for i in rng.permutation(len(both))]:
        x, y = classes(text), np.zeros(len(text), dtype=np.int64)
        for kind, a, b in found:
            y[a:b] = kind + 1
        places = [(a, True) for _, a, _ in found]
        others = [m.start() for m in SIGNAL.finditer(text) if not y[m.start()]]
        places += [(others[i], False) for i in rng.permutation(len(others))[:2]] if original else []
        for at, hit in places:
            a = at - int(rng.integers(4, WINDOW - 24))
            pad, end = max(0, -a), min(len(text), a + WINDOW)
            wx, wy = np.zeros(WINDOW, np.int8), np.zeros(WINDOW, np.int64)
            n = end - max(0, a)
            wx[pad:pad + n], wy[pad:pad + n] = x[max(0, a):end], y[max(0, a):end]
            (xs if hit else plain_x).append(wx)
            (ys if hit else plain_y).append(wy)
    net = Network()
    if not xs:
        net.p["first"][1:] = net.p["bias"][1:] = -30.0  # nothing to learn from: nothing is added
        return net
    half = sample.windows // 2
    x, y = np.array(xs[:2 * half] + plain_x[:half]), np.array(ys[:2 * half] + plain_y[:half])
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    s = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0
    # a small sample is passed over more often, to about the same number of steps
    size = 64
    epochs = max(sample.epochs, -(-sample.epochs * sample.windows // max(1, len(x)) // 4))
    for epoch in range(min(epochs, 6 * sample.epochs)):
        order = rng.permutation(len(x))
        for a in range(0, len(x), size):
            step += 1
            rate = 0.02 / (1 + epoch / 6)
            for k, g in net.gradient(x[order[a:a + size]], y[order[a:a + size]]).items():
                norm = np.sqrt((g * g).sum())
                g = g * min(1.0, 5.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.99 * s[k] + 0.01 * g * g
                net.p[k] += rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-8)
    return net


def train(spark: SparkSession, docs: DataFrame, sample: Sample = Sample(), id_col: str = "doc_id", text_col: str = "text") -> Network:
    """Fit on the part of a bounded sample (:func:`sample_of`) that is not held out."""
    rows = sample_of(spark, docs, sample, id_col, text_col)
    return fit(rows[:len(rows) - int(len(rows) * sample.held_out)], sample)


def sample_of(spark: SparkSession, docs: DataFrame, sample: Sample = Sample(), id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    """The texts of the documents of smallest id hash among those with an
    ``@`` or a run of six digits and separators, up to ``sample.documents`` of
    at most ``sample.most_chars`` characters; of an id with several the
    smallest. Ids alone are compared; texts are fetched for the chosen ones."""
    able = pick(docs, doc_id=id_col, text=text_col).where(
        (F.length("text") <= sample.most_chars) & F.col("text").rlike(r"@|[0-9][0-9 ().-]{5,}"))
    ids, folder = materialise(spark, able.select("doc_id", F.xxhash64("doc_id").alias("h")).distinct(), "pii-ids")
    chosen = smallest(ids, F.col("h"), sample.documents).orderBy("h", "doc_id").limit(sample.documents)
    chosen = F.broadcast(chosen.select(F.col("doc_id").alias("one_id"), "h"))
    rows = (able.join(chosen, F.col("doc_id").eqNullSafe(F.col("one_id"))).groupBy("one_id", "h").agg(F.min("text").alias("text"))
            .orderBy("h", "one_id").select("text").collect())
    remove(spark, folder)
    return [r.text for r in rows]


def report(net: Network, rows: list[str], seed: int = 3) -> dict[str, dict[str, float]]:
    """Per kind ``spans``, ``precision`` and ``recall`` of what the network adds
    to texts whose base spans have been broken: a found span counts if it
    overlaps one of its kind."""
    rng = np.random.default_rng(seed)
    cases = [rewritten(t, base_spans(t), rng) for t in rows]
    found = added_spans(net, [t for t, _ in cases], [base_spans(t) for t, _ in cases])
    meets = lambda s, others: any(k == s[0] and a < s[2] and s[1] < b for k, a, b in others)
    out = {}
    for k, name in enumerate(KINDS):
        truth = [(s, f) for (_, spans), f in zip(cases, found) for s in spans if s[0] == k]
        said = [(s, spans) for (_, spans), f in zip(cases, found) for s in f if s[0] == k]
        out[name] = {"spans": len(truth), "recall": sum(meets(s, f) for s, f in truth) / max(1, len(truth)),
                     "precision": sum(meets(s, t) for s, t in said) / max(1, len(said))}
    return out


# ---------------------------------------------------------------- reading texts

#: Weight of a place in a window: the middle counts most.
MIDDLE = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1]) + 1.0


def regions(places: np.ndarray, x: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of a text of classes ``x`` within REACH of a signal character;
    where that cuts the run without space or line end that the character stands
    in, the whole run and REACH more."""
    if not len(places):
        return []
    size = len(x)
    gaps = np.concatenate([[-1], np.flatnonzero(np.isin(x, SPACES)), [size]])
    at = np.searchsorted(gaps, places)
    first, last = gaps[at - 1] + 1, gaps[at]
    start = np.where(first < places - REACH, first, places) - REACH
    end = np.where(last > places + REACH + 1, last, places + 1) + REACH
    # a run's whole stretch, for each of its signals, may begin before and end after those of its neighbours
    start, end = np.minimum.accumulate(start[::-1])[::-1], np.maximum.accumulate(end)
    cut = np.flatnonzero(start[1:] >= end[:-1])
    first, last = start[np.concatenate([[0], cut + 1])], end[np.concatenate([cut, [len(places) - 1]])]
    return [(max(0, int(a)), min(size, int(b))) for a, b in zip(first, last)]


def added_spans(net: Network, rows: list[str], base: list[list[Span]]) -> list[list[Span]]:
    """What the network finds beside the base spans, for a batch of texts."""
    out: list[list[Span]] = [[] for _ in rows]
    jobs: list[tuple[int, int, int, np.ndarray]] = []
    waiting = 0
    for i, text in enumerate(rows):
        places = np.array([m.start() for m in SIGNAL.finditer(text)], dtype=np.int64)
        x = classes(text) if len(places) else None
        for a, b in regions(places, x):
            jobs.append((i, a, b, x[a:b]))
            waiting += b - a
            if waiting > 500_000:
                _read(net, rows, base, jobs, out)
                jobs, waiting = [], 0
    _read(net, rows, base, jobs, out)
    return out


def _read(net: Network, rows: list[str], base: list[list[Span]], jobs: list, out: list[list[Span]]) -> None:
    windows, owners = [], []
    for j, (_, a, b, x) in enumerate(jobs):
        for w in range(0, max(1, len(x) - (WINDOW - STRIDE)), STRIDE):
            piece = np.zeros(WINDOW, np.int8)
            part = x[w:w + WINDOW]
            piece[:len(part)] = part
            windows.append(piece)
            owners.append((j, w))
    if not windows:
        return
    sums = [np.zeros((b - a, len(KINDS) + 1)) for _, a, b, _ in jobs]
    for k in range(0, len(windows), 2048):  # a long run is one region: its windows are not all held at once
        for (j, w), q in zip(owners[k:k + 2048], net.probabilities(np.array(windows[k:k + 2048]))):
            n = min(WINDOW, len(sums[j]) - w)
            sums[j][w:w + n] += q[:n] * MIDDLE[:n, None]
    for (i, a, b, x), total in zip(jobs, sums):
        q = total / total.sum(axis=1, keepdims=True)
        label = q.argmax(axis=1)
        if not label.any():
            continue
        edges = np.flatnonzero(np.diff(label, prepend=0, append=0))
        for s, e in zip(edges, edges[1:]):
            kind = label[s]
            if kind and q[s:e, kind].mean() >= SURE and (x[s:e] == 1).any() | (x[s:e] == 5).any():
                start, end = a + int(s), a + int(e)
                if not any(start < y and z < end for _, z, y in base[i]):
                    out[i].append((int(kind) - 1, start, end))


SPANS = "array<struct<kind: int, start: bigint, end: bigint>>"


def recognise(spark: SparkSession, docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text",
              keep: tuple[str, ...] = (), mask: bool = False) -> DataFrame:
    """``doc_id, base, added`` (and ``keep_<column>`` for the columns ``keep``,
    and with ``mask`` the text with its spans masked, ``masked``): spans as
    (index in KINDS, start, end) in code points, end exclusive.

    One pass, no shuffle. Null and empty texts have none; repeated rows and
    null doc_ids are read like any others; an empty table gives an empty one;
    other columns are not looked at; texts are read whole. An added span
    overlaps no base span.
    """
    shared = spark.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
        row = lambda found: [dict(zip(("kind", "start", "end"), s)) for s in sorted(found)]
        for batch in spans(batches, "text", BATCH_CHARS):
            rows = texts(batch)
            base = [base_spans(t) if SIGNAL.search(t) else [] for t in rows]
            added = added_spans(shared.value, rows, base)
            hidden = []
            if mask:
                nulls = batch.column("text").is_null().to_pylist()
                hidden = [pa.array([None if n else masked(t, b + a) for n, t, b, a in zip(nulls, rows, base, added)], pa.string())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(row, base), kind), pa.array(map(row, added), kind),
                 *[batch.column(f"keep_{c}") for c in keep], *hidden],
                ["doc_id", "base", "added", *[f"keep_{c}" for c in keep], *["masked"][:len(hidden)]])

    src = pick(docs, doc_id=id_col, text=text_col, **{f"keep_{c}": c for c in keep})
    kinds = "".join(f", keep_{c} {src.schema[f'keep_{c}'].dataType.simpleString()}" for c in keep)
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, base {SPANS}, added {SPANS}{kinds}"
                              + (", masked string" if mask else ""))


def joined(found: Column) -> Column:
    """``kind:start:end`` by kind, then start, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(found), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def masked(text: str, found: list[Span]) -> str:
    """The text with each span replaced by its kind in angle brackets; spans
    that overlap are one stretch, named by the longest (the first of equals)."""
    stretches: list[list[int]] = []  # start, end, kind of the longest span, its length
    for start, end, kind in sorted((a, b, k) for k, a, b in found):
        if stretches and start < stretches[-1][1]:
            last = stretches[-1]
            last[1] = max(last[1], end)
            if end - start > last[3]:
                last[2:] = [kind, end - start]
        else:
            stretches.append([start, end, kind, end - start])
    parts, done = [], 0
    for start, end, kind, _ in stretches:
        parts += [text[done:start], f"<{KINDS[kind].upper()}>"]
        done = end
    return "".join([*parts, text[done:]]) if parts else text
