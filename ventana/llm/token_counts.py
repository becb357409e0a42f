"""Token counts by a count-only Viterbi over a unigram vocabulary.

The pieces and scores of a SentencePiece model are read as a unigram model. A
text is normalised as that model says for plain text (spaces become the word
mark, one is put in front); an Aho-Corasick automaton lists the vocabulary
pieces that end at each character; the dynamic programme carries the best
score and the number of pieces of the best segmentation and nothing else.

Tie rule (that of the tokenizer's own lattice): pieces are tried by their
start from left to right, and a later way to the same place replaces an
earlier one only when its score is strictly higher. So of equal scores the
last piece with the leftmost start stays.

No piece has a word mark after another character, so the best path of a text
passes every place before a mark that follows another character: words are
solved apart and memoised, and counts add up exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from ventana.llm.bpe import BATCH_CHARS, read_vocabulary
from ventana.llm.common import Memo, pick, spans, texts

MARK = "▁"
#: SentencePiece's penalty for a character that no piece covers.
UNKNOWN_PENALTY = 10.0


def read_pieces(data: bytes) -> list[tuple[str, float, int]]:
    """(piece, score, type) of a serialised SentencePiece model: the repeated
    message field 1 of the file; type 1 normal, 4 user-defined, 6 byte."""
    import struct

    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[i]
            value |= (byte & 127) << shift
            i, shift = i + 1, shift + 7
            if byte < 128:
                return value, i

    out, i = [], 0
    while i < len(data):
        tag, i = varint(i)
        if tag & 7 != 2:
            raise ValueError("not a serialised SentencePiece model")
        size, i = varint(i)
        end = i + size
        if tag >> 3 == 1:
            piece, score, kind = "", 0.0, 1
            while i < end:
                field, i = varint(i)
                if field & 7 == 2:
                    n, i = varint(i)
                    if field >> 3 == 1:
                        piece = data[i:i + n].decode()
                    i += n
                elif field & 7 == 5:
                    score = struct.unpack_from("<f", data, i)[0]
                    i += 4
                else:
                    value, i = varint(i)
                    kind = value if field >> 3 == 3 else kind
            out.append((piece, score, kind))
        i = end
    return out


class Counter:
    """Counts the pieces of the best segmentation."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        normal = [(p, s) for p, s, kind in pieces if kind == 1]
        if any(MARK in p.lstrip(MARK) for p, _ in normal) or any(kind == 4 for *_, kind in pieces):
            raise ValueError("words cannot be solved apart with this vocabulary")
        self.bytes = any(kind == 6 for *_, kind in pieces)
        self.unknown = min(s for _, s in normal) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in normal:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.words = regex.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall
        self.memo = Memo(self.word)

    def word(self, word: str) -> int:
        """Pieces of one word's best segmentation (an unknown run counts its
        UTF-8 bytes where the model has byte pieces, else one)."""
        n = len(word)
        ending: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        covered = bytearray(n)
        for last, (size, score) in self.automaton.iter(word):
            ending[last + 1].append((last + 1 - size, score))
            if size == 1:
                covered[last] = 1
        best = [0.0] * (n + 1)
        count = [0] * (n + 1)
        run = bytearray(n + 1)  # the best way here ends with an unknown character
        for end in range(1, n + 1):
            ways = ending[end]  # the automaton lists longest first: starts from left to right
            top = None
            for start, score in ways:
                s = best[start] + score
                if top is None or s > top:
                    top, pieces, unknown = s, count[start] + 1, 0
            if not covered[end - 1]:
                s = best[end - 1] + self.unknown
                if top is None or s > top:
                    if self.bytes:
                        pieces = count[end - 1] + len(word[end - 1].encode())
                    else:
                        pieces = count[end - 1] + (not run[end - 1])
                    top, unknown = s, 1
            best[end], count[end], run[end] = top, pieces, unknown
        return count[n]

    def count(self, text: str) -> int:
        look, total, start = self.memo.__getitem__, 0, 0
        while start < len(text):  # windows end before a word mark that follows another character
            end = self._seam(text, start + BATCH_CHARS) if len(text) - start > BATCH_CHARS else len(text)
            part = text[start:end].replace(" ", MARK)
            total += sum(map(look, self.words(part if start else MARK + part)))
            start = end
        return total

    @staticmethod
    def _seam(text: str, at: int) -> int:
        found = regex.search(r"(?<=[^ ▁])[ ▁]", text, pos=at)
        return found.start() if found else len(text)


_MADE: dict[int, Counter] = {}


def count_tokens(spark: SparkSession, docs: DataFrame, model_path: str,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_chars``: tokens and code points of every whole text.

    One pass, no shuffle. Null and empty texts have 0 tokens; repeated rows
    and null doc_ids are counted like any others; an empty table gives an
    empty one; other columns are not looked at.
    """
    model = spark.sparkContext.broadcast(read_vocabulary(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(model.value)
        if key not in _MADE:
            _MADE[key] = Counter(read_pieces(model.value))
        counter = _MADE[key]
        for batch in spans(batches, "text", BATCH_CHARS):
            rows = texts(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([counter.count(t) for t in rows], pa.int64()),
                 pa.array([len(t) for t in rows], pa.int64())], ["doc_id", "n_tokens", "n_chars"])

    src = pick(docs, doc_id=id_col, text=text_col)
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, n_chars bigint")
