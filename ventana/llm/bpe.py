"""Byte-level BPE: exact encoding by backtracking, and decoding.

Tokens are byte strings with ranks. Bytes are mapped one to one to Latin-1
characters so that a pyahocorasick automaton can list every token that occurs
in a piece. The encoder then walks the piece from the left with the longest
token first and steps back when a token cannot stand next to its predecessor:
two tokens are *compatible* when merging their joined bytes by rank gives
exactly these two back. A sequence whose neighbours are all compatible is the
one that the merges produce, so the first complete walk is the exact result.
Compatibility is memoised, and a position that led nowhere is not entered
twice, which keeps the walk linear in the piece.
"""

from __future__ import annotations

import base64
import re
import sys
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ventana.llm.common import Memo, pick, spans, texts

#: Characters of text that a worker handles at once, or one longer text.
BATCH_CHARS = 4_000_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks from the lines ``base64-token rank``."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class Encoder:
    """Exact byte-pair encoding of single pieces by backtracking."""

    def __init__(self, ranks: dict[bytes, int], bound: int = 500_000):
        self.ranks, self.bound = ranks, bound
        self.tokens = {r: t for t, r in ranks.items()}
        self.length = {r: len(t) for t, r in ranks.items()}
        self.pairs: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.automaton = ahocorasick.Automaton()
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            parts = self.merge(token, len(token) > 1)
            # a token that its own bytes do not merge into can only stand for a whole piece
            if len(parts) < 3 and b"".join(self.tokens[p] for p in parts) == token:
                self.halves[rank] = tuple(parts) if len(parts) == 2 else None
                self.automaton.add_word(token.decode("latin-1"), (len(token) - 1, rank))
        self.automaton.make_automaton()

    def merge(self, piece: bytes, but_last: bool = False) -> list[int]:
        """The definition: merge the neighbours of lowest rank, leftmost first
        (``but_last``: stop before the merge that gives the whole piece).
        Quadratic; used on single tokens."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None or but_last and len(parts) == 2:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _pair(self, a: int, b: int) -> bool:
        """Whether token ``b`` can follow token ``a``: undo the merges on both
        sides of the seam, latest first, and see that none of the tokens met
        would have been merged across it earlier."""
        if len(self.pairs) >= self.bound:
            self.pairs.clear()
        key, limit, fits = a << 32 | b, float("inf"), True
        while True:
            across = self.ranks.get(self.tokens[a] + self.tokens[b])
            if across is not None and across < limit:
                fits = False
                break
            if self.halves[a] is None and self.halves[b] is None:
                break
            # the side merged later is undone; a single byte was there from the start
            if self.halves[b] is None or (self.halves[a] is not None and a > b):
                limit, a = a, self.halves[a][1]
            else:
                limit, b = b + 1, self.halves[b][0]
        self.pairs[key] = fits
        return fits

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        starting: list[list[int]] = [[] for _ in piece]
        for end, (back, rank) in self.automaton.iter(piece.decode("latin-1")):
            starting[end - back].append(rank)
        # A prefix has one valid encoding only, so a place from which the walk
        # came back is dead for every other way there, and no token is tried twice.
        n, pairs, length, dead = len(piece), self.pairs, self.length, set()
        path: list[int] = []
        at, last = 0, 0
        while at < n:
            ways = starting[at]
            while ways:
                rank = ways.pop()
                if at:
                    fits = pairs.get(last << 32 | rank)
                    if not (self._pair(last, rank) if fits is None else fits):
                        continue
                if at + length[rank] not in dead:
                    path.append(rank)
                    at += length[rank]
                    last = rank
                    break
            else:
                if not path:
                    raise ValueError("the ranks lack a byte of the text")
                dead.add(at)
                at -= length[path.pop()]
                last = path[-1] if path else 0
        return path


class Tokenizer:
    """Splits text by a pattern and encodes each match; packs ids as little-endian unsigned 32-bit integers."""

    #: A single space between two characters that are no white space: every
    #: match of a GPT-style pattern ends before it or begins with it.
    _seam = re.compile(r"(?<=\S) (?=\S)")
    _beside = re.compile(r" \s|\s ")

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.find = regex.compile(pattern).findall
        self.encoder = Encoder(ranks)
        self.pieces = Memo(lambda piece: self.pack(self.encoder.encode(piece.encode())), 75_000)
        self.chunks = Memo(lambda chunk: self.direct(" " + chunk), 150_000)

    @staticmethod
    def pack(ids: list[int]) -> bytes:
        packed = array("I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def direct(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.find(text)))

    def encode(self, text: str) -> bytes:
        split = text.split(" ") if text.strip() == text and not self._beside.search(text) else self._seam.split(text)
        return self.direct(split[0]) + b"".join(map(self.chunks.__getitem__, split[1:]))


def vocabulary(ranks: dict[bytes, int]) -> list[bytes]:
    """Each id's bytes (none for an id that is free)."""
    by_id = {r: t for t, r in ranks.items()}
    return [by_id.get(r, b"") for r in range(max(by_id) + 1)]


def decode_ids(ids: bytes, tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_MADE: dict[tuple[int, str], Tokenizer] = {}


def _tokenizer(data: bytes, pattern: str) -> Tokenizer:
    key = (hash(data), pattern)
    if key not in _MADE:
        _MADE[key] = Tokenizer(read_ranks(data), pattern)
    return _MADE[key]


def read_vocabulary(path: str) -> bytes:
    """A vocabulary file's bytes (a megabyte or so, whatever the data)."""
    with open(path, "rb") as f:
        return f.read()


def encode(spark: SparkSession, docs: DataFrame, ranks_path: str, pattern: str,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, token_ids``: the ids of every whole text, packed as
    little-endian unsigned 32-bit integers in a binary column.

    One pass, no shuffle. A null or empty text has no ids (empty binary);
    repeated rows and null doc_ids are encoded like any others; an empty table
    gives an empty one; columns beside the two named ones are not looked at.
    Texts are encoded whole, whatever their length.
    """
    ranks = spark.sparkContext.broadcast(read_vocabulary(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(ranks.value, pattern)
        for batch in spans(batches, "text", BATCH_CHARS):
            ids = [tok.encode(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "token_ids"])

    src = pick(docs, doc_id=id_col, text=text_col)
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, token_ids binary")


def decode(spark: SparkSession, tokens: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id, token_ids, decoded``: the bytes that packed ids stand for
    (binary, since a cut id sequence need not be whole UTF-8). Null ids count
    as none. Input: the columns that :func:`encode` returns."""
    ranks = spark.sparkContext.broadcast(read_vocabulary(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(read_ranks(ranks.value))
        for batch in spans(batches, "token_ids", 4 * BATCH_CHARS):
            got = [decode_ids(b or b"", known) for b in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("token_ids"), pa.array(got, pa.binary())],
                ["doc_id", "token_ids", "decoded"])

    src = pick(tokens, doc_id="doc_id", token_ids="token_ids")
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, token_ids binary, decoded binary")


def n_tokens(ids: Column) -> Column:
    """How many ids a packed column holds."""
    return (F.octet_length(ids) / 4).cast("long")
