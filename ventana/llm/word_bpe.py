"""Ids of a batch of distinct words by a BPE vocabulary with word ends, all words side by side.

The vocabulary's rules, as its file states them: NFC, lower case, then runs of
letters, single digits and runs of anything else are tokens of their own
(English contractions too); a token's UTF-8 bytes are its first symbols, the
last one marked as the end; of all neighbours the pair of lowest rank is
merged, the leftmost first, until none has a rank.

Tokens of one length form a table, a row each. Every row merges its own best
pair, so rows that merge are a symbol shorter and join the next table; rows
without a pair of any rank are done. Ranks are looked up again only beside a
merge. Words with characters beyond plain Latin letters, with an apostrophe or
a ``<``, and long ones go through the ``tokenizers`` library.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa

#: Longest word, in bytes, that the tables take.
LONGEST = 48
NONE = np.int32(2 ** 31 - 1)
LETTER, DIGIT, OTHER = 0, 1, 2


def letters_of_bytes() -> list[str]:
    """The character that byte-level vocabularies write for each byte: printable
    Latin-1 as it is, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Ranks:
    """(left, right) -> (rank, merged), looked up for whole arrays: a slot a
    pair by multiplicative hashing; pairs that find theirs taken are in a small sorted list."""

    BITS = 19

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        keys = np.array([a << 32 | b for a, b in pairs], dtype=np.uint64)
        rank, merged = (np.array([v[k] for v in pairs.values()], dtype=np.int32) for k in (0, 1))
        slot = self._slot(keys)
        _, first = np.unique(slot, return_index=True)
        rest = np.setdiff1d(np.arange(len(keys)), first)
        rest = rest[np.argsort(keys[rest])]
        self.keys, self.rank = np.full(1 << self.BITS, 2 ** 64 - 1, np.uint64), np.full(1 << self.BITS, NONE, np.int32)
        self.keys[slot[first]], self.rank[slot[first]] = keys[first], rank[first]
        self.shared = np.zeros(1 << self.BITS, bool)
        self.shared[slot[rest]] = True
        self.more, self.more_rank = keys[rest], rank[rest]
        self.merged = np.zeros(int(rank.max(initial=0)) + 1, np.int32)
        self.merged[rank] = merged

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)).ravel()
        slot = self._slot(keys)
        hit = self.keys[slot] == keys
        out = np.where(hit, self.rank[slot], NONE)
        again = np.flatnonzero(self.shared[slot] & ~hit)
        if len(again) and len(self.more):
            at = np.minimum(np.searchsorted(self.more, keys[again]), len(self.more) - 1)
            out[again] = np.where(self.more[at] == keys[again], self.more_rank[at], NONE)
        return out.reshape(left.shape)


class WordIds:
    """Ids of distinct words, by the vocabulary file's bytes."""

    def __init__(self, data: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_buffer(data)
        model = json.loads(data)["model"]
        vocabulary, end = model["vocab"], model["end_of_word_suffix"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = Ranks({(vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in reversed(list(enumerate(merges)))})
        # -1: a byte that the vocabulary lacks
        self.inner = np.array([vocabulary.get(c, -1) for c in letters_of_bytes()], dtype=np.int32)
        self.last = np.array([vocabulary.get(c + end, -1) for c in letters_of_bytes()], dtype=np.int32)
        byte = np.arange(256)
        self.kind = np.full(256, LETTER, np.int8)
        self.kind[:128] = OTHER
        for c in range(128):
            if chr(c).isalpha():
                self.kind[c] = LETTER
            elif chr(c).isdigit():
                self.kind[c] = DIGIT
        # ASCII and U+00C0 to U+017F, of one case form each, are read here
        self.odd = (byte < 0x21) | (byte == 0x7F) | (byte == ord("'")) | (byte == ord("<")) | (byte == 0xC2) | (byte > 0xC5)
        self.odd |= (self.inner < 0) | (self.last < 0)
        self.lower = np.where((byte >= 65) & (byte <= 90), byte + 32, byte).astype(np.uint8)
        two = [chr(c).lower().encode() if c != 0x130 else chr(c).encode() for c in range(0xC0, 0x180)]
        self.lead, self.second = (np.array([t[k] for t in two], dtype=np.uint8) for k in (0, 1))

    def library(self, words: list[str]) -> list[bytes]:
        """Ids by the library, packed little-endian unsigned 32-bit."""
        out = []
        for a in range(0, len(words), 20_000):
            out += [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(words[a:a + 20_000], add_special_tokens=False)]
        return out

    def merge(self, symbols: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all tokens one after another, ids per token)."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        none = np.zeros(0, np.int64)
        token, rows, ranks = none, np.zeros((0, 0), np.int32), np.zeros((0, 0), np.int32)
        by_length = np.argsort(length, kind="stable")
        bounds = np.searchsorted(length[by_length], np.arange(int(length.max(initial=0)) + 2))
        for size in range(int(length.max(initial=0)), 0, -1):
            fresh = by_length[bounds[size]:bounds[size + 1]]
            own = symbols[start[fresh][:, None] + np.arange(size)]
            token = np.concatenate([token, fresh])
            rows = np.concatenate([rows.reshape(-1, size), own])
            if size == 1:
                done.append((token, rows))
                break
            ranks = np.concatenate([ranks.reshape(-1, size - 1), self.ranks(own[:, :-1], own[:, 1:])])
            at = ranks.argmin(axis=1)
            n = np.arange(len(rows))
            best = ranks[n, at]
            stays = best == NONE
            if stays.any():
                done.append((token[stays], rows[stays]))
                go = ~stays
                token, rows, ranks, at, best, n = token[go], rows[go], ranks[go], at[go], best[go], np.arange(int(go.sum()))
            # the pair becomes its left symbol's place; the right one goes, and with it a rank
            rows[n, at] = self.ranks.merged[best]
            keep = np.ones(rows.shape, bool)
            keep[n, at + 1] = False
            rows = rows[keep].reshape(len(n), size - 1)
            keep = np.ones(ranks.shape, bool)
            keep[n, at] = False
            ranks = ranks[keep].reshape(len(n), size - 2)
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < size - 2)
            ranks[left, at[left] - 1] = self.ranks(rows[left, at[left] - 1], rows[left, at[left]])
            ranks[right, at[right]] = self.ranks(rows[right, at[right]], rows[right, at[right] + 1])
        count = np.zeros(len(length), np.int64)
        for token, rows in done:
            count[token] = rows.shape[1]
        first, out = np.cumsum(count) - count, np.empty(int(count.sum()), np.uint32)
        for token, rows in done:
            out[first[token][:, None] + np.arange(rows.shape[1])] = rows
        return out, count

    def table(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """(packed ids, place): ids of word k at ``place[k]`` of the list."""
        offsets = words.cast(pa.large_string())
        ends = np.frombuffer(offsets.buffers()[1], dtype=np.int64)[offsets.offset:offsets.offset + len(words) + 1]
        data = offsets.buffers()[2]
        text = np.frombuffer(data, dtype=np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
        begin, size = ends[:-1] - ends[0], np.diff(ends)
        # a running count of odd bytes tells the words that hold any
        odd = self.odd[text]
        high = np.flatnonzero(text >= 0xC3)
        high = high[~odd[high]]
        odd[high[(text[high] == 0xC4) & (text[high + 1] == 0xB0)]] = True  # its lower case is two characters
        seen = np.concatenate([[0], np.cumsum(odd)])
        plain = (seen[begin + size] == seen[begin]) & (size <= LONGEST)
        rest = np.flatnonzero(~plain)
        inside = np.repeat(plain, size)
        text = self.lower[text]
        high = high[inside[high]]
        code = (text[high].astype(np.int64) - 0xC3) * 64 + (text[high + 1] - 0x80)
        text[high], text[high + 1] = self.lead[code], self.second[code]
        kind = self.kind[text]
        sign = high[(text[high] == 0xC3) & ((text[high + 1] == 0x97) | (text[high + 1] == 0xB7))]
        kind[sign] = kind[sign + 1] = OTHER
        opens = np.ones(len(text), bool)
        opens[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        opens[begin[size > 0]] = True
        opens &= inside
        start = np.flatnonzero(opens)
        owner = np.repeat(np.arange(len(size)), size)
        closes = np.append(start[1:], len(text)) if len(start) else start
        closes = np.minimum(closes, (begin + size)[owner[start]])
        symbols = self.inner[text]
        symbols[closes - 1] = self.last[text[closes - 1]]
        ids, count = self.merge(symbols, start, closes - start)
        length = np.bincount(owner[start], count, len(size)).astype(np.int64)
        places = np.concatenate([[0], 4 * np.cumsum(length)])
        read = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(places), pa.py_buffer(ids.astype("<u4"))])
        place = np.arange(len(size))
        place[rest] = len(size) + np.arange(len(rest))
        others = pa.array(self.library(words.take(pa.array(rest)).to_pylist()), pa.large_binary())
        return pa.concat_arrays([read, others]), place
