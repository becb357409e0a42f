"""Word shingles as sets of 64-bit hashes, and MinHash signatures of them."""

from __future__ import annotations

import re
from hashlib import blake2b

import numpy as np

from ventana.llm.common import Memo

WORDS = re.compile(r"\w+")


def word_hash(word: str) -> int:
    return int.from_bytes(blake2b(word.lower().encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct hashes of a text's runs of ``n`` words (lower-cased
    ``\\w+``). A text of fewer words, but at least one, has one shingle of them all."""

    def __init__(self, n: int = 5):
        self.n, self.memo = n, Memo(word_hash)

    def __call__(self, text: str) -> np.ndarray:
        words = WORDS.findall(text)
        h = np.fromiter(map(self.memo.__getitem__, words), dtype=np.uint64, count=len(words))
        n = min(self.n, len(h))
        if not n:
            return h
        out = np.zeros(len(h) - n + 1, dtype=np.uint64)
        for j in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - n + 1 + j]
        return np.unique(mix(out))


class MinHash:
    """``size`` minimal hashes of a set, one byte kept of each: equal bytes
    stand for equal minima up to one chance in 256."""

    def __init__(self, size: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.factor = rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.offset = rng.integers(0, 1 << 63, size, dtype=np.uint64)

    def __call__(self, sets: list[np.ndarray]) -> np.ndarray:
        """set x size bytes; the sets are not empty."""
        begin = np.cumsum([0] + [len(s) for s in sets[:-1]])
        flat = np.concatenate(sets)
        out = np.empty((len(sets), len(self.factor)), dtype=np.uint8)
        for k, (a, b) in enumerate(zip(self.factor, self.offset)):
            least = np.minimum.reduceat((flat ^ b) * a, begin)
            out[:, k] = (mix(least) >> np.uint64(56)).astype(np.uint8)
        return out
