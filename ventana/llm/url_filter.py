"""URL filter: every glob rule at once with a bit-parallel automaton.

Rules are packed side by side into Shift-And masks of 64-bit words. Each
literal character of a rule is one bit; ``*`` (any run without ``/``) and
``**`` (any run) are loops on the bit before them that also let the next
character follow at once. All rules move over a canonical URL (host + path)
together: one shift, two ands and an or per character, whatever their number.
A batch of URLs is moved in step, longest first, so a batch costs as many
vector operations as its longest URL has bytes and holds no padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ventana.llm.common import pick, spans

ALLOW, BLOCK = "allow", "block"
BATCH_BYTES = 4_000_000


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, paths that start with ``path``."""
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> list[str]:
        return [f"{self.host}{self.path}**", f"*.{self.host}{self.path}**"]


#: The method's own verdict where no rule fits: block these canonical URLs, allow the rest.
DEFAULT_BLOCKED = ("*spam*/**", "*spam*", "*pills*/**", "*pills*", "*casino*/**", "*casino*")


class Automaton:
    """Shift-And over bytes for many globs; ``run`` tells which fit whole strings."""

    def __init__(self, globs: list[str]):
        literal: list[int] = []     # byte of each bit
        loops: list[tuple[int, bool]] = []  # (bit before a wildcard, it may pass '/')
        starts, finals = [], []
        for glob in globs:
            # bit 0 of a rule is its start: set before the first character
            starts.append(len(literal))
            literal.append(-1)
            data, i = glob.encode(), 0
            while i < len(data):
                if data[i:i + 2] == b"**":
                    loops.append((len(literal) - 1, True))
                    i += 2
                elif data[i:i + 1] == b"*":
                    loops.append((len(literal) - 1, False))
                    i += 1
                else:
                    literal.append(data[i])
                    i += 1
            finals.append(len(literal) - 1)
        self.words = max(1, -(-len(literal) // 64))
        self.start = self._mask(starts)
        self.finals = [(f // 64, np.uint64(1 << (f % 64))) for f in finals]
        self.step = np.zeros((256, self.words), dtype=np.uint64)
        self.stay = np.zeros((256, self.words), dtype=np.uint64)
        for bit, byte in enumerate(literal):
            if byte >= 0:
                self.step[byte, bit // 64] |= np.uint64(1 << (bit % 64))
        every, within = self._mask([b for b, all_ in loops if all_]), self._mask([b for b, all_ in loops if not all_])
        self.stay[:] = every | within
        self.stay[ord("/")] = every

    def _mask(self, bits: list[int]) -> np.ndarray:
        out = np.zeros(self.words, dtype=np.uint64)
        for b in bits:
            out[b // 64] |= np.uint64(1 << (b % 64))
        return out

    def run(self, urls: list[bytes]) -> np.ndarray:
        """Boolean matrix: url x glob, whether the glob fits the whole url."""
        size = np.array([len(u) for u in urls], dtype=np.int64)
        order = np.argsort(-size, kind="stable")
        flat = np.frombuffer(b"".join(urls[i] for i in order), dtype=np.uint8)
        size = size[order]
        begin = np.cumsum(size) - size
        state = np.tile(self.start, (len(urls), 1))
        one, top = np.uint64(1), np.uint64(63)
        for t in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -t, side="left"))  # urls longer than t
            byte = flat[begin[:live] + t]
            now = state[:live]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:live] = (moved & self.step[byte]) | (now & self.stay[byte])
        out = np.empty((len(urls), len(self.finals)), dtype=bool)
        for g, (word, bit) in enumerate(self.finals):
            out[order, g] = (state[:, word] & bit) != 0
        return out


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``? #`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(pages: DataFrame, rules: list[Rule], blocked: tuple[str, ...] = DEFAULT_BLOCKED,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row.

    A rule fits its host and all subdomains where the path starts with the
    rule's; the longest fits win (equal length: the longer host, then block).
    Without a rule the ``blocked`` globs decide. A null URL or one without
    ``://`` has empty host and path, no rule, and is allowed unless a glob
    fits the empty string. One pass over the URL column alone, no shuffle;
    repeated rows, null ids, empty tables and clashing columns pass through
    with nothing special.
    """
    rank = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict != BLOCK))
    globs = [g for r in rank for g in r.globs()]
    names, verdicts = [r.name for r in rank], [r.verdict for r in rank]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Automaton([*globs, *blocked])
        for batch in spans(batches, "canonical", BATCH_BYTES):
            hit = machine.run([u.encode() for u in batch.column("canonical").to_pylist()])
            by_rule = hit[:, 0:len(globs):2] | hit[:, 1:len(globs):2]
            first = np.where(by_rule.any(axis=1), by_rule.argmax(axis=1), -1) if names else np.full(len(hit), -1)
            bad = hit[:, len(globs):].any(axis=1)
            rule = [names[i] if i >= 0 else None for i in first]
            verdict = [verdicts[i] if i >= 0 else (BLOCK if b else ALLOW) for i, b in zip(first, bad)]
            cols = [batch.column(c) for c in ("page_id", "host", "path")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                                             ["page_id", "host", "path", "rule", "verdict"])

    src = pick(pages, page_id=id_col, url=url_col)
    kind = src.schema["page_id"].dataType.simpleString()
    src = src.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    src = src.withColumn("canonical", F.concat("host", "path"))
    return src.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")
