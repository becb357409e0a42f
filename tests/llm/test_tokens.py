"""op1 and op9 against the libraries, op5 against the ids they give."""
import random
import struct
import zlib

import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer, models

from ventana.llm import bpe, packing, token_counts

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
MODEL = P.path("piece_bpe_32k.model")
WORDS = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoder():
    return bpe.Tokenizer(bpe.read_ranks(bpe.read_vocabulary(RANKS)), P.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.read_vocabulary(RANKS)), special_tokens={})


def test_bpe_equals_library(encoder, library):
    rng = random.Random(1)
    letters = "aabbcc  \x1c\x85\u2028\u3000²½Ⅷ一\n\téße0123'stre%%%...漢字🙂\x00ZQ"
    for _ in range(3000):
        s = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        assert encoder.encode(s) == encoder.pack(library.encode_ordinary(s)), repr(s)
    for s in ["a" * 3000, " " * 3000, "thethe" * 500, "=-" * 2000, "abcdefgh" * 300]:
        assert encoder.encode(s) == encoder.pack(library.encode_ordinary(s))


def test_bpe_steps_back_from_the_longest_match():
    ranks = {bytes([c]): c for c in range(256)}
    for token in (b"ab", b"cd", b"bc", b"abc", b"abcd"):
        ranks[token] = len(ranks)
    enc = bpe.Encoder(ranks)
    for piece in (b"abc", b"abcd", b"abcdabc", b"aabcbcd", b"bcd", b"xabcy"):
        whole = ranks.get(piece)
        assert enc.encode(piece) == ([whole] if whole is not None else enc.merge(piece)), piece


def test_bpe_rows(spark, messy, no_docs, library):
    ids = bpe.encode(spark, messy, RANKS, P.PATTERN)
    back = bpe.decode(spark, ids, RANKS).collect()
    source = {(r[0], r[1]) for r in messy.collect()}
    assert len(back) == messy.count()
    assert {(r.doc_id, r.decoded.decode()) for r in back} == {(i, t or "") for i, t in source}
    for r in back:
        assert list(struct.unpack(f"<{len(r.token_ids) // 4}I", r.token_ids)) == library.encode_ordinary(r.decoded.decode())
    assert bpe.encode(spark, no_docs, RANKS, P.PATTERN).count() == 0


def test_token_counts_equal_library(spark, messy, no_docs):
    pieces = token_counts.read_pieces(bpe.read_vocabulary(MODEL))
    ref = Tokenizer(models.Unigram([(p, s) for p, s, _ in pieces], 0, True))
    counter = token_counts.Counter(pieces)

    def expected(s):
        return len(ref.encode("▁" + s.replace(" ", "▁")).ids) if s else 0

    rng = random.Random(2)
    letters = "aabbcc  \n\té▁漢字🙂qzx0123 the ing er"
    for _ in range(2000):
        s = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert counter.count(s) == expected(s), repr(s)
    got = token_counts.count_tokens(spark, messy, MODEL).collect()
    want = sorted((str(r[0]), expected(r[1] or ""), len(r[1] or "")) for r in messy.collect())
    assert sorted((str(r.doc_id), r.n_tokens, r.n_chars) for r in got) == want
    assert token_counts.count_tokens(spark, no_docs, MODEL).count() == 0


def test_token_counts_of_a_text_longer_than_a_batch(monkeypatch):
    counter = token_counts.Counter(token_counts.read_pieces(bpe.read_vocabulary(MODEL)))
    text = "some words  of a text, and more of it " * 40
    whole = counter.count(text)
    monkeypatch.setattr(token_counts, "BATCH_CHARS", 50)
    assert counter.count(text) == whole


def check_pieces(rows, texts_by_id, window):
    lib = Tokenizer.from_file(WORDS)
    ids = {k: [*lib.encode(t or "", add_special_tokens=False).ids, packing.END_ID] for k, t in texts_by_id.items()}
    seen = {k: [] for k in ids}
    for r in rows:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert r.length == len(part) > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert zlib.crc32(bytes(r.ids)) == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
        seen[r.doc_id].append((r.start, r.start + r.length))
    for k, cuts in seen.items():
        cuts.sort()
        assert cuts[0][0] == 0 and cuts[-1][1] == len(ids[k]) and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))
    full = {}
    for r in rows:
        full.setdefault(r.sequence_id, []).append((r.offset, r.offset + r.length))
    assert sorted(full) == list(range(len(full)))
    for s, cuts in full.items():
        cuts.sort()
        assert cuts[0][0] == 0 and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))
        assert cuts[-1][1] == window or s == len(full) - 1


def test_packing(spark, messy, no_docs, monkeypatch):
    unique = messy.dropDuplicates(["doc_id"]).repartition(3)
    texts_by_id = {r[0]: r[1] for r in messy.collect()}
    check_pieces(packing.pack(spark, unique, WORDS, window=64).collect(), texts_by_id, 64)
    assert packing.pack(spark, no_docs, WORDS).count() == 0
    twice = packing.pack(spark, messy, WORDS, window=64)
    assert twice.where("doc_id = 4").agg({"length": "sum"}).first()[0] == 2 * twice.where("doc_id = 4").first().doc_tokens


def test_word_ids_equal_library():
    lib, enc, rng = Tokenizer.from_file(WORDS), packing.WordEncoder(bpe.read_vocabulary(WORDS)), random.Random(3)
    letters = "aabbccZQÉİΣσ \t\n\x0b\x1c\x85\u2028\u3000e\u0301<|endoftext|>.,'st0123漢字🙂\x00"
    rows = ["\x1c odd\u2028 İstanbul ΟΔΟΣ cafe\u0301 don't 12", None, "", "a" * 500 + " b. c, <|endoftext|> x<|endoftext|>.", "\n", "Σ. ß, É. <|EndOfText|>."]
    rows += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(4000)]
    plain = "abcdeABCDEtheingSTéÉÀ×÷ŸİĲŁłſß0129.,-!#| \n" + "".join(map(chr, range(0xC0, 0x180)))
    rows += ["".join(rng.choice(plain) for _ in range(rng.randint(0, 90))) for _ in range(6000)]
    rows += [" ".join(rng.choice(["thinking", "interest", "aaaaaaa", "ABABAB", "the", "unbelievable", "x" * 49, "é" * 24]) for _ in range(9)) for _ in range(500)]
    for a in range(0, len(rows), 1000):
        some = rows[a:a + 1000]
        size, ids = enc.encode(pa.array(some))
        ends, ids = size.cumsum(), ids.to_pybytes()
        for t, n, e in zip(some, size, ends):
            want = [*lib.encode(t or "", add_special_tokens=False).ids, packing.END_ID]
            assert list(struct.unpack(f"<{n // 4}I", ids[e - n:e])) == want, repr(t)


def test_packing_cuts_long_documents_into_rows(spark, monkeypatch):
    long = "one two 3 " * 30_000
    df = spark.createDataFrame([(1, long), (2, None), (3, long), (4, "a b")], "doc_id long, text string").coalesce(1)
    check_pieces(packing.pack(spark, df, WORDS, window=2048).collect(), {1: long, 2: None, 3: long, 4: "a b"}, 2048)
