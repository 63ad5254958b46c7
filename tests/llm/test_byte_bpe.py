"""Byte-level BPE by tree reduction: equal to the library, exact round trip."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from gearbox.llm import byte_bpe
from gearbox.llm.byte_bpe import ByteBpe
from gearbox.llm.queries import QUERIES

ALPHABETS = ["ab", "z", "=-", "abcdefghijklmnopqrstuvwxyz", "  \n\t a", "éèàaou", "0123456789", "日本語のに", "\U0001f600x",
             "".join(map(chr, range(256)))]


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe.of(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def brute(bpe, piece):
    """Tokens by the definition: the adjacent pair of lowest rank, leftmost, until none is a token."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while True:
        pairs = [(bpe.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in bpe.ranks]
        if not pairs:
            return parts
        i = min(pairs)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("n", [1, 3, 9, 33, 200, 3000])
def test_equals_the_library(bpe, library, n):
    draw = random.Random(n)
    for alphabet in ALPHABETS * 3:
        text = "".join(draw.choice(alphabet) for _ in range(n))
        assert ids(bpe.encode(text)) == library.encode_ordinary(text), text
        assert bpe.decode(bpe.encode(text)) == text.encode()


def test_every_character(bpe, library):
    for c in list(range(0x250)) + list(range(0x250, 0x110000, 97)):
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}b1{chr(c)} {chr(c)}{chr(c)}.{chr(c)}"
            assert ids(bpe.encode(text)) == library.encode_ordinary(text), hex(c)


def test_tree_equals_direct_merging(bpe):
    draw = random.Random(5)
    for _ in range(150):
        piece = bytes(draw.choice(draw.choice([b"ab", b"the quick", b"zzzz", bytes(range(256))])) for _ in range(draw.randrange(1, 120)))
        assert bpe.tree(piece) == brute(bpe, piece) == bpe.merge(piece)


def test_any_two_segments_join(bpe):
    draw = random.Random(6)
    for _ in range(300):
        a, b = ("".join(draw.choice("aehinrst") for _ in range(draw.randrange(0, 40))).encode() for _ in range(2))
        assert bpe.join(bpe.tree(a), bpe.tree(b)) == brute(bpe, a + b)


def test_stable_pairs(bpe):
    """Two tokens are stable if and only if their bytes encode to them."""
    draw = random.Random(7)
    tokens = sorted(t for t in bpe.ranks if len(t) < 9 and brute(bpe, t) == [t])
    common = [t for t in tokens if set(t) <= set(b" aehinrst")]
    seen = set()
    for pool in (tokens, common, common):
        for _ in range(1500):
            a, b = draw.choice(pool), draw.choice(pool)
            assert bpe.stable(a, b) == (brute(bpe, a + b) == [a, b]), (a, b)
            seen.add(bpe.stable(a, b))
    assert seen == {True, False}


def test_a_vocabulary_of_its_own():
    """Boundaries move far: the runs of a join are re-encoded to their ends."""
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"ba": 257, b"abab": 258, b"bab": 259, b"aba": 260}
    own = ByteBpe(ranks, r"[\s\S]+")
    for n in range(1, 90):
        for text in ("ab" * n, "ba" * n, "ab" * n + "a", "a" + "ab" * n):
            assert own.tree(text.encode()) == brute(own, text.encode())


def test_words_forgotten_are_encoded_again(bpe, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "WORDS", 5)
    monkeypatch.setattr(byte_bpe, "MATCHES", 7)
    text = " ".join(f"word{i % 13} some{i % 5}" for i in range(300))
    assert ids(bpe.encode(text)) == library.encode_ordinary(text)


def test_rows(spark, odd_docs, no_docs, library):
    rows = byte_bpe.digest(byte_bpe.decode(byte_bpe.encode(odd_docs))).collect()
    texts = [r["text"] or "" for r in odd_docs.collect()]
    want = []
    for t in texts:
        tokens = library.encode_ordinary(t)
        want.append((len(tokens), hashlib.sha256(np.array(tokens, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows) == sorted(want)
    assert byte_bpe.digest(byte_bpe.decode(byte_bpe.encode(no_docs))).count() == 0
    own = spark.createDataFrame([(1, None), (2, b"")], "doc_id long, ids binary")
    assert [r["bytes"] for r in byte_bpe.decode(own).collect()] == [b"", b""]


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op13_byte_bpe"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        tokens = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(tokens)
        assert r["ids_sha256"] == hashlib.sha256(np.array(tokens, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
