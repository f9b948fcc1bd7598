"""Token ids and counts against the tokenizers' own libraries."""

from __future__ import annotations

import random
import struct

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from parley.llm import bpe, token_counts
from parley.llm.queries import all_queries
from tests.conftest import SF
from tests.llm import brute

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a", "b", " ", "\n", "é", "ß", "1", "'s", "'S", "!", "\x1c", " ", "日本", "ا", "²", "½", "Ⅷ", "😀", "é", "\t", "A", "\r\n", "᠎", "_"]
ODD += ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "Σ", "ΑΣ", "İ", "<|", "ſ"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.ranks_of(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def counter():
    return token_counts.Lengths(WORD_FILE)


def odd_texts(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ODD) * rnd.randint(1, rnd.choice([1, 3, 90])) for _ in range(rnd.randint(0, 25))) for _ in range(n)]


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def test_ids_equal_the_library(library):
    own = bpe.Encoder(RANKS, PATTERN)
    for text in odd_texts(1500):
        assert own.encode(text) == packed(library.encode_ordinary(text))


def test_every_character(library, counter):
    own, chars = bpe.Encoder(RANKS, PATTERN), [chr(c) for c in range(0x3400) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b{c}1{c} " for c in chars]
    assert [own.encode(t) for t in texts] == [packed(library.encode_ordinary(t)) for t in texts]
    found = counter.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [count(counter, t) for t in texts] == [len(e.ids) for e in found]


@pytest.mark.parametrize("leaf", [1, 3, 32])
def test_long_pieces_by_tree(library, monkeypatch, leaf):
    monkeypatch.setattr(bpe, "LEAF_BYTES", leaf)
    own, rnd = bpe.Encoder(RANKS, PATTERN), random.Random(4)
    texts = ["a" * 3000, " " * 3001, "ab" * 2000, "é" * 1001, "-" * 777 + "=" * 999]
    texts += ["".join(rnd.choice("abcdeinrst") for _ in range(rnd.randint(1, 900))) for _ in range(60)]
    for text in texts:
        assert own.encode(text) == packed(library.encode_ordinary(text))


def count(counter, text):
    pieces, special = counter.pieces(text)
    counter.learn([p for p in set(pieces) if p not in counter.cache])
    return sum(counter.cache[p] for p in pieces) + special


def test_counts_equal_the_library(counter):
    for text in odd_texts(1500, seed=3):
        assert count(counter, text) == len(counter.tokenizer.encode(text, add_special_tokens=False).ids)


def test_whole_tables(spark, documents, library, counter):
    rows = {r.doc_id: r for r in all_queries()["op4_byte_bpe"](spark, SF).collect()}
    counts = {r.doc_id: r for r in all_queries()["op8_token_counts"](spark, SF).collect()}
    assert len(rows) == len(counts) == len(documents)
    for d in documents:
        ids = library.encode_ordinary(d.text)
        assert rows[d.doc_id][1:] == (len(ids), brute.sha(packed(ids)), brute.sha(d.text.encode()))
        n = len(counter.tokenizer.encode(d.text, add_special_tokens=False).ids)
        assert counts[d.doc_id][1:] == (len(d.text.encode()), n, n > 2048)


def test_nulls_repeats_clashes_and_empty(frame):
    df = frame((1, None), (2, ""), (3, "hi there"), (3, "hi there"), (None, " ")).withColumn("TOKEN_IDS", F.lit(1))
    both = bpe.decode(bpe.encode(df, RANKS, PATTERN), RANKS, PATTERN)
    got = sorted((r.doc_id or 9, r.n_tokens, bytes(r.decoded)) for r in both.collect())
    assert got == [(1, 0, b""), (2, 0, b""), (3, 2, b"hi there"), (3, 2, b"hi there"), (9, 1, b" ")]
    counts = token_counts.count_tokens(df.withColumn("N_Tokens", F.lit(1)), WORD_FILE)
    assert sorted((r.doc_id or 9, r.n_tokens) for r in counts.collect()) == [(1, 0), (2, 0), (3, 2), (3, 2), (9, 0)]
    empty = df.where("false")
    assert bpe.encode(empty, RANKS, PATTERN).collect() == token_counts.count_tokens(empty, WORD_FILE).collect() == []


def test_full_caches_start_anew(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 5)
    own = bpe.Encoder(RANKS, PATTERN)
    text = " ".join(f"w{i}" for i in range(100))
    assert own.encode(text) == packed(library.encode_ordinary(text)) and len(own) <= 5
