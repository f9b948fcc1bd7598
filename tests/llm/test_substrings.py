"""Byte and word repeats against plain versions."""

from __future__ import annotations

import random
from dataclasses import replace

import numpy as np
import pytest

from parley.llm import lz_dedup, suffix_dedup, windows
from parley.llm.queries import all_queries
from tests.conftest import SF
from tests.llm import brute


def bytes_left(df):
    return {
        r.doc_id: (r.bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept)))
        for r in suffix_dedup.remove_repeats(df).collect()
    }


def words_left(df):
    return {
        r.doc_id: (r.n_tokens, r.n_removed, brute.sha(bytes(r.kept)))
        for r in lz_dedup.remove_repeats(df).collect()
    }


def test_whole_table_bytes(spark, documents):
    rows = all_queries()["op5_suffix_dedup"](spark, SF).collect()
    expected = brute.byte_repeats([(d.doc_id, d.text) for d in documents])
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == expected
    assert len(rows) == len(expected)


def test_whole_table_words(spark, documents):
    rows = all_queries()["op10_lz_dedup"](spark, SF).collect()
    expected = brute.word_repeats([(d.doc_id, d.text) for d in documents])
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == expected
    assert len(rows) == len(expected)


def passages(seed):
    """Documents made of few passages, cut and joined at random, so that windows repeat in many ways."""
    rnd = random.Random(seed)
    base = [" ".join(rnd.choice("ab cd e fgh ij".split()) + str(rnd.randint(0, 30)) for _ in range(60)) for _ in range(4)]
    docs = []
    for doc in range(40):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(base).split(" ")
            i = rnd.randint(0, 40)
            parts += p[i : i + rnd.randint(1, 40)]
            if rnd.random() < 0.3:
                parts.append(f"x{rnd.randint(0, 3)}")
        docs.append((doc * 7 % 41, " ".join(parts)))
    return docs


@pytest.mark.parametrize("rows_at_once", [1, 40, 1 << 17])
def test_cut_passages(frame, monkeypatch, rows_at_once):
    """Whatever a task settles before the shuffle, and whatever is left to it."""
    monkeypatch.setattr(windows, "ROWS_AT_ONCE", rows_at_once)
    docs = passages(rows_at_once)
    assert bytes_left(frame(*docs)) == brute.byte_repeats(docs)
    assert words_left(frame(*docs)) == brute.word_repeats(docs)


@pytest.mark.parametrize(("crowd", "at_once"), [(0, 1), (0, 30), (3, 1 << 14)])
def test_crowded_minimizers(frame, monkeypatch, crowd, at_once):
    for module in (lz_dedup, suffix_dedup):
        monkeypatch.setattr(module, "KIND", replace(module.KIND, crowd=crowd))
    monkeypatch.setattr(windows, "WINDOWS_AT_ONCE", at_once)
    docs = passages(5)
    assert bytes_left(frame(*docs)) == brute.byte_repeats(docs)
    assert words_left(frame(*docs)) == brute.word_repeats(docs)


def test_periodic_and_long_texts(frame):
    docs = [
        (1, "a" * 5000),
        (2, "b " * 3000),
        (3, "ab" * 70_000 + "a" * 99),
        (4, "x" + "é" * 120),
        (5, " ".join(str(i % 17) for i in range(2000))),
        (6, " ".join(str(i) for i in range(20_000))),
        (7, " ".join(str(i) for i in range(5, 19_000))),
    ]
    assert bytes_left(frame(*docs)) == brute.byte_repeats(docs)
    assert words_left(frame(*docs)) == brute.word_repeats(docs)


def test_nulls_repeated_rows_and_other_columns(spark, frame):
    text = " ".join(f"w{i}" for i in range(60))
    size = len(text)
    df = frame((1, None), (2, ""), (3, text), (3, text), (4, text), (None, text), (5, " \n "))
    df = df.withColumn("kept", df.lang).withColumn("START", df.lang)
    left = sorted((r.doc_id or 99, r.bytes, r.n_removed) for r in suffix_dedup.remove_repeats(df).collect())
    assert left == [(1, 0, 0), (2, 0, 0), (3, size, 0), (3, size, 0), (4, size, size), (5, 3, 0), (99, size, size)]
    left = sorted((r.doc_id or 99, r.n_tokens, r.n_removed) for r in lz_dedup.remove_repeats(df).collect())
    assert left == [(1, 0, 0), (2, 0, 0), (3, 60, 0), (3, 60, 0), (4, 60, 60), (5, 0, 0), (99, 60, 60)]


def test_rows_of_one_id_with_different_texts(frame):
    shared = " ".join(f"w{i}" for i in range(60))
    df = frame((1, "p " + shared), (1, "q " + shared), (2, shared))
    assert sorted(r.n_removed for r in lz_dedup.remove_repeats(df).collect()) == [0, 0, 60]
    assert sorted(r.n_removed for r in suffix_dedup.remove_repeats(df).collect()) == [
        0,
        len(shared),
        len(shared) + 1,
    ]


def test_empty_table(frame, spark):
    none = frame((1, "x")).where("false")
    assert suffix_dedup.remove_repeats(none).collect() == []
    assert lz_dedup.remove_repeats(none).collect() == []


def test_bounds_equal_common_prefixes():
    rnd = random.Random(0)
    for _ in range(200):
        spans = [[rnd.randint(1, 3) for _ in range(rnd.randint(0, 30))] for _ in range(rnd.randint(1, 5))]
        codes = np.array([c for span in spans for c in [*span, 0]], np.int64)
        # What each suffix is compared as: its characters up to the 0, which is its span's own.
        ends = np.flatnonzero(codes == 0).tolist()
        text = []
        for i in range(len(codes)):
            end = next(e for e in ends if e >= i)
            text.append([*codes[i:end].tolist(), -1000 + end])
        length = rnd.randint(1, 6)
        order = suffix_dedup.suffix_array(codes)
        assert order.tolist() == sorted(range(len(codes)), key=lambda i: text[i])
        parted = suffix_dedup.common_prefix_bounds(codes, order, length)
        for i in range(1, len(codes)):
            a, b = text[order[i - 1]], text[order[i]]
            shared = next(k for k in range(len(a)) if a[k] != b[k])
            assert parted[i] == (shared < length)


def test_searches_equal_plain_ones():
    rnd = random.Random(1)
    for _ in range(200):
        length, m = rnd.randint(2, 5), rnd.randint(1, 8)
        spans = [bytes(rnd.choice(b"ab") for _ in range(length + rnd.randint(0, 6))) for _ in range(m)]
        doc, tie, start = np.array([rnd.randint(0, 3) for _ in spans]), np.zeros(m, int), np.arange(m) * 100
        n = np.array([len(s) - length + 1 for s in spans])
        wins = [(spans[i][j : j + length], (doc[i], start[i] + j), (i, j)) for i in range(m) for j in range(n[i])]
        first = {w: min(o for v, o, _ in wins if v == w) for w, _, _ in wins}

        def found(search, texts):
            runs = zip(*[x.tolist() for x in search(texts, doc, tie, start, n, length)])
            return {(a, b + j) for a, b, k in runs for j in range(k)}

        assert found(suffix_dedup.repeated, spans) == {r for w, o, r in wins if o > first[w]}
        as_words = [b" ".join(bytes([c]) for c in s) for s in spans]
        assert found(lz_dedup.factors, as_words) == {r for w, o, r in wins if o[0] > first[w][0]}


def test_every_window_has_one_anchor():
    tokens = np.array([random.Random(3).randint(0, 5) for _ in range(70_000)], np.uint64)
    _, _, start, n = windows.anchors(tokens, 100, 24)
    assert n.sum() == len(tokens) - 99
    assert (np.cumsum(n) - n == start).all()


def test_word_hashes():
    rnd = random.Random(8)
    vocabulary = ["".join(rnd.choice("abé0\xa0.") for _ in range(rnd.randint(1, 9))) for _ in range(3000)]
    vocabulary += ["x" * 600, "x" * 601, "y" * 600, "a" * 512, "a" * 513]
    hashes = {}
    for _ in range(300):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))]
        text = rnd.choice(["", " ", "\n\t"]) + "".join(w + rnd.choice([" ", "\n", " \x0b\x0c\r "]) for w in words)
        found = windows.word_hashes(text.encode())
        assert windows.split_words(text) == [w.encode() for w in words]
        assert len(found) == len(words)
        for w, h in zip(words, found.tolist()):
            assert hashes.setdefault(w, h) == h
    assert len(set(hashes.values())) == len(hashes)
