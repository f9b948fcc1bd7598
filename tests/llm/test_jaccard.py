"""Components of near duplicates against a plain version."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from parley.llm import jaccard
from parley.llm.components import components
from parley.llm.queries import all_queries
from tests.conftest import SF
from tests.llm import brute


def labels(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect()}


def test_whole_table(spark, documents):
    rows = all_queries()["op6_jaccard_components"](spark, SF).collect()
    expected = brute.components([(d.doc_id, d.text) for d in documents])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert len(rows) == len(expected)


def edited(seed, docs=160):
    """Chains of edits, so that links are near the threshold and components longer than one link."""
    rnd = random.Random(seed)
    out, passage = [], [f"p{i}" for i in range(40)]
    for doc in range(docs):
        if out and rnd.random() < 0.7:
            w = rnd.choice(out)[1].split(" ")
            for _ in range(rnd.randint(0, 1 + len(w) // 40)):
                w[rnd.randrange(len(w))] = rnd.choice(["x", "Y", "z"]) + str(rnd.randint(0, 99))
        else:
            w = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.choice([3, 5, 20, 80, 200]))]
            if rnd.random() < 0.5:
                w += passage
        out.append((doc * 37 % docs, " ".join(w)))
    return out


def test_edited_copies(frame):
    for seed in range(2):
        docs = edited(seed)
        assert labels(frame(*docs)) == brute.components(docs)


def test_one_large_group(frame):
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for doc in range(400):
        w = list(base)
        w[rnd.randrange(120)] = f"n{doc}"
        docs.append((doc, " ".join(w)))
    assert labels(frame(*docs)) == brute.components(docs)


def test_small_tiles_meet_across_blocks(frame, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 3)
    monkeypatch.setattr(jaccard, "ROWS_AT_ONCE", 5)
    monkeypatch.setattr(jaccard, "PAIRS_AT_ONCE", 3)
    monkeypatch.setattr(jaccard, "PAIRS_IN_PLACE", 2)
    monkeypatch.setattr(jaccard, "OFTEN", 4)
    monkeypatch.setattr(jaccard, "IN_STRETCH", 2)
    docs = edited(9)
    assert labels(frame(*docs)) == brute.components(docs)


def test_nulls_empty_short_and_repeated(frame):
    df = frame((5, "a b"), (3, "A  B"), (9, "a c"), (1, None), (2, ""), (4, " \n"), (5, "a b"), (None, "a b"), (None, "q"))
    got = sorted((r.doc_id or 99, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect() if r.doc_id or r.component_id)
    assert got == [(1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 0, 4), (5, 1, 3), (5, 1, 3), (9, 1, 9), (99, 1, 3)]


def test_empty_table(frame):
    assert jaccard.near_duplicates(frame((1, "x")).where("false")).collect() == []


def test_bitmaps_bound_the_overlap():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        pool = rnd.integers(0, 1 << 60, 300).astype(np.uint64)
        a, b = (np.unique(rnd.choice(pool, rnd.integers(50, 250))) for _ in range(2))
        words = [np.frombuffer(jaccard.bitmap(x), np.uint64)[None, :] for x in (a, b)]
        sizes = [np.array([len(x)]) for x in (a, b)]
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            assert jaccard.may_be_linked(sizes[0], words[0], sizes[1], words[1]).all()


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (7, 900)], "u long, v long")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert roots == {**{i: 0 for i in range(201)}, 500: 500, 900: 0}


def test_pairs_without_round_one(frame, monkeypatch):
    """All links found by tiles and bitmaps alone."""
    monkeypatch.setattr(jaccard, "nearest_heads", lambda tiled: tiled.select(F.col("node").alias("u"), F.col("node").alias("v")).where("false"))
    docs = edited(4)
    assert labels(frame(*docs)) == brute.components(docs)
