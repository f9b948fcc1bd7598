from __future__ import annotations

import numpy as np
import pytest

from parley.llm import neighbours

VECTORS = "vec_id long, embedding array<float>"


def found(spark, rows, every=100, k=10):
    vectors = neighbours.usable(spark.createDataFrame(rows, VECTORS)).cache()
    out = {}
    for r in sorted(neighbours.nearest(vectors, vectors.where(f"id % {every} = 0"), k).collect(), key=lambda r: r["rank"]):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def plain(vectors, every=100, k=10):
    out = {}
    for q, x in vectors.items():
        if q % every == 0:
            near = sorted((float(np.sqrt(np.cumsum((np.float64(y) - np.float64(x)) ** 2)[-1])), v) for v, y in vectors.items() if v != q and len(y) == len(x))
            if near:
                out[q] = [(v, s) for s, v in near[:k]]
    return out


@pytest.mark.parametrize(("scale", "side"), [(1.0, 100), (1.0, 7), (1e-20, 100), (1e15, 100)])
def test_exact_over_many_tiles(spark, monkeypatch, scale, side):
    monkeypatch.setattr(neighbours, "TILE_BYTES", 8 * 16 * side)
    monkeypatch.setattr(neighbours, "PRODUCTS", 700)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(900, 16)) * scale * rng.choice([0.01, 1, 50], size=(900, 1))
    base[500:560] = base[3]  # ties
    vectors = {i: np.float32(v) for i, v in enumerate(base)}
    got = found(spark, [(i, [float(x) for x in v]) for i, v in vectors.items()], every=20)
    assert got == plain(vectors, every=20)


def test_nulls_zeros_repeats_and_few(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]),
        (6, []), (7, [1.0, 1.0]), (8, [2.0, 0.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (100, [5.0, 5.0, 5.0, 5.0]), (200, None),
    ]
    assert found(spark, rows) == {0: [(7, 1.0), (8, 1.0)]}
    assert found(spark, [(1, [0.0])]) == {}


def test_one_vector_many_times(spark):
    rows = [(i, [1.0, 2.0]) for i in range(300)]
    assert found(spark, rows)[0] == [(i, 0.0) for i in range(1, 11)]


def test_different_vectors_of_one_id_compete(spark):
    """Rows stand on their own, as in the query's SQL; only exact repeats count once."""
    rows = [(0, [1.0, 0.0]), (7, [9.0, 0.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (8, [3.0, 0.0]), (100, [5.0, 0.0]), (100, [8.0, 0.0])]
    got = found(spark, rows)
    assert got[0] == [(7, 1.0), (8, 2.0), (100, 4.0), (100, 7.0), (7, 8.0)]
    assert got[100][:3] == [(7, 1.0), (8, 2.0), (0, 4.0)]
    assert len(got[100]) == 8
