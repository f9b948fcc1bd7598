"""Nearest neighbours by a block matrix join.

Queries and candidates are dealt into blocks, and each pair of blocks is one tile of work. In a tile,
products of int8 codes give all squared distances up to a bound on the quantisation error. A candidate
whose lower bound lies above the k-th smallest upper bound of the query cannot be among its nearest;
the others are computed in double precision. The tiles' best are merged by heaps. The result is exact.

Both sides of a tile are as large as memory allows: ``TILE_BYTES`` as doubles, with d dimensions
S = TILE_BYTES / 8 d vectors. So n candidates are copied ceil(m / S) times for m queries, and queries ceil(n / S) times, or as
often as gives every core a tile. With 64 dimensions S is 32,768: a million candidates and ten thousand queries are copied
once and 31 times, 1.3 times the input; all pairs of tiles are computed, so copies grow with m beyond that.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import to_batch

TILE_BYTES = 16 << 20
#: No fewer candidates in a tile just to have more tiles, and products that are held at a time.
LEAST_CANDIDATES, PRODUCTS = 2048, 1 << 22
#: Sums of int8 products stay exact in single precision up to this many dimensions.
EXACT_IN_SINGLE = (1 << 24) // (127 * 127)
NEAREST = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Ids with their vectors; those that are null, empty or zero or hold null or non-finite parts are left out.

    Rows without an id are left out too. Repeated rows count once; different vectors of one id are rows of
    their own.
    """
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{embedding}`").alias("v"))
        .where(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
        .distinct()
    )


def _codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of the rows, their scales, and the exact norm of what the codes miss."""
    scale = np.abs(x).max(axis=1) / 127
    scale[scale == 0] = 1  # parts so small that the division gave zero
    codes = np.rint(x / scale[:, None])
    return codes, scale, np.linalg.norm(x - codes * scale[:, None], axis=1)


def _distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances, parts added in order, so that equal vectors get equal distances."""
    return np.sqrt(np.cumsum((x - q) ** 2, axis=1)[:, -1])


def nearest_in_tile(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int):
    """For each query its ``k`` nearest of ``x`` other than itself: (query row, places in x, scores)."""
    x_codes, x_scale, x_missed = _codes(x)
    q_codes, q_scale, q_missed = _codes(q)
    kind = np.float32 if x.shape[1] <= EXACT_IN_SINGLE else np.float64
    x_codes, q_codes = x_codes.astype(kind).T, q_codes.astype(kind)
    x_norm, q_norm = np.linalg.norm(x, axis=1), np.linalg.norm(q, axis=1)
    held = max(1, PRODUCTS // len(x))
    for row in range(len(q)):
        if row % held == 0:
            products = q_codes[row : row + held] @ x_codes
        about = x_norm**2 + q_norm[row] ** 2 - 2 * products[row % held].astype(np.float64) * x_scale * q_scale[row]
        off = 2 * ((x_norm + x_missed) * q_missed[row] + x_missed * q_norm[row])
        off += 1e-9 * (x_norm**2 + q_norm[row] ** 2)  # rounding of the sums above
        others = ids != query_ids[row]
        high = np.where(others, about + off, np.inf)
        limit = np.partition(high, k - 1)[k - 1] if k < len(high) else np.inf
        left = np.flatnonzero(others & (about - off <= limit))
        scores = _distances(x[left], q[row])
        best = np.lexsort((ids[left], scores))[:k]
        yield row, left[best], scores[best]


def _matrices(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors as matrices, by number of dimensions."""
    lists = table["v"].combine_chunks()
    ids, sizes = table["id"].to_numpy(), np.diff(lists.offsets.to_numpy())
    flat, starts = lists.flatten().to_numpy().astype(np.float64), np.concatenate(([0], np.cumsum(sizes)))
    found = {}
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        found[int(size)] = ids[rows], flat[starts[rows][:, None] + np.arange(size)]
    return found


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` nearest of ``vectors`` (id, v) for each row of ``queries`` (id, v), exactly.

    Returns query_id, rank from 1, vec_id and score, the Euclidean distance in double precision; ties go
    to the smaller id. A query's own id is no candidate, nor are vectors of another length. With fewer
    candidates all are returned; a query without any has no rows. Where an id stands on several vectors,
    each is a candidate, and a query id has the ``k`` nearest to any of its vectors. Both inputs are read twice, so they
    should be stored tables. Tiles are of like size, however large or skewed the inputs.
    """
    n, width = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    side = max(1, TILE_BYTES // (8 * max(1, width or 0)))
    rows = max(1, -(-queries.count() // side))
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    columns = max(1, -(-n // side), min(-(-2 * cores // rows), -(-n // LEAST_CANDIDATES)))

    def dealt(df: DataFrame, own: str, parts: int, other: str, copies: int) -> DataFrame:
        place = F.pmod(F.xxhash64("id", "v"), F.lit(parts)).cast("int")
        return df.select("id", "v", place.alias(own)).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
        )

    def tile(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        known = _matrices(candidates)
        for size, (query_ids, q) in _matrices(asked).items():
            if size in known:
                ids, x = known[size]
                found += [
                    (np.full(len(at), query_ids[row]), ids[at], scores)
                    for row, at, scores in nearest_in_tile(ids, x, query_ids, q, k)
                ]
        fields = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        return pa.Table.from_batches([to_batch(fields, map(np.concatenate, zip(*found)))])

    tiles = (
        dealt(vectors, "col", columns, "row", rows)
        .groupBy("col", "row")
        .cogroup(dealt(queries, "row", rows, "col", columns).groupBy("col", "row"))
        .applyInArrow(tile, NEAREST)
    )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list[tuple[float, int]]] = defaultdict(list)
        for batch in batches:
            for query, vec, score in zip(*[c.to_pylist() for c in batch.columns]):
                heap, entry = heaps[query], (-score, -vec)
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                else:
                    heapq.heappushpop(heap, entry)
        rows = [
            (query, rank, -vec, -score)
            for query, heap in heaps.items()
            for rank, (score, vec) in enumerate(sorted(heap, reverse=True), 1)
        ]
        fields = {"query_id": pa.int64(), "rank": pa.int32(), "vec_id": pa.int64(), "score": pa.float64()}
        for at in range(0, len(rows), 4096):
            yield to_batch(fields, zip(*rows[at : at + 4096]))

    return tiles.repartition("query_id").mapInArrow(
        merged, "query_id long, rank int, vec_id long, score double"
    )
