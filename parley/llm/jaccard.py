"""Jaccard join over word shingles by size-banded tiles with bitmap signatures.

A tile holds the texts that share one shingle of their prefixes: two sets that overlap enough share a
shingle among the first few of each in any common order. Shingles of many texts come last in that
order. Within a tile, texts of like size are compared by bitmaps: each shingle flips one bit, so the
bits in which two bitmaps differ count no more than the shingles that only one set has, and the overlap
is bounded from above. What passes is decided exactly, by intersecting sorted arrays.

Tiles of many copies are not compared pair by pair. Each text is first checked against the one it
shares most tiles with, and only texts not yet connected by these links are compared in their tiles.
So every link between two parts is found, and the components are those of all links. The links within a
component are not all looked for: this gives components, not the full set of links nor their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm import windows
from parley.llm.common import settled, slices, to_batch, written
from parley.llm.components import components
from parley.operators.joins import spread_join

SIZE = 5
#: Linked if 100 * intersection >= 80 * union, that is 9 * intersection >= 4 * (sum of sizes).
PERCENT = 80
#: Shingles met this often are put last in the order, the most frequent 2^17 of them. To count them,
#: each stretch of 2,048 texts hands on the shingles it meets four times. Only speed depends on them.
OFTEN, MOST_OFTEN, STRETCH, IN_STRETCH = 64, 1 << 17, 2048, 4
TILE = 1024
PAIRS_IN_PLACE = 256
ROWS_AT_ONCE, PAIRS_AT_ONCE = 1 << 14, 1 << 17
SLICE_ROWS = 64


def shingle_set(text: str) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles: five words in a row, with A-Z in lower case.

    A text of fewer words is one shingle, one without words has none.
    """
    words = windows.word_hashes(text.encode().lower())  # of bytes, it knows ASCII only
    if not len(words):
        return words
    size = min(SIZE, len(words))
    grams = windows.gram_hashes(words, size)
    return np.unique(grams + np.uint64(SIZE - size))


def bitmap(own: np.ndarray) -> bytes:
    """One bit or more per shingle, a power of two; a bit tells whether an odd number fell on it."""
    bits = 1 << max(6, (len(own) - 1).bit_length()) if len(own) else 64
    fallen = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(fallen.astype(np.uint8), bitorder="little").tobytes()


def needed(n: int) -> int:
    """The least overlap of a set of ``n`` with any set it is linked with."""
    return -(-PERCENT * n // 100)


SIGNATURE = (
    "doc long, tie int, digest string, n int, bits binary, often array<long>, times array<int>"
)
_SIGNATURE_FIELDS = {
    "doc": pa.int64(),
    "tie": pa.int32(),
    "digest": pa.string(),
    "n": pa.int32(),
    "bits": pa.binary(),
    "often": pa.list_(pa.int64()),
    "times": pa.list_(pa.int32()),
}


def signatures(texts: DataFrame) -> DataFrame:
    """Set size and bitmap of each text; on some rows also the shingles a stretch of texts often meets.

    The last stretch of a task has a row of its own for them, without a text.
    """

    def counted(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        many = counts >= IN_STRETCH
        return values[many].view(np.int64), counts[many].astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for part in slices(batches, SLICE_ROWS):
            sets = [shingle_set(t) for t in part.column(3).to_pylist()]
            held += sets
            often, times = [[] for _ in sets], [[] for _ in sets]
            if len(held) >= STRETCH:
                often[0], times[0] = counted(held)
                held = []
            own = [c.to_pylist() for c in part.columns[:3]]
            measures = [len(s) for s in sets], [bitmap(s) for s in sets]
            yield to_batch(_SIGNATURE_FIELDS, (*own, *measures, often, times))
        if held:
            often, times = counted(held)
            yield to_batch(_SIGNATURE_FIELDS, (*[[None]] * 5, [often], [times]))

    return texts.select("doc", "tie", "digest", "text").mapInArrow(run, SIGNATURE)


def often_met(signed: DataFrame) -> np.ndarray:
    """The shingles to put last, from less to more frequent: a list of bounded length."""
    pairs = signed.select(F.explode(F.arrays_zip("often", "times")).alias("x")).select("x.*")
    top = (
        pairs.groupBy("often")
        .agg(F.sum("times").alias("times"))
        .where(F.col("times") >= OFTEN)
        .orderBy(F.desc("times"), "often")
        .limit(MOST_OFTEN)
    )
    rows = [r["often"] for r in top.collect()]
    return np.array(rows[::-1], np.int64).view(np.uint64)


def prefix(own: np.ndarray, last: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the common order, as many as a linked set cannot all miss.

    ``last`` are the sorted shingles to put last, ``rank`` their places in that order.
    """
    take = len(own) - needed(len(own)) + 1
    if len(last):
        at = np.minimum(np.searchsorted(last, own), len(last) - 1)
        late = last[at] == own
        own = np.concatenate((own[~late], own[late][np.argsort(rank[at[late]])]))
    return own[:take]


def prefix_rows(texts: DataFrame, last: np.ndarray) -> DataFrame:
    order = np.argsort(last)
    shared = texts.sparkSession.sparkContext.broadcast((last[order], order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorted_last, rank = shared.value
        for part in slices(batches, SLICE_ROWS):
            docs, ties = part.column(0).to_numpy(), part.column(1).to_numpy()
            sets = [shingle_set(t) for t in part.column(2).to_pylist()]
            heads = [prefix(s, sorted_last, rank) if len(s) else s for s in sets]
            size = [len(h) for h in heads]
            columns = (
                np.concatenate(heads).view(np.int64),
                np.repeat(docs, size),
                np.repeat(ties, size),
                np.repeat(np.array([len(s) for s in sets], np.int32), size),
                np.concatenate([np.arange(k, dtype=np.int32) for k in size]),
            )
            names = ["h", "doc", "tie", "n", "pos"]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=names)

    schema = "h long, doc long, tie int, n int, pos int"
    return texts.select("doc", "tie", "text").mapInArrow(run, schema)


_PAIR = "u_doc long, u_tie int, doc long, tie int"
_PAIR_FIELDS = {"u_doc": pa.int64(), "u_tie": pa.int32(), "doc": pa.int64(), "tie": pa.int32()}


def _as_nodes(found: DataFrame) -> DataFrame:
    u = F.struct(F.col("u_doc").alias("doc"), F.col("u_tie").alias("tie"))
    return found.select(u.alias("u"), F.struct("doc", "tie").alias("v"))


def tiles(rows: DataFrame) -> DataFrame:
    """Rows of tiles with two texts or more: h, node, its size n and the shingle's place pos in its
    order, and ``head``, the first text of the size band."""
    node = F.struct("doc", "tie")
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / PERCENT)))
    by_tile = Window.partitionBy("h").orderBy("band", "doc", "tie")
    by_band = Window.partitionBy("h", "band").orderBy("doc", "tie")
    return (
        rows.withColumn("band", band)
        .repartition("h")
        .withColumn("_number", F.row_number().over(by_tile))
        .withColumn("_next", F.lead("n").over(by_tile))
        .withColumn("head", F.first(F.struct(node.alias("node"), "n", "pos")).over(by_band))
        .where("_number > 1 OR _next IS NOT NULL")
        .select("h", node.alias("node"), "n", "pos", "head")
    )


def nearest_heads(tiled: DataFrame) -> DataFrame:
    """For each text the earlier one it shares most tiles with, as a pair (u, v)."""
    # If this shingle is the first they share, the overlap is no more than what comes from here on.
    left = F.least(F.col("n") - F.col("pos"), F.col("head.n") - F.col("head.pos"))
    enough = (100 + PERCENT) * left >= PERCENT * (F.col("n") + F.col("head.n"))
    pairs = tiled.where((F.col("node") != F.col("head.node")) & enough)
    shared = pairs.groupBy("node", F.col("head.node").alias("head")).agg(F.count("*").alias("k"))
    best = F.max(F.struct(F.col("k"), F.col("head")))
    return shared.groupBy("node").agg(best.getField("head").alias("u")).select("u", F.col("node").alias("v"))


def verified(pairs: DataFrame, known: windows.Corpus) -> DataFrame:
    """The pairs (u, v) that are links, by exact intersection of their sorted shingles.

    The text of v is sent to u. A u with many pairs is met in several places, each with a part of
    them, so its pairs are not in one task, nor in memory together.
    """
    many = F.floor((F.count("*") - 1) / PAIRS_IN_PLACE) + 1
    parts = pairs.groupBy("u").agg(many.cast("int").alias("parts"))
    asked = (
        spread_join(pairs, parts, ["u"], "inner")
        .select("u", "parts", F.col("v").alias("own"))
        .union(parts.select("u", "parts", F.col("u").alias("own")))
        .select("u", "parts", F.col("own.doc").alias("doc"), F.col("own.tie").alias("tie"))
        .repartition(known.buckets, "doc")
        .groupBy("doc")
        .agg(F.collect_list(F.struct("tie", "u", "parts")).alias("asked"))
    )
    part = F.pmod(F.xxhash64("doc", "tie"), F.col("parts")).cast("int")
    all_parts = F.sequence(F.lit(0), F.col("parts") - 1)
    sent = (
        known.texts.join(asked, "doc")
        .select("doc", "tie", "text", F.explode("asked").alias("asked"))
        .where("asked.tie = tie")
        .select("doc", "tie", "text", "asked.u", "asked.parts")
        .withColumn("own", (F.col("u.doc") == F.col("doc")) & (F.col("u.tie") == F.col("tie")))
        .withColumn("part", F.explode(F.when(F.col("own"), all_parts).otherwise(F.array(part))))
        .select(*[F.col(f"u.{c}").alias(f"u_{c}") for c in ("doc", "tie")], "part", "own", "doc", "tie", "text")
        .repartition("u_doc", "u_tie", "part")
        .sortWithinPartitions("u_doc", "u_tie", "part", F.desc("own"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, mine = None, np.zeros(0, np.uint64)
        for part in slices(batches, SLICE_ROWS):
            links = []
            columns = [part.column(i).to_pylist() for i in range(6)]
            for i, (u_doc, u_tie, piece, own, doc, tie) in enumerate(zip(*columns)):
                if own:
                    key, text = (u_doc, u_tie, piece), part.column(6)[i].as_py()
                    mine, pending = None, text
                    continue
                assert key == (u_doc, u_tie, piece)
                if mine is None:
                    mine = shingle_set(pending)
                theirs = shingle_set(part.column(6)[i].as_py())
                both = len(np.intersect1d(mine, theirs, assume_unique=True))
                if 100 * both >= PERCENT * (len(mine) + len(theirs) - both):
                    links.append((u_doc, u_tie, doc, tie))
            yield to_batch(_PAIR_FIELDS, zip(*links))

    return _as_nodes(sent.mapInArrow(run, _PAIR))


def _folded(words: np.ndarray, width: int) -> np.ndarray:
    while words.shape[1] > width:
        half = words.shape[1] // 2
        words = words[:, :half] ^ words[:, half:]
    return words


def may_be_linked(n_a, words_a: np.ndarray, n_b, words_b: np.ndarray) -> np.ndarray:
    """Which pairs of sets, given by sizes and bitmaps row by row, may be linked.

    The bits in which two bitmaps differ bound the shingles only one set has from below, hence the
    overlap from above.
    """
    width = min(words_a.shape[1], words_b.shape[1])
    differ = np.bitwise_count(_folded(words_a, width) ^ _folded(words_b, width)).sum(axis=1, dtype=np.int64)
    overlap = (n_a + n_b - differ) // 2
    return (100 + PERCENT) * overlap >= PERCENT * (n_a + n_b)


def tile_pairs(tile: np.ndarray, n: np.ndarray, pos: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (a before b) of one tile that sizes and places allow to be linked.

    ``tile`` numbers the tiles of the rows, which are sorted by it and by size. Row k is paired with
    row k + 1, then k + 2 and so on, for all tiles at once.
    """
    a, step = np.arange(len(tile)), 1
    while len(a):
        a = a[a + step < len(tile)]
        b = a + step
        near = (tile[a] == tile[b]) & (100 * n[a] >= PERCENT * n[b])
        a, b = a[near], b[near]
        left = np.minimum(n[a] - pos[a], n[b] - pos[b])
        enough = (100 + PERCENT) * left >= PERCENT * (n[a] + n[b])
        yield a[enough], b[enough]
        step += 1


def open_pairs(tiled: DataFrame, roots: DataFrame, signed: DataFrame) -> DataFrame:
    """Pairs of one tile that no link connects yet and whose bitmaps allow one."""
    by_tile = Window.partitionBy("h")
    open_ = (
        tiled.select("h", "node", "n", "pos")
        .join(roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
        .withColumn("root", F.coalesce("root", "node"))
        .drop("_node")
        .repartition("h")
        .withColumn("_open", F.min("root").over(by_tile) != F.max("root").over(by_tile))
        .where("_open")
    )
    number = F.row_number().over(Window.partitionBy("h").orderBy("n", "node")) - 1
    placed = open_.withColumn("block", F.floor(number / TILE).cast("int")).withColumn(
        "blocks", F.max("block").over(by_tile) + 1
    )
    bits = signed.where("doc IS NOT NULL").select(F.struct("doc", "tie").alias("node"), "bits")
    # Each block of a tile meets itself and every other: (h, i, j) with i <= j.
    met = (
        placed.join(bits, "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "h",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "block",
            F.col("node.doc").alias("doc"),
            F.col("node.tie").alias("tie"),
            "n",
            "pos",
            F.col("root.doc").alias("root_doc"),
            F.col("root.tie").alias("root_tie"),
            "bits",
        )
        .repartition("h", "i", "j")
        .sortWithinPartitions("h", "i", "j", "n")
    )

    def compare(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(rows).combine_chunks()
        keys = np.stack([t[c].to_numpy() for c in ("h", "i", "j")], axis=1)
        tile = np.concatenate(([0], np.cumsum((keys[1:] != keys[:-1]).any(axis=1))))
        block, doc, tie = (t[c].to_numpy() for c in ("block", "doc", "tie"))
        n, pos = (t[c].to_numpy().astype(np.int64) for c in ("n", "pos"))
        root = np.stack([t["root_doc"].to_numpy(), t["root_tie"].to_numpy()], axis=1)
        crossing = keys[:, 1] != keys[:, 2]
        bits = t["bits"].to_pylist()
        length = np.array([len(b) for b in bits])
        node = np.unique(np.stack([doc, tie], axis=1), axis=0, return_inverse=True)[1].reshape(-1)
        # The bitmaps of each length as a matrix, and the place of each row in its own.
        place, words = np.zeros(len(bits), np.int64), {}
        for size in np.unique(length).tolist():
            at = np.flatnonzero(length == size)
            place[at] = np.arange(len(at))
            words[size] = np.frombuffer(b"".join([bits[i] for i in at]), np.uint64).reshape(len(at), -1)

        def passed(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            low, high = np.minimum(node[a], node[b]), np.maximum(node[a], node[b])
            once = np.unique(low * (node.max() + 1) + high, return_index=True)[1]
            a, b = a[once], b[once]
            good = np.zeros(len(a), bool)
            kinds = length[a] * (1 << 32) + length[b]
            for kind in np.unique(kinds).tolist():
                at = np.flatnonzero(kinds == kind)
                words_a, words_b = words[kind >> 32], words[kind & ((1 << 32) - 1)]
                x, y = a[at], b[at]
                good[at] = may_be_linked(n[x], words_a[place[x]], n[y], words_b[place[y]])
            a, b = a[good], b[good]
            swap = (doc[a] > doc[b]) | ((doc[a] == doc[b]) & (tie[a] > tie[b]))
            u, v = np.where(swap, b, a), np.where(swap, a, b)
            return to_batch(_PAIR_FIELDS, (doc[u], tie[u], doc[v], tie[v]))

        waiting, size = [], 0
        for a, b in tile_pairs(tile, n, pos):
            keep = (root[a] != root[b]).any(axis=1) & (~crossing[a] | (block[a] != block[b]))
            waiting.append((a[keep], b[keep]))
            size += int(keep.sum())
            if size >= PAIRS_AT_ONCE:
                yield passed(*map(np.concatenate, zip(*waiting)))
                waiting, size = [], 0
        if size:
            yield passed(*map(np.concatenate, zip(*waiting)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if held and size >= ROWS_AT_ONCE:
                # Rows go on to the end of the tile that the last batch broke off in.
                last = [held[-1].column(k)[-1].as_py() for k in range(3)]
                keys = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
                same = (keys == last).all(axis=1)
                stop = len(same) if same.all() else int(np.argmin(same))
                held.append(batch.slice(0, stop))
                if stop < batch.num_rows:
                    yield from compare(held)
                    held, size, batch = [], 0, batch.slice(stop)
                else:
                    continue
            held.append(batch)
            size += batch.num_rows
        if held:
            yield from compare(held)

    return _as_nodes(met.mapInArrow(run, _PAIR).distinct())


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, digest (of the text), n_shingles, component_id and is_first for each row of ``docs``.

    Two documents are linked if 100 * intersection >= 80 * union of their shingle sets; ``component_id``
    is the smallest doc_id that links lead to, the own one included, and ``is_first`` tells whether the
    row is that document (or has no shingles). Null, empty and blank texts have no shingles and no
    links; equal texts with shingles are linked. A null id comes after all others and is its
    component's only if no other is in it. Ids may be of any type with an order. Repeated rows stay. Other
    columns are not read.
    """
    return settled(docs.sparkSession, lambda: _near_duplicates(docs, doc_id, text), "near-duplicates")


def _near_duplicates(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    known = windows.corpus(docs, doc_id, text)
    signed = written(signatures(known.texts), "shingle-signatures")
    tiled = written(tiles(prefix_rows(known.texts, often_met(signed))), "shingle-tiles")
    links = written(verified(nearest_heads(tiled), known), "shingle-links")
    more = written(open_pairs(tiled, components(links), signed), "shingle-pairs")
    every = written(links.union(verified(more, known)), "shingle-links")
    roots = components(every)
    sizes = signed.where("doc IS NOT NULL").select(F.struct("doc", "tie").alias("node"), "digest", "n")
    labelled = sizes.join(roots, "node", "left").select(
        "digest",
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("root", "node").getField("doc").alias("_root"),
        F.coalesce(F.col("root") == F.col("node"), F.lit(True)).alias("_heads"),
        F.col("node.doc").alias("_first"),
    )
    labelled = known.ids.named(labelled, "_root", "_root_id")
    alone = F.col("n_shingles") == 0
    return known.rows.join(labelled, "digest").select(
        "doc_id",
        "digest",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_root_id")).alias("component_id"),
        (alone | (F.col("_heads") & (F.col("doc") == F.col("_first")))).alias("is_first"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest doc_id, with all columns.

    Documents without words all stay, repeated rows of others count once. ``docs`` needs the columns
    doc_id and text. Which of rows that differ in other columns alone stays is not defined.
    """
    found = near_duplicates(docs).where("is_first")
    names = {"doc_id": "_id", "digest": "_digest", "n_shingles": "_n"}
    chosen = found.select(*[F.col(c).alias(name) for c, name in names.items()]).distinct()
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in docs.columns])).select(
        "_row", F.col("doc_id").alias("_own"), F.sha2(text, 256).alias("_sha")
    )
    same = F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_digest"))
    copies = Window.partitionBy("_own", "_sha").orderBy(F.lit(1))
    rows = keyed.join(chosen, same).withColumn("_copy", F.row_number().over(copies))
    return rows.where("_copy = 1 OR _n = 0").select("_row.*")
