"""Which fixed-length windows of a corpus occur in it before: the frame of both substring removers.

A text is a row of tokens (bytes or words) and a window is ``length`` consecutive ones. Every window is
stood for by its minimizer: of the short grams inside it the one with the least hash, leftmost first.
Equal windows have equal minimizers at equal places, so only windows that share one need comparing. The
windows of one minimizer are consecutive; they and the stretch of text they cover are an *anchor* row.

1. Equal texts are brought together by digest; only the first of each goes on.
2. Anchors are shuffled by minimizer. Where whole stretches are equal, all but the first are repeats;
   those within one task are marked before the shuffle.
3. The first of each stretch is a *question* if its minimizer heads different stretches. Their text is
   fetched and a searcher (by suffix sorting, or by factoring) compares them, block by block. Windows
   of minimizers with very many questions are dealt out one by one.
4. Repeats and found windows are gathered per text.

Gram and stretch hashes have 64 bits each, and two stretches count as equal only if both agree.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import release, slices, to_batch, written
from parley.operators.joins import spread_join
from parley.session import scratch_folder, scratch_table

#: Rows without an id get one of so many places after all others.
NO_ID_PLACES = 1 << 20
BUCKET_BYTES, MAX_BUCKETS = 16 << 20, 1 << 17
#: Windows taken at a time; a place in them and the hash of a gram share 64 bits.
CHUNK, PLACE_BITS = 1 << 16, 18
BLOCK_BYTES = 1 << 20
SLICE_ROWS, ROWS_AT_ONCE = 64, 1 << 17
WINDOWS_AT_ONCE = 1 << 14

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_PLACES = np.uint64((1 << PLACE_BITS) - 1)


@dataclass(frozen=True)
class Tokens:
    """How a text is cut into tokens, a 64-bit hash of each, and the tokens of a stretch as bytes.

    Questions that share a minimizer with more than ``crowd`` others are looked up window by window.
    That takes as many rows as a stretch has windows, so ``crowd`` is larger for longer windows.
    """

    length: int
    gram: int
    crowd: int
    tokens: Callable[[str], Sequence]
    hashes: Callable[[str], np.ndarray]
    cut: Callable[[Sequence, int, int], bytes]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2^64, as many as were asked for so far."""

    base = 0x2545F4914F6CDD1D

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if count > len(self.up):
            size = 1 << (count - 1).bit_length()
            self.up, self.down = (self._row(f, size) for f in (self.base, pow(self.base, -1, 1 << 64)))
        return self.up[:count], self.down[:count]

    @staticmethod
    def _row(factor: int, size: int) -> np.ndarray:
        row = np.full(size, np.uint64(factor))
        row[0] = 1
        return np.multiply.accumulate(row)


_POWERS = _Powers()
_OF_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _M1)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LONG_WORD = 512


def split_words(text: str) -> list[bytes]:
    """The words, parted by ASCII white space: the only kind that bytes are split at."""
    return text.encode().split()


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash for each word of a text in UTF-8.

    All words are hashed at once, as sums over their bytes of powers of an odd number. Words of more
    than ``LONG_WORD`` bytes, where such sums could be made to agree, get a hash of another kind.
    """
    bytes_ = np.frombuffer(data, np.uint8)
    edges = np.diff(np.concatenate(([True], _IS_SPACE[bytes_], [True])).astype(np.int8))
    start, end = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    up, down = _POWERS.upto(len(bytes_) + 1)
    sums = np.zeros(len(bytes_) + 1, np.uint64)
    np.cumsum(_OF_BYTE[bytes_] * up[:-1], out=sums[1:])
    out = mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * _M2)
    for i in np.flatnonzero(end - start > LONG_WORD).tolist():
        out[i] = int.from_bytes(blake2b(data[start[i] : end[i]], digest_size=8).digest(), "little")
    return out


def gram_hashes(tokens: np.ndarray, gram: int) -> np.ndarray:
    """A hash for each run of ``gram`` tokens."""
    n = len(tokens) - gram + 1
    out = tokens[:n].copy()
    for i in range(1, gram):
        out = (out * _M2) ^ (tokens[i : n + i] + (out >> np.uint64(29)))
    return mixed(out)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    have, out = 1, x
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def anchors(tokens: np.ndarray, length: int, gram: int, grams: np.ndarray | None = None):
    """Anchor rows of a text: minimizer hash, stretch hash, first window, number of windows."""
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(tokens) - length + 1, CHUNK):
        part = tokens[at : at + CHUNK + length - 1]
        g = gram_hashes(part, gram) if grams is None else grams[at : at + CHUNK + length - gram]
        keyed = (g & ~_PLACES) | np.arange(len(g), dtype=np.uint64)
        places = (_sliding_least(keyed, length - gram + 1) & _PLACES).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))
        count = np.diff(np.append(first, len(places)))
        up, down = _POWERS.upto(CHUNK + length)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(part + _M1) * up[: len(part)])))
        ends = first + count + length - 1
        stretch = mixed((sums[ends] - sums[first]) * down[first] + count.astype(np.uint64))
        found.append((g[places[first]], stretch, first + at, count))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else None


class Ids(NamedTuple):
    """How ids stand as 64-bit places in their order: whole numbers less ``shift``, or by a table.

    ``none`` is the first place of rows without an id, null if there are no such rows; ``places`` is a stored
    table of ids (``doc_id``) and their places (``doc``), for ids that are no whole numbers, and for
    numbers that leave no room for rows without one.
    """

    kind: T.DataType
    shift: int
    none: int | None
    places: DataFrame | None = None

    def placed(self, docs: DataFrame) -> DataFrame:
        """(doc_id, text) with ``doc``. Rows without an id come after all others, by a hash of the text."""
        if self.places is not None:
            docs = spread_join(docs, self.places, ["doc_id"], "left")
            own = F.col("doc")
        else:
            own = F.col("doc_id").cast("long") - self.shift
        if self.none is not None:
            later = F.lit(self.none) + F.pmod(F.xxhash64("text"), F.lit(NO_ID_PLACES))
            own = F.coalesce(own, later)
        return docs.withColumn("doc", own)

    def named(self, df: DataFrame, doc: str, name: str) -> DataFrame:
        """``df`` with the ids of the places in column ``doc``, null for rows without one."""
        if self.places is not None:
            known = self.places.select(F.col("doc").alias(doc), F.col("doc_id").alias(name))
            return spread_join(df, known, [doc], "left")
        id_ = (F.col(doc) + self.shift).cast(self.kind)
        if self.none is not None:
            id_ = F.when(F.col(doc) < self.none, id_)
        return df.withColumn(name, id_)


def ids_of(docs: DataFrame) -> Ids:
    """The places of the ids of (doc_id, ...); any type with an order will do."""
    kind, id_ = docs.schema["doc_id"].dataType, F.col("doc_id")
    if isinstance(kind, T.IntegralType):
        low, high, some = docs.agg(F.min(id_), F.max(id_), F.count_if(id_.isNull())).first()
        if not some:
            return Ids(kind, 0, None)
        if high is None or high < (1 << 63) - 1 - NO_ID_PLACES:
            return Ids(kind, 0, 0 if high is None else high + 1)
        if low > NO_ID_PLACES - (1 << 63):
            return Ids(kind, NO_ID_PLACES, high + 1 - NO_ID_PLACES)
    known = docs.select(id_).where(id_.isNotNull()).distinct()
    ordered = known.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    # rising from task to task, and within one
    places = ordered.withColumn("doc", F.monotonically_increasing_id())
    return Ids(kind, 0, 1 << 62, written(places, "window-ids"))


class Corpus(NamedTuple):
    """``rows``: a narrow row per document; ``texts``: the first document of each text, in buckets by
    ``doc`` (the place of its id, see ``Ids``), with the number of its rows. ``tie`` tells apart the texts of one id."""

    rows: DataFrame
    texts: DataFrame
    buckets: int
    ids: Ids


def corpus(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Corpus:
    """Brings equal texts together. Ids may be of any type with an order, and any size."""
    given = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), given.alias("text"))
    ids = ids_of(docs)
    placed = ids.placed(docs)
    digest = F.sha2("text", 256).alias("digest")
    size = F.octet_length("text").cast("long").alias("bytes")
    rows = written(placed.select("doc_id", "doc", digest, size), "window-rows")
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    buckets = min(MAX_BUCKETS, max(1, -(-total // BUCKET_BYTES)))

    same = rows.groupBy("digest", "doc").agg(F.count("*").alias("times"))
    least = F.min(F.struct("doc", "times")).alias("least")
    firsts = same.groupBy("digest").agg(least).select("digest", "least.*")
    tie = F.row_number().over(Window.partitionBy("doc").orderBy("digest")) - 1
    of_id = (
        firsts.withColumn("tie", tie)
        .groupBy("doc")
        .agg(F.collect_list(F.struct("digest", "tie", "times")).alias("chosen"))
    )
    # The text is shuffled once, into the buckets of the table it is written to.
    found = (
        placed.select("doc", digest, "text")
        .repartition(buckets, "doc")
        .join(of_id.repartition(buckets, "doc"), "doc")
        .withColumn("chosen", F.filter("chosen", lambda x: x["digest"] == F.col("digest")))
        .withColumn("chosen", F.get("chosen", F.lit(0)))
        .where("chosen IS NOT NULL")
        .select("doc", "chosen.tie", "digest", "chosen.times", "text")
        .dropDuplicates(["doc", "digest"])
    )
    spark, name = docs.sparkSession, f"window_texts_{uuid.uuid4().hex}"
    folder = scratch_folder(spark, "window-texts")
    scratch_table(folder, name)
    (
        found.write.option("path", folder)
        .bucketBy(buckets, "doc")
        .sortBy("doc", "tie")
        .saveAsTable(name)
    )
    release(spark)
    return Corpus(rows, spark.table(name), buckets, ids)


ANCHOR = (
    "h long, s long, doc long, tie int, start int, n int, more array<int>, again boolean"
)


def first_in_text(h: np.ndarray, s: np.ndarray, start: np.ndarray, n: np.ndarray):
    """Keeps the first of equal stretches of one text; ``more`` lists the places of the others.

    So a text that goes round in circles is no more rows under one minimizer than others.
    """
    count = np.zeros(len(h), np.int64)
    if len(np.unique(s)) == len(s):
        return h, s, start, n, count, start[:0]
    order = np.lexsort((start, s, h))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (s[order][1:] != s[order][:-1])
    first = order[new]
    count = np.diff(np.append(np.flatnonzero(new), len(h))) - 1
    return h[first], s[first], start[first], n[first], count, start[order[~new]]


def settled_early(h, s, doc, tie, start, within: bool) -> np.ndarray:
    """Which of some anchor rows repeat an earlier equal stretch among these very rows."""
    again = np.zeros(len(h), bool)
    key = mixed(h + s * _M2)
    order = np.argsort(key)
    twice = np.zeros(len(h), bool)
    twice[1:] = key[order][1:] == key[order][:-1]
    twice[:-1] |= twice[1:]
    rows = order[twice]
    rows = rows[np.lexsort((start[rows], tie[rows], doc[rows], s[rows], h[rows]))]
    new = np.ones(len(rows), bool)
    new[1:] = (h[rows][1:] != h[rows][:-1]) | (s[rows][1:] != s[rows][:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))
    again[rows] = ~new if within else doc[rows] > doc[rows[first]]
    return again


def anchor_rows(texts: DataFrame, kind: Tokens, within: bool) -> DataFrame:
    """The anchors of each text; of equal stretches in a text, the first with the places of the rest.

    A task settles what it can before rows are shuffled: a stretch that an earlier text of the same
    batch has is a repeat (``again``) whatever else there is, and goes on under a minimizer of its
    own. So a passage that very many texts share is a few rows of each task under its minimizers.
    """
    names = ["h", "s", "doc", "tie", "start", "n", "more", "again"]

    def settled(found: list[tuple]) -> pa.RecordBatch:
        h, s, doc, tie, start, n, count, more = (np.concatenate(c) for c in zip(*found))
        again = settled_early(h, s, doc, tie, start, within)
        spread = mixed(doc.astype(np.uint64) * _M1 + start.astype(np.uint64) + s)
        h = np.where(again, spread, h)
        lists = pa.ListArray.from_arrays(
            pa.array(np.append(0, np.cumsum(count)).astype(np.int32)),
            pa.array(more.astype(np.int32)),
            mask=pa.array(count == 0),
        )
        hashes = (h.view(np.int64), s.view(np.int64))
        places = (start.astype(np.int32), n.astype(np.int32))
        columns = [*map(pa.array, (*hashes, doc, tie, *places)), lists, pa.array(again)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for part in slices(batches, SLICE_ROWS):
            docs, ties = part.column(0).to_numpy(), part.column(1).to_numpy()
            for i, text in enumerate(part.column(2).to_pylist()):
                rows = anchors(kind.hashes(text), kind.length, kind.gram)
                if rows is not None:
                    h, s, start, n, count, more = first_in_text(*rows)
                    own = np.full(len(h), docs[i]), np.full(len(h), ties[i])
                    found.append((h, s, *own, start, n, count, more))
                    size += len(h)
            if size >= ROWS_AT_ONCE:
                yield settled(found)
                found, size = [], 0
        if found:
            yield settled(found)

    return texts.select("doc", "tie", "text").mapInArrow(run, ANCHOR)


def repeats_and_questions(rows: DataFrame, within: bool, crowd: int) -> DataFrame:
    """Anchor rows that matter: repeats (``again``) of an earlier equal stretch, and questions, the rows
    with a minimizer ``h``; ``crowded`` ones share it with more than ``crowd`` others.

    ``within`` tells whether a repeat inside one document counts; then the places in ``more`` are
    repeats in any case.
    """
    by_stretch = Window.partitionBy("h", "s").orderBy("doc", "tie", "start")
    by_gram = Window.partitionBy("h")
    if within:
        again = F.row_number().over(by_stretch) > 1
    else:
        again = F.col("doc") > F.first("doc").over(by_stretch)
    marked = (
        rows.repartition("h")
        .withColumn("again", F.col("again") | again)
        .withColumn("varied", F.min("s").over(by_gram) != F.max("s").over(by_gram))
        .withColumn("crowded", F.count("*").over(by_gram) > crowd)
    )
    inner = F.col("more").isNotNull() if within else F.lit(False)
    asked = F.when(F.col("varied") & ~F.col("again"), F.col("h"))
    return marked.where(F.col("again") | F.col("varied") | inner).select(
        asked.alias("h"), "doc", "tie", "start", "n", "more", "again", "crowded"
    )


def repeats(marked: DataFrame, within: bool) -> DataFrame:
    """The windows of repeats, in all their places."""
    more = F.coalesce("more", F.array().cast("array<int>"))
    own = F.when(F.col("again"), F.array("start")).otherwise(F.array().cast("array<int>"))
    places = F.concat(own, more) if within else F.concat(F.array("start"), more)
    rows = marked if within else marked.where("again")
    return rows.select("doc", "tie", F.explode(places).alias("start"), "n")


def questions(marked: DataFrame, within: bool) -> DataFrame:
    more = F.lit(None).cast("array<int>") if within else F.col("more")
    columns = ["h", "doc", "tie", "start", "n", "crowded"]
    return marked.where("h IS NOT NULL").select(*columns, more.alias("more"))


def _lists(rows: DataFrame, known: Corpus, *names: str) -> DataFrame:
    """The rows of each ``doc`` as lists, dealt like the buckets of texts."""
    gathered = F.collect_list(F.struct("tie", *names))
    return (
        rows.repartition(known.buckets, "doc")
        .groupBy("doc")
        .agg(gathered.alias("_rows"))
        .select("doc", F.col("_rows.tie").alias("ties"), *[F.col(f"_rows.{n}").alias(n) for n in names])
    )


SPAN = "h long, doc long, tie int, start int, n int, more array<int>, span binary"
_SPAN_FIELDS = {
    "h": pa.int64(),
    "doc": pa.int64(),
    "tie": pa.int32(),
    "start": pa.int32(),
    "n": pa.int32(),
    "more": pa.list_(pa.int32()),
    "span": pa.binary(),
}


def _window_rows(held: list[tuple], within: bool) -> list[tuple]:
    """Rows (doc, tie, start, more, window) as spans of one window each, under a hash of the window.

    Of equal windows only the earliest goes on; later ones are settled, which a span of null says, and
    get a hash of their own. So neither stretches nor windows that very many texts share meet in one
    place.
    """
    first: dict[bytes, tuple] = {}
    for doc, tie, start, _, window in held:
        first[window] = min(first.get(window, (doc, tie, start)), (doc, tie, start))
    out = []
    for doc, tie, start, more, window in held:
        place = (doc, tie, start)
        later = place > first[window] if within else doc > first[window][0]
        named = repr(place).encode() if later else window
        h = int.from_bytes(blake2b(named, digest_size=8).digest(), "little", signed=True)
        out.append((h, doc, tie, start, 1, more, None if later else window))
    return out


def spans(asked: DataFrame, known: Corpus, kind: Tokens, within: bool) -> DataFrame:
    """The text of each question: the stretch that its windows cover.

    The windows of a crowded question go on one by one, each under its own hash.
    """
    names = ["h", "start", "n", "more", "crowded"]
    joined = known.texts.join(_lists(asked, known, *names), "doc")
    joined = joined.select("doc", "tie", "text", "ties", *names)
    beyond = kind.length - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single: list[tuple] = []
        for part in slices(batches, SLICE_ROWS):
            rows = []
            for doc, tie, text, *lists in zip(*[c.to_pylist() for c in part.columns]):
                tokens = kind.tokens(text)
                for own, h, start, n, more, crowded in zip(*lists):
                    if own != tie:
                        continue
                    if not crowded:
                        span = kind.cut(tokens, start, start + n + beyond)
                        rows.append((h, doc, tie, start, n, more, span))
                        continue
                    for at in range(n):
                        places = [m + at for m in more] if more else None
                        window = kind.cut(tokens, start + at, start + at + beyond + 1)
                        single.append((doc, tie, start + at, places, window))
            if rows:
                yield to_batch(_SPAN_FIELDS, zip(*rows))
            if len(single) >= WINDOWS_AT_ONCE:
                yield to_batch(_SPAN_FIELDS, zip(*_window_rows(single, within)))
                single = []
        if single:
            yield to_batch(_SPAN_FIELDS, zip(*_window_rows(single, within)))

    return joined.mapInArrow(run, SPAN)


Found = tuple[np.ndarray, np.ndarray, np.ndarray]
#: Takes the spans of a block with their order (doc, tie, start) and says which windows occur earlier:
#: span number, first window in the span, number of windows.
Search = Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray], Found]


def searched(asked: DataFrame, search: Search) -> DataFrame:
    """Runs ``search`` over blocks of spans, the spans of one minimizer always in one block."""
    def block(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(rows)
        doc, tie, start, n = (whole[c].to_numpy() for c in ("doc", "tie", "start", "n"))
        texts = whole["span"].to_pylist()
        settled = np.flatnonzero([t is None for t in texts])
        open_ = np.flatnonzero([t is not None for t in texts])
        span, first, count = settled, np.zeros(len(settled), np.int64), n[settled].astype(np.int64)
        if len(open_):
            found = search([texts[i] for i in open_], *(c[open_] for c in (doc, tie, start, n)))
            span = np.concatenate((span, open_[found[0]]))
            first, count = np.concatenate((first, found[1])), np.concatenate((count, found[2]))
        # What holds for a stretch holds in all its places.
        more = whole["more"].combine_chunks()
        times = np.nan_to_num(pc.list_value_length(more).to_numpy(zero_copy_only=False)).astype(np.int64)
        if times.any():
            flat, ends = more.flatten().to_numpy(), np.cumsum(times)
            again = np.repeat(np.arange(len(span)), times[span])
            turn = np.arange(len(again)) - np.repeat(np.cumsum(times[span]) - times[span], times[span])
            places = flat[(ends - times)[span[again]] + turn]
            shift = np.concatenate((np.zeros(len(span), np.int64), places - start[span[again]]))
            span, first, count = (np.concatenate((x, x[again])) for x in (span, first, count))
            first = first + shift
        at = (start[span] + first).astype(np.int32)
        columns = (doc[span], tie[span], at, count.astype(np.int32))
        return pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["doc", "tie", "start", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            grams = batch.column(0).to_numpy()
            if held and size >= BLOCK_BYTES:
                # The block ends where a minimizer's spans end.
                last = held[-1].column(0)[-1].as_py()
                stop = int(np.searchsorted(grams, last, side="right")) if grams[0] == last else 0
                if stop < len(grams):
                    yield block([*held, batch.slice(0, stop)])
                    held, size, batch = [], 0, batch.slice(stop)
            held.append(batch)
            size += batch.column(6).nbytes
        if held:
            yield block(held)

    placed = asked.repartition("h").sortWithinPartitions("h")
    return placed.mapInArrow(run, "doc long, tie int, start int, n int")


def repeated_windows(known: Corpus, kind: Tokens, search: Search, within: bool) -> DataFrame:
    """Per ``doc`` the lists ``ties``, ``start`` and ``n`` of windows that occur before."""
    rows = anchor_rows(known.texts, kind, within)
    marked = written(repeats_and_questions(rows, within, kind.crowd), "window-anchors")
    found = searched(spans(questions(marked, within), known, kind, within), search)
    return _lists(repeats(marked, within).union(found), known, "start", "n")


def covered(size: int, length: int, starts, counts) -> np.ndarray:
    """Which of ``size`` tokens lie in a window that occurs before."""
    edges = np.zeros(size + 1, np.int64)
    if starts is not None:
        begin = np.asarray(starts, np.int64)
        np.add.at(edges, begin, 1)
        np.add.at(edges, begin + np.asarray(counts, np.int64) + length - 1, -1)
    return np.cumsum(edges)[:-1] > 0


RESULT = (
    "first long, digest string, times long, bytes long, n_tokens long, n_removed long, n_spans long, "
    "kept binary, spans array<struct<begin:long,end:long>>"
)
_RESULT_FIELDS = {
    "first": pa.int64(),
    "digest": pa.string(),
    **dict.fromkeys(["times", "bytes", "n_tokens", "n_removed", "n_spans"], pa.int64()),
    "kept": pa.binary(),
    "spans": pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])),
}
#: Takes the tokens of a text and which of them go, and gives the bytes left.
Keep = Callable[[Sequence, np.ndarray], bytes]


def cut_texts(known: Corpus, repeats: DataFrame, kind: Tokens, keep: Keep) -> DataFrame:
    """Per text what is left of it: counts, removed spans (in tokens) and the kept bytes."""
    columns = ["doc", "digest", "times", "tie", "text", "ties", "start", "n"]
    joined = known.texts.join(repeats, "doc", "left").select(*columns)

    def result(doc, digest, times, tie, text, ties, start, n) -> tuple:
        tokens = kind.tokens(text)
        if ties is not None:
            own = np.flatnonzero(np.array(ties) == tie)
            start, n = np.array(start)[own], np.array(n)[own]
        gone = covered(len(tokens), kind.length, start, n)
        edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).tolist()
        runs = [{"begin": a, "end": b} for a, b in zip(edges[::2], edges[1::2])]
        counts = (len(text.encode()), len(gone), int(gone.sum()), len(runs))
        return doc, digest, times, *counts, keep(tokens, gone), runs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SLICE_ROWS):
            rows = [result(*row) for row in zip(*[c.to_pylist() for c in part.columns])]
            yield to_batch(_RESULT_FIELDS, zip(*rows))

    return joined.mapInArrow(run, RESULT)


def sizes(known: Corpus, kind: Tokens, keep: Keep) -> DataFrame:
    """Per text its number of tokens, and what is kept of it if it is shorter than a window."""
    fields = {"digest": pa.string(), "first": pa.int64(), "n_tokens": pa.int64(), "short": pa.binary()}

    def result(digest: str, doc: int, text: str) -> tuple:
        tokens = kind.tokens(text)
        n = len(tokens)
        return digest, doc, n, keep(tokens, np.zeros(n, bool)) if n < kind.length else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SLICE_ROWS):
            rows = [result(*row) for row in zip(*[c.to_pylist() for c in part.columns])]
            yield to_batch(fields, zip(*rows))

    texts = known.texts.select("digest", "doc", "text")
    return texts.mapInArrow(run, "digest string, first long, n_tokens long, short binary")


def per_document(known: Corpus, cut: DataFrame, kind: Tokens, keep: Keep) -> DataFrame:
    """The results of all rows: copies of a text after the first document lose all windows.

    doc_id, digest, bytes, n_tokens, n_removed, n_spans, kept and spans, one row for each document row.
    Only narrow rows are shuffled for copies, and none for the others.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    names = ["doc_id", "digest", "bytes", "n_tokens", "n_removed", "n_spans", "kept", "spans"]
    named = known.ids.named(cut, "first", "doc_id")
    firsts = named.withColumn("_", F.explode(F.sequence(one, F.col("times")))).select(*names)
    whole = F.col("short").isNull()
    all_of_it = F.array(F.struct(zero.alias("begin"), F.col("n_tokens").alias("end")))
    copies = (
        known.rows.join(sizes(known, kind, keep), "digest")
        .where("doc > first")
        .select(
            "doc_id",
            "digest",
            "bytes",
            "n_tokens",
            F.when(whole, F.col("n_tokens")).otherwise(zero).alias("n_removed"),
            F.when(whole, one).otherwise(zero).alias("n_spans"),
            F.coalesce("short", F.lit(b"")).alias("kept"),
            F.when(whole, all_of_it).otherwise(F.array().cast(cut.schema["spans"].dataType)),
        )
    )
    return firsts.union(copies)
