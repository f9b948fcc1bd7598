"""Language identification by prediction by partial matching.

For each language a tree of byte contexts, up to ``order`` bytes deep, says how often each byte followed. A
byte that a context has seen c times among n, with d different ones, costs log2((n + d) / c) bits there;
any other costs an escape, log2((n + d) / d) bits, and is coded in the context without its oldest byte. The
last resort are 8 bits. A context that a language has never met costs nothing and is passed over. A text
begins in a context of zero bytes. The language in which a whole text is shortest is the answer.

*Learning* counts the byte strings ("grams") of ``order`` + 1 bytes of all labelled texts; tasks add up
what they have before the shuffle, and shorter grams are sums of longer ones. The statistics are then frozen
to the grams above a cutoff on their share of a language's bytes, at most ``NODES`` (and ``CELLS`` numbers in all), so
the broadcast model has a fixed bound whatever the corpus.

*Scoring.* A kept gram's beginnings and endings are kept as well, so the longest kept gram that ends at a byte
tells all there is to know: the gram itself, and (less its first byte, if of full length) the longest
context of the next byte. A text's code length is the sum, over its bytes, of one number per longest gram and language, plus
the text's ends. Costs are whole numbers of 2^-16 bits, so sums do not depend on how texts are cut or
dealt to tasks.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import settled, slices, with_columns, without

#: Bounds of the model: kept grams, and kept grams times languages. More languages than these are refused.
NODES, CELLS, LANGUAGES = 1 << 17, 1 << 22, 1024
#: Grams are kept or not by steps of this many to a factor of two in share.
STEPS = 64
UNIT = 1 << 16
UNKNOWN = "und"
SLICE_ROWS = 256
#: Grams a task counts at a time, and different ones it holds; bytes it scores at a time.
COUNTED, HELD, SCORED = 1 << 22, 1 << 20, 1 << 20


@dataclass(frozen=True)
class Model:
    """Frozen statistics. Node 0 is the empty gram; the others stand by size, then bytes."""

    languages: tuple[str, ...]
    order: int
    #: The kept grams of each size from 1 on, as sorted big-endian numbers.
    grams: tuple[np.ndarray, ...]
    #: By language and node: what a byte costs whose longest gram it is and whose successor's context it makes, and the latter part alone.
    cost: np.ndarray
    context: np.ndarray


def _places(sizes: tuple[np.ndarray, ...]) -> np.ndarray:
    """The first node of each size, and the end."""
    return np.cumsum([1, *map(len, sizes)])


def _find(sizes: tuple[np.ndarray, ...], first: np.ndarray, size: int, grams: np.ndarray) -> np.ndarray:
    """Nodes of grams of one size; 0 for those not kept and for size 0."""
    if not size or not len(sizes[size - 1]):
        return np.zeros(len(grams), np.int64)
    known = sizes[size - 1]
    at = np.searchsorted(known, grams).clip(0, len(known) - 1)
    return np.where(known[at] == grams, first[size - 1] + at, 0)


def freeze(languages: list[str], order: int, counts: dict[int, tuple[np.ndarray, np.ndarray]]) -> Model:
    """The model of kept grams: by size, their numbers (sorted) and counts (one row per gram, a column per language).

    A gram's endings, and its beginnings unless made of the zero bytes before a text, have to be kept too.
    """
    sizes, rows = [], [np.zeros((1, len(languages)), np.int64)]
    for size in range(1, order + 2):
        grams, seen = counts[size]
        if size <= order and not (len(grams) and grams[0] == 0):  # a text's beginning is a context
            grams, seen = np.r_[0, grams], np.r_[np.zeros((1, len(languages)), np.int64), seen]
        sizes.append(grams.astype(np.int64))
        rows.append(seen)
    first, seen = _places(sizes), np.concatenate(rows)
    total, kinds = np.zeros_like(seen), np.zeros_like(seen)
    before, shorter = [], []
    for size, grams in enumerate(sizes, 1):
        before.append(_find(sizes, first, size - 1, grams >> 8))
        shorter.append(_find(sizes, first, size - 1, grams & ((1 << 8 * (size - 1)) - 1)))
        own = seen[first[size - 1] : first[size]]
        np.add.at(total, before[-1], own)
        np.add.at(kinds, before[-1], own > 0)

    def bits(numerator: np.ndarray, denominator: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(denominator > 0, np.rint(np.log2(numerator / denominator) * UNIT), 0).astype(np.int64)

    escape = bits(total + kinds, kinds)
    escapes, own = escape.copy(), np.full_like(seen, 8 * UNIT)
    ahead = np.zeros_like(seen)
    for size, (prefix, suffix) in enumerate(zip(before, shorter), 1):
        here = slice(first[size - 1], first[size])
        fewer = own[suffix]  # for size 1 the 8 bits of node 0
        met = bits((total + kinds)[prefix], seen[here])
        own[here] = np.where(
            total[prefix] == 0, fewer, np.where(seen[here] > 0, met, escape[prefix] + fewer)
        )
        if size <= order:
            escapes[here] += escapes[suffix]
            ahead[here] = escapes[here]
        else:
            ahead[here] = escapes[suffix]
    ahead[0] = escapes[0]
    cost = own + ahead
    for size, prefix in enumerate(before, 1):
        cost[first[size - 1] : first[size]] -= escapes[prefix]
    return Model(
        tuple(languages), order, tuple(sizes), cost.T.astype(np.int32).copy(), ahead.T.astype(np.int32).copy()
    )


class Scorer:
    """A model's tables for scoring, made once per worker."""

    def __init__(self, model: Model):
        self.model = model
        order, sizes = model.order, model.grams
        first = _places(sizes)
        self.symbol = np.zeros(256, np.int64)  # symbol 0 is any byte that no kept gram holds
        self.symbol[sizes[0]] = np.arange(1, len(sizes[0]) + 1)
        self.alphabet = len(sizes[0]) + 1
        self.one = np.zeros(self.alphabet, np.int32)
        self.one[1:] = np.arange(first[0], first[1])
        # by node and older byte, the node of the longer gram
        self.longer = np.zeros(first[order] * self.alphabet, np.int32)
        for size in range(2, order + 2):
            grams = sizes[size - 1]
            below = 8 * (size - 1)
            inner = _find(sizes, first, size - 1, grams & ((1 << below) - 1))
            at = inner * self.alphabet + self.symbol[grams >> below]
            self.longer[at] = np.arange(first[size - 1], first[size])
        start = _find(sizes, first, order, np.zeros(1, np.int64))[0]
        self.start = model.context[:, start].astype(np.int64)

    def nodes(self, data: bytes) -> np.ndarray:
        """The node of the longest kept gram that ends at each byte."""
        symbols = self.symbol[np.frombuffer(data, np.uint8)]
        node = self.one[symbols]
        best = node.copy()
        for back in range(1, self.model.order + 1):
            at = np.multiply(node[1:], self.alphabet, dtype=np.int64)
            at += symbols[:-back]
            node = self.longer[at]
            np.maximum(best[back:], node, out=best[back:])
        return best

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code lengths by text and language, in units of 2^-16 bits."""
        out = np.zeros((len(texts), len(self.model.languages)), np.int64)
        group, size = [], 0
        for k, text in enumerate(texts):
            left = len(text)
            for before, body in _pieces(text, self.model.order, SCORED):
                left -= len(body)
                group.append((k, left == 0, before, body))
                size += len(body)
                if size >= SCORED:
                    self._add(group, out)
                    group, size = [], 0
        if group:
            self._add(group, out)
        return out

    def _add(self, group: list[tuple[int, bool, bytes, bytes]], out: np.ndarray) -> None:
        order = self.model.order
        nodes = self.nodes(b"".join([x for *_, before, body in group for x in (before, body)] + [b"\0"]))
        begin = np.cumsum([order, *(len(body) + order for *_, body in group[:-1])])
        end = begin + [len(body) for *_, body in group]
        text = np.array([k for k, *_ in group])
        closes = np.array([last for _, last, *_ in group])
        cuts = np.ravel(np.column_stack([begin, end]))
        for language in range(out.shape[1]):
            summed = np.add.reduceat(self.model.cost[language][nodes], cuts, dtype=np.int64)[::2]
            # the last byte makes no context; the first had the one of a text's beginning
            summed -= np.where(closes, self.model.context[language][nodes[end - 1]] - self.start[language], 0)
            np.add.at(out[:, language], text, summed)


def _pieces(text: bytes, order: int, size: int) -> Iterator[tuple[bytes, bytes]]:
    """A text cut into pieces, each with the ``order`` bytes before it; zero bytes come before a text."""
    zeros = bytes(order)
    for at in range(0, len(text), size):
        yield (zeros + text[max(0, at - order) : at])[-order:], text[at : at + size]


def _grams(pieces: list[tuple[bytes, bytes]], order: int) -> np.ndarray:
    """The gram of ``order`` + 1 bytes that ends at each byte of the pieces, as numbers."""
    data = np.frombuffer(b"".join(x for piece in pieces for x in piece), np.uint8)
    kind = np.uint32 if order < 4 else np.uint64
    count = len(data) - order
    out = data[order:].astype(kind)
    for back in range(1, order + 1):
        out |= data[order - back : order - back + count].astype(kind) << kind(8 * back)
    within = np.ones(len(data), bool)
    at = np.cumsum([0, *(len(body) + order for _, body in pieces[:-1])])
    within[at[:, None] + np.arange(order)] = False
    return out[within[order:]]


def _added(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums the counts of equal codes."""
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    cuts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[cuts], np.add.reduceat(counts, cuts)


class Counter:
    """A task's counts of one language."""

    def __init__(self, order: int):
        self.order = order
        self.pieces: list[tuple[bytes, bytes]] = []
        self.bytes = 0
        self.kept = (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def add(self, text: bytes) -> None:
        for piece in _pieces(text, self.order, COUNTED):
            self.pieces.append(piece)
            self.bytes += len(piece[1])
            if self.bytes >= COUNTED:
                self.settle()

    def settle(self) -> None:
        if self.pieces:
            codes, counts = np.unique(_grams(self.pieces, self.order), return_counts=True)
            both = zip(self.kept, (codes.astype(np.int64), counts))
            self.kept = _added(*map(np.concatenate, both))
        self.pieces, self.bytes = [], 0

    def rows(self, language: str) -> pa.RecordBatch:
        codes, counts = self.kept
        columns = [pa.repeat(language, len(codes)), pa.array(codes), pa.array(counts)]
        return pa.RecordBatch.from_arrays(columns, names=["language", "gram", "n"])


def _counted(labelled: DataFrame, order: int) -> DataFrame:
    """Counts of the longest grams by language, summed within each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[str, Counter] = defaultdict(lambda: Counter(order))
        for batch in slices(batches, SLICE_ROWS):
            languages = batch.column(0).to_pylist()
            for language, text in zip(languages, batch.column(1).cast(pa.binary()).to_pylist()):
                if text:
                    own[language].add(text)
            if sum(c.bytes for c in own.values()) >= COUNTED or len(own) > LANGUAGES:
                for counter in own.values():
                    counter.settle()
                if sum(len(c.kept[0]) for c in own.values()) >= HELD or len(own) > LANGUAGES:
                    yield from (c.rows(language) for language, c in own.items())
                    own.clear()
        for counter in own.values():
            counter.settle()
        yield from (c.rows(language) for language, c in own.items())

    return labelled.mapInArrow(run, "language string, gram long, n long")


def learn(
    labelled: DataFrame,
    language: str = "lang",
    text: str = "text",
    order: int = 3,
    nodes: int = NODES,
) -> Model:
    """A model of every language that has text, from all rows whose language and text are not null.

    ``order`` is the longest context in bytes, 1 to 6. Without any such row the model knows no
    language, and predicts none. More than ``LANGUAGES`` different ones are refused.
    """
    if not 1 <= order <= 6:
        raise ValueError(f"order must be 1 to 6, not {order}")
    rows = labelled.select(F.col(f"`{language}`").alias("language"), F.col(f"`{text}`").alias("text"))
    rows = rows.where("language IS NOT NULL AND text <> ''")

    def counts() -> DataFrame:
        endings = F.array(*[
            F.struct(F.lit(k).alias("size"), F.col("gram").bitwiseAND((1 << 8 * k) - 1).alias("gram"))
            for k in range(1, order + 2)
        ])
        return (
            _counted(rows, order)
            .groupBy("language", "gram").agg(F.sum("n").alias("n"))
            .select("language", F.explode(endings).alias("e"), "n")
            .groupBy("language", "e.size", "e.gram").agg(F.sum("n").alias("n"))
        )

    grams = settled(labelled.sparkSession, counts, "language-grams")
    totals = grams.where("size = 1").groupBy("language").agg(F.sum("n").alias("total"))
    known = sorted(tuple(r) for r in totals.limit(LANGUAGES + 1).collect())
    if len(known) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not known:
        return Model((), order, (), np.zeros((0, 1), np.int32), np.zeros((0, 1), np.int32))
    languages, bound = [name for name, _ in known], max(512, min(nodes, CELLS // len(known)))
    number = F.create_map(*[F.lit(x) for k, (name, _) in enumerate(known) for x in (name, k)])
    total = F.create_map(*[F.lit(x) for name, n in known for x in (name, n)])
    step = F.floor(-F.log2(F.col("n") / total[F.col("language")]) * STEPS).cast("int")
    by_gram = grams.groupBy("size", "gram").agg(
        F.min(step).alias("step"),
        F.collect_list(F.struct(number[F.col("language")].alias("k"), "n")).alias("seen"),
    )
    # the most frequent steps that together are few enough; single bytes and the commonest grams always are
    per_step = sorted(tuple(r) for r in by_gram.groupBy("step").count().collect())
    kept, last = 0, -1
    for at, count in per_step:
        if kept + count > bound:
            break
        kept, last = kept + count, at
    table = by_gram.where(F.col("step") <= last).toArrow()
    size, gram = (table[c].to_numpy() for c in ("size", "gram"))
    seen = table["seen"].combine_chunks()
    of = np.repeat(np.arange(len(gram)), np.diff(seen.offsets.to_numpy()))
    flat = seen.flatten()
    found = np.zeros((len(gram), len(languages)), np.int64)
    found[of, flat.field("k").to_numpy()] = flat.field("n").to_numpy()
    by_size = {}
    for k in range(1, order + 2):
        own = np.flatnonzero(size == k)
        own = own[np.argsort(gram[own])]
        by_size[k] = (gram[own], found[own])
    return freeze(languages, order, by_size)


@lru_cache(maxsize=2)
def _scorer(broadcast) -> Scorer:
    return Scorer(broadcast.value)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, the language in which the whole text is coded shortest, and ``score``.

    Equal lengths go to the first name. ``score`` is that language's share of the probability of the text, all being
    equally likely beforehand: 0 to 1. Null text, text without a letter, and any text if the model
    knows no language, get ``und`` and 0. Rows stay as they are; columns of these names are replaced.
    """
    docs = without(docs, "lang_pred", "score")
    place = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = np.array(model.languages, dtype=object)
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared)
        for batch in slices(batches, SLICE_ROWS):
            texts = batch.column(place).cast(pa.binary()).to_pylist()
            lengths = scorer.lengths([t or b"" for t in texts])
            ahead = (lengths - lengths.min(axis=1, keepdims=True)) / UNIT
            yield with_columns(
                batch,
                lang_pred=pa.array(names[lengths.argmin(axis=1)], pa.string()),
                score=pa.array(1 / np.exp2(-ahead).sum(axis=1)),
            )

    if not model.languages:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    schema = T.StructType([*docs.schema.fields, *added])
    letters = F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))
    return docs.mapInArrow(run, schema).withColumns({
        "lang_pred": F.when(letters, F.col("lang_pred")).otherwise(F.lit(UNKNOWN)),
        "score": F.when(letters, F.col("score")).otherwise(F.lit(0.0)),
    })
