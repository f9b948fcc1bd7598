"""Token counts by a two-tier lookup of pre-token lengths, all on the map side.

Tier one is a broadcast table of the lengths of frequent pre-tokens, of bounded size. What it misses is
encoded by the tokenizer's library, in batches, and kept in a cache of the worker. No pre-token is
shuffled, apart from those of the bounded sample that the table is made from.
"""

from __future__ import annotations

import os
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.bpe import SLICE_ROWS, Pieces
from parley.llm.common import slices, to_batch, with_columns, without

#: How the vocabulary's file splits text, and its special strings.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
SPECIAL = regex.compile(r"<\|startoftext\|>|<\|endoftext\|>")

#: The table has this many entries at most, of this many characters each: some megabytes.
TABLE_ENTRIES, ENTRY_CHARS = 1 << 16, 48
#: It is made from about this many documents. They only decide what is looked up fast.
SAMPLE_DOCS = 2048
CACHED_PIECES = 400_000


class Lengths:
    """Counts tokens with one tokenizer file; the same numbers as its library gives for whole texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.splitter = Pieces(PATTERN)
        self.cache: dict[str, int] = {}

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of the normalised text, and the number of special strings in it."""
        if "<|" not in text:
            return self.splitter.split(self.normal(text)), 0
        parts = SPECIAL.split(text)
        pieces = [p for part in parts if part for p in self.splitter.split(self.normal(part))]
        return pieces, len(parts) - 1

    def normal(self, text: str) -> str:
        """As the file's normaliser, which runs itself where Python's rules could differ."""
        if text.isascii() or ("Σ" not in text and unicodedata.is_normalized("NFC", text)):
            return text.lower()
        return self.tokenizer.normalizer.normalize_str(text)

    def learn(self, pieces: list[str]) -> None:
        if pieces:
            found = self.tokenizer.encode_batch(pieces, add_special_tokens=False)
            self.cache.update((p, len(e.ids)) for p, e in zip(pieces, found))


@lru_cache(maxsize=2)
def counter(path: str) -> Lengths:
    return Lengths(path)


def frequent_lengths(docs: DataFrame, path: str, text: str = "text") -> dict[str, int]:
    """Lengths of the most frequent pre-tokens in a sample of documents: ``TABLE_ENTRIES`` at most."""
    share = min(1.0, 2.0 * SAMPLE_DOCS / max(1, docs.count()))
    sample = docs.select(F.col(f"`{text}`").alias("text")).sample(share, 5).limit(SAMPLE_DOCS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in slices(batches, SLICE_ROWS):
            texts = [t for t in batch.column(0).to_pylist() if t]
            seen = Counter(p for t in texts for p in own.pieces(t)[0] if len(p) <= ENTRY_CHARS)
            fields = {"piece": pa.string(), "n": pa.int64()}
            yield to_batch(fields, (list(seen), list(seen.values())))

    top = (
        sample.mapInArrow(run, "piece string, n long")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .where("n > 1")
        .orderBy(F.desc("n"), "piece")
        .limit(TABLE_ENTRIES)
    )
    pieces = [row["piece"] for row in top.select("piece").collect()]
    own = counter(path)
    own.learn(pieces)
    return {p: own.cache[p] for p in pieces}


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, the number of tokens of the whole text.

    No begin or end tokens are counted; special strings inside a text count one each, as the library
    takes them by default; nothing is truncated or padded. Null and empty text have none. Rows stay as
    they are; a column named ``n_tokens`` is replaced. ``path`` must be readable on every worker.
    """
    docs = without(docs, "n_tokens")
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text))
    schema = T.StructType([*docs.schema.fields, T.StructField("n_tokens", T.LongType())])
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, frequent = counter(path), table.value
        for batch in slices(batches, SLICE_ROWS):
            texts = [own.pieces(t) if t else ([], 0) for t in batch.column(place).to_pylist()]
            met = set().union(*[pieces for pieces, _ in texts])
            if len(own.cache) > CACHED_PIECES:
                own.cache.clear()
            own.learn([p for p in met if p not in frequent and p not in own.cache])
            here = {p: frequent.get(p) or own.cache[p] for p in met}
            yield with_columns(
                batch,
                n_tokens=pa.array([sum(map(here.__getitem__, p)) + k for p, k in texts], pa.int64()),
            )

    return docs.mapInArrow(run, schema)
