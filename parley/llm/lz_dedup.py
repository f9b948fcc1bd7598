"""Substring deduplication by relative Lempel-Ziv parsing over words.

Questioned text is dealt into reference blocks so that every window of 13 words meets all its possible
sources in one block. The block is indexed by its windows, and each text is factored against it
greedily: from the first window that occurs in an earlier document, the factor is drawn out as far as
both texts agree. Windows that straddle the end of a factor are looked up by themselves, so that none
is lost where a greedy factor ends and another source would go on.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm import windows
from parley.llm.common import settled

LENGTH, GRAM, CROWD = 13, 5, 1 << 10
KIND = windows.Tokens(
    LENGTH,
    GRAM,
    CROWD,
    tokens=windows.split_words,
    hashes=lambda text: windows.word_hashes(text.encode()),
    cut=lambda found, a, b: b" ".join(found[a:b]),
)


def _window_numbers(words: np.ndarray, length: int) -> np.ndarray:
    """A number for each run of ``length`` words; equal runs, and only they, have equal numbers."""
    done, numbers = 0, np.zeros(len(words), np.int64)
    have, powers = 1, words.astype(np.int64)
    left = length
    while left:
        if left & 1:
            n = len(words) - done - have + 1
            pairs = numbers[:n] * (len(words) + 1) + powers[done : done + n]
            numbers = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
            done += have
        left >>= 1
        if left:
            n = len(powers) - have
            pairs = powers[:n] * (len(words) + 1) + powers[have : have + n]
            powers = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
            have *= 2
    return numbers


def factors(
    span: list[bytes],
    doc: np.ndarray,
    tie: np.ndarray,
    start: np.ndarray,
    n: np.ndarray,
    length: int = LENGTH,
) -> windows.Found:
    """Factors of ``length`` words or more, as runs of windows, against earlier documents in the block."""
    numbers: dict[bytes, int] = {}
    words: list[int] = []
    begin = []
    for text in span:
        begin.append(len(words))
        words += [numbers.setdefault(w, len(numbers) + 1) for w in text.split(b" ")]
        words.append(0)  # parts spans; no window goes across
    ends = [*(b - 1 for b in begin[1:]), len(words) - 1]
    index = _window_numbers(np.array(words, np.int64), length)
    # The source of a window: its place in the earliest document.
    places = np.concatenate([np.arange(b, b + k) for b, k in zip(begin, n)])
    owners = np.repeat(np.arange(len(span)), n)
    by_age = np.lexsort((places, doc[owners], index[places]))
    sorted_index = index[places][by_age]
    first = np.flatnonzero(np.concatenate(([True], sorted_index[1:] != sorted_index[:-1])))
    source = np.full(int(index.max(initial=0)) + 1, -1, np.int64)
    source[sorted_index[first]] = by_age[first]
    earliest = source[index[places]]
    source_place, source_owner = places[earliest].tolist(), owners[earliest]
    earlier = doc[source_owner] < doc[owners]
    out: list[tuple[int, int, int]] = []
    offset = np.cumsum(n) - n
    for i in np.unique(owners[earlier]).tolist():
        at, base = 0, int(offset[i])
        count, own = int(n[i]), begin[i]
        while at < count:
            if not earlier[base + at]:
                at += 1
                continue
            there, here, size = source_place[base + at], own + at, length
            limit = min(ends[int(source_owner[base + at])] - there, ends[i] - here)
            while size < limit and words[there + size] == words[here + size]:
                size += 1
            out.append((i, at, min(size - length + 1, count - at)))
            at += size - length + 1  # the windows after straddle the factor's end
    if not out:
        return (np.zeros(0, np.int64),) * 3
    spans_, firsts, counts = (np.array(c) for c in zip(*out))
    return spans_, firsts, counts


def _keep(found: list[bytes], gone: np.ndarray) -> bytes:
    return b" ".join([w for w, g in zip(found, gone.tolist()) if not g]) if gone.any() else b" ".join(found)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """What is left of each document without the words that repeat an earlier document.

    A word goes if it lies in a window of 13 words that also starts in a document with a smaller id;
    windows are judged on the input. One row per row of ``docs``: doc_id, digest (of the text,
    sha-256), bytes, n_tokens (words), n_removed, n_spans, kept (words left, joined by one space) and
    spans (from, to, in words). Null and empty texts have no words. A null id comes after all others;
    rows of one id remove nothing from each other; repeated rows get the same result. Other columns
    are not read.
    """
    known = windows.corpus(docs, doc_id, text)
    repeats = windows.repeated_windows(known, KIND, factors, within=False)
    return windows.per_document(known, windows.cut_texts(known, repeats, KIND, _keep), KIND, _keep)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated words, with all columns; documents that lose every word go.

    A text that loses words is left as its kept words, joined by one space, and ``n_chars``, if there
    is such a column, is its new length; other texts stay as they are. ``docs`` needs the columns doc_id
    and text.
    """

    def changed() -> DataFrame:
        left = remove_repeats(docs).where("n_removed > 0").select(
            F.col("doc_id").alias("_id"),
            F.col("digest").alias("_digest"),
            F.col("n_tokens").alias("_n"),
            F.col("n_removed").alias("_gone"),
            F.decode("kept", "UTF-8").alias("_kept"),
        )
        return left.dropDuplicates(["_id", "_digest"])

    cut = settled(docs.sparkSession, changed, "changed-texts")
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col("doc_id").alias("_own"),
        F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("_sha"),
    )
    same = F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_digest"))
    joined = keyed.join(cut, same, "left")
    text = F.coalesce("_kept", F.col("_row.text"))
    fresh = {"text": text}
    if "n_chars" in docs.columns:
        size = F.length("_kept").cast(docs.schema["n_chars"].dataType)
        fresh["n_chars"] = F.when(F.col("_kept").isNotNull(), size).otherwise(F.col("_row.n_chars"))
    return joined.where("_gone IS NULL OR _gone < _n").select(
        *[(fresh[c] if c in fresh else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns]
    )
