"""Suffix-array deduplication of byte strings.

In each block of questioned text the suffixes are sorted, and common prefixes are derived from the
Burrows-Wheeler transform: starting from the interval of all suffixes, every interval is extended
backwards by each character before it, breadth first, so that the bound between two neighbours is met
first at the length of their common prefix. The expansion stops at the wanted length: neighbours not
parted until then share that many bytes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from parley.llm import windows

LENGTH, GRAM, CROWD = 100, 24, 1 << 14


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Places of the sorted suffixes of ``codes``, by prefix doubling.

    Each 0 parts two spans. A suffix ends there: of two that agree so far, that of the earlier span
    comes first. So no comparison is longer than a span, and only suffixes that still agree with
    another are sorted again.
    """
    n, width = len(codes), 7
    parts = np.flatnonzero(codes == 0)
    following = np.searchsorted(parts, np.arange(n))  # the number of the next 0, at it or behind
    left = parts[following] - np.arange(n)
    key, padded = np.zeros(n, np.int64), np.concatenate((codes, np.zeros(width, codes.dtype)))
    for i in range(width):
        key = key * 257 + np.where(i <= left, padded[i : n + i], 0)
    order = np.argsort(key)
    starts = _group_starts(key[order], np.arange(n))
    rank = np.empty(n, np.int64)
    rank[order] = starts
    among = (left < width)[order]  # first, those that end within the characters compared
    while True:
        shared = np.zeros(n, bool)
        shared[1:] = starts[1:] == starts[:-1]
        shared[:-1] |= shared[1:]
        at = np.flatnonzero(shared if among is None else shared & among)
        again = order[at]
        if among is not None:
            key = rank[again] * (n + 1) + following[again]
        elif len(at):
            key = rank[again] * (n + 1) + rank[again + width]
            width *= 2
        else:
            return order
        by_key = np.argsort(key)
        order[at] = again[by_key]
        starts[at] = _group_starts(key[by_key], at)
        rank[order[at]] = starts[at]
        among = None


def _group_starts(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For sorted keys the place of the first equal one."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return places[np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))]


def common_prefix_bounds(codes: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """True at i if the sorted suffixes i - 1 and i share fewer than ``length`` characters.

    Each 0 counts as a character of its own. Strings with one in them are not extended further.
    """
    n, parts = len(codes), int((codes == 0).sum())
    first, before = codes[order].astype(np.uint16), codes[order - 1].astype(np.uint16)
    last_first = np.empty(n, np.int32)
    last_first[np.argsort(before, kind="stable")] = np.arange(n, dtype=np.int32)
    known = np.zeros(n + 1, bool)
    known[: parts + 1] = known[n] = True
    new = np.ones(n - parts, bool)
    new[1:] = first[parts + 1 :] != first[parts:-1]
    # One interval for each character: bounds between them are common prefixes of length 0.
    low = np.concatenate((np.arange(parts), parts + np.flatnonzero(new)))
    known[low] = True
    high = np.append(low[1:], n)
    low, high = low[high < n], high[high < n]
    owner = np.zeros(n, np.int32)
    for _ in range(length - 1):  # in round i, from 1, the intervals are those of strings of length i
        size = high - low
        total = int(size.sum())
        number = np.repeat(np.arange(len(low), dtype=np.int32), size)
        place = np.arange(total) + np.repeat(low - (np.cumsum(size) - size), size)
        real = before[place] > 0
        target = last_first[place[real]]
        owner[target] = number[real]
        target.sort()
        mine, char = owner[target], first[target]
        new = np.ones(len(target), bool)
        new[1:] = (mine[1:] != mine[:-1]) | (char[1:] != char[:-1])
        starts = np.flatnonzero(new)
        if not len(starts):
            break
        ends = target[np.append(starts[1:], len(target)) - 1].astype(np.int64) + 1
        fresh = ~known[ends]
        known[ends] = True
        low, high = target[starts][fresh].astype(np.int64), ends[fresh]
        if not len(low):
            break
    return known[:n]


def repeated(
    span: list[bytes],
    doc: np.ndarray,
    tie: np.ndarray,
    start: np.ndarray,
    n: np.ndarray,
    length: int = LENGTH,
) -> windows.Found:
    """Windows of the spans that occur earlier in the block, earlier by (doc, tie, start)."""
    sizes = np.fromiter(map(len, span), np.int64, len(span)) + 1
    # Bytes become 1 to 256; a 0 behind each span parts it from the next.
    ends = np.cumsum(sizes)
    codes = np.frombuffer(b"\0".join(span) + b"\0", np.uint8).astype(np.int64) + 1
    codes[ends - 1] = 0
    order = suffix_array(codes)
    group = np.cumsum(common_prefix_bounds(codes, order, length))
    mine = np.repeat(np.arange(len(span)), sizes)[order]
    place = order - (ends - sizes)[mine]
    window = np.flatnonzero(place < n[mine])
    group, mine, place = group[window], mine[window], place[window]
    # Only windows that others equal are looked at further.
    shared = np.zeros(len(group), bool)
    shared[1:] = group[1:] == group[:-1]
    shared[:-1] |= shared[1:]
    group, mine, place = group[shared], mine[shared], place[shared]
    by_age = np.lexsort((start[mine] + place, tie[mine], doc[mine], group))
    later = by_age[1:][group[by_age][1:] == group[by_age][:-1]]
    return as_runs(mine[later], place[later])


def as_runs(span: np.ndarray, place: np.ndarray) -> windows.Found:
    """Joins neighbouring places of a span into (span, first place, count)."""
    order = np.lexsort((place, span))
    span, place = span[order], place[order]
    new = np.ones(len(span), bool)
    new[1:] = (span[1:] != span[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    return span[first], place[first], np.diff(np.append(first, len(span)))


KIND = windows.Tokens(
    LENGTH,
    GRAM,
    CROWD,
    tokens=str.encode,
    hashes=lambda text: np.frombuffer(text.encode(), np.uint8).astype(np.uint64),
    cut=lambda data, a, b: data[a:b],
)


def _keep(data: bytes, gone: np.ndarray) -> bytes:
    return np.frombuffer(data, np.uint8)[~gone].tobytes() if gone.any() else data


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """What is left of each document without the bytes that an earlier 100-byte string covers.

    A byte goes if it lies in a string of 100 bytes that also starts earlier: in a document with a
    smaller id, or earlier in its own. Strings are judged on the input. One row per row of ``docs``:
    doc_id, digest (of the text, sha-256), bytes, n_tokens (bytes), n_removed, n_spans, kept (the bytes
    left) and spans (from, to). Null and empty texts have no bytes. A null id comes after all others.
    Rows of one id with different texts are texts of their own in the order of a hash; repeated rows
    are one text and get the same result. Other columns are not read.
    """
    known = windows.corpus(docs, doc_id, text)
    repeats = windows.repeated_windows(known, KIND, repeated, within=True)
    return windows.per_document(known, windows.cut_texts(known, repeats, KIND, _keep), KIND, _keep)
