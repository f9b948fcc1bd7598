"""Runs of repeated words, found by minimizers of several scales.

A run is a stretch of words with smallest period q (words q apart are identical), at least 4 q and six
words long, that no neighbouring word extends. Two searches find all of them.

*Lags.* For periods below ``FIRST`` the words are compared with themselves q places further on.

*Scales.* Scale P = 16, 32, 64 ... finds periods from P to 2 P - 1 with grams of P / 2 words. A gram with a
period of an eighth of P or less is left out: it lies inside a run that a smaller scale has found. Of the others,
each window of P / 2 neighbouring grams selects its smallest by hash, the leftmost if several are equal.
Selected grams that are equal and q apart, with q in the scale, are seeds, extended word by word.

Why no run is missed: grams of a run with a short period each would all lie in one run of that period,
which would then be the run's own. So some gram of every period of the run takes part. A window that
holds it, and the same window one period on, are equal (P / 2 grams of P / 2 words fit in P <= q words, and the
run has four periods), so they select the same gram, q apart. Why seeds are few: equal grams that
take part are more than an eighth of P apart, as nearer ones would give them a short period; so a selected gram
has at most 16 equals within 2 P.

Everything here works on many texts at once, put one after the other with a separator that equals
nothing. A text is one row and is searched in one task; memory is some 100 bytes per word of the
texts in hand (``SLICE_ROWS`` of them, or one long one). Time is in proportion to words times scales.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from parley.llm.common import slices, with_columns, without

#: What makes a run: this many periods and words at least.
PERIODS, LEAST_WORDS = 4, 6
#: Periods below are found by lags; the first scale. Its grams have to be eight words or more.
FIRST = 16
SLICE_ROWS = 256

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
Runs = list[tuple[int, int, int]]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers; the fixed numbers are odd and else arbitrary."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)


def _joined(grams: np.ndarray, size: int) -> np.ndarray:
    """Hashes of grams of twice the size."""
    return _mixed(grams[:-size] * np.uint64(0xA24BAED4963EE407) + grams[size:])


def _equal_words(ids: np.ndarray, a: int, b: int, back: bool) -> int:
    """How many words from ``a`` on equal those from ``b`` > ``a`` on; or before them, if ``back``."""
    count, step = 0, 64
    while True:
        room = min(step, (a if back else len(ids) - b) - count)
        if room <= 0:
            return count
        if back:
            x, y = ids[a - count - room : a - count][::-1], ids[b - count - room : b - count][::-1]
        else:
            x, y = ids[a + count : a + count + room], ids[b + count : b + count + room]
        differ = x != y
        first = int(differ.argmax())
        if differ[first]:
            return count + first
        count, step = count + room, step * 2


def _is_smallest(ids: np.ndarray, start: int, end: int, period: int) -> bool:
    """Whether a stretch of four periods or more has no smaller one; such a one would divide it."""
    rest, divisor = period, 2
    while rest > 1:
        if divisor * divisor > rest:
            divisor = rest
        if rest % divisor == 0:
            lag = period // divisor
            if np.array_equal(ids[start : end - lag], ids[start + lag : end]):
                return False
            while rest % divisor == 0:
                rest //= divisor
        divisor += 1
    return True


def _by_lag(ids: np.ndarray, lag: int) -> Runs:
    least = max(LEAST_WORDS, PERIODS * lag) - lag
    same = np.flatnonzero(ids[lag:] == ids[:-lag])
    if len(same) < least:
        return []
    cuts = np.flatnonzero(np.diff(same) != 1)
    first, last = same[np.r_[0, cuts + 1]], same[np.r_[cuts, len(same) - 1]]
    long = last - first + 1 >= least
    found = zip(first[long].tolist(), last[long].tolist())
    return [(s, e + 1 + lag, lag) for s, e in found if _is_smallest(ids, s, e + 1 + lag, lag)]


def _selected(grams: np.ndarray, window: int, hidden: Runs, size: int) -> np.ndarray:
    """Places of the window minima among grams of ``size`` words outside the hidden runs."""
    place = np.uint64((1 << max(1, len(grams).bit_length())) - 1)
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    least = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
    if hidden:
        depth = np.zeros(len(grams) + 1, np.int64)
        for start, end, _ in hidden:
            if end - size >= start and start < len(grams):
                depth[start] += 1
                depth[min(end - size + 1, len(grams))] -= 1
        least[np.cumsum(depth[:-1]) > 0] = none
    width = 1
    while width < window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    chosen = np.zeros(len(grams), bool)
    chosen[(least[least != none] & place).astype(np.int64)] = True
    return np.flatnonzero(chosen)


def _seeds(grams: np.ndarray, chosen: np.ndarray, scale: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of equal chosen grams a period of this scale apart that go on being equal."""
    order = np.argsort(grams[chosen], kind="stable")
    value, at = grams[chosen][order], chosen[order]
    places, periods, step = [], [], 1
    while step < len(at):
        apart = at[step:] - at[:-step]
        near = (value[step:] == value[:-step]) & (apart < 2 * scale)
        if not near.any():
            break
        near &= apart >= scale
        places.append(at[:-step][near])
        periods.append(apart[near])
        step += 1
    if not places:
        return chosen[:0], chosen[:0]
    place, period = np.concatenate(places), np.concatenate(periods)

    def equal(shift: int) -> np.ndarray:
        a, b = place + shift, place + period + shift
        inside = (a >= 0) & (b < len(grams))
        last = len(grams) - 1
        return inside & (grams[a.clip(0, last)] == grams[b.clip(0, last)])

    # a run's words go on being equal for three periods, so for two grams more on one side
    long = (equal(size) & equal(2 * size)) | (equal(-size) & equal(-2 * size))
    place, period = place[long], period[long]
    order = np.lexsort((place, period))
    return place[order], period[order]


def _by_scale(ids: np.ndarray, grams: np.ndarray, scale: int, size: int, known: Runs) -> Runs:
    hidden = [run for run in known if run[2] <= size // 4]
    chosen = _selected(grams, size, hidden, size)
    found, last, reached = [], 0, 0
    for place, period in zip(*(x.tolist() for x in _seeds(grams, chosen, scale, size))):
        if period == last and place < reached:
            continue
        start = place - _equal_words(ids, place, place + period, back=True)
        reached = place + _equal_words(ids, place, place + period, back=False)
        last, end = period, reached + period
        if end - start >= PERIODS * period and _is_smallest(ids, start, end, period):
            found.append((start, end, period))
    return found


def runs_of(ids: np.ndarray, sizes: list[int]) -> Runs:
    """(start, end, period) of all runs, in texts put one after the other, longest first.

    ``ids`` holds a number for each word, and after each text one that no other word has; ``sizes`` are
    the texts' numbers of words.
    """
    longest = sizes[0] if sizes else 0
    known: Runs = []
    for lag in range(1, min(FIRST, longest // PERIODS + 1)):
        known += _by_lag(ids, lag)
    if longest < PERIODS * FIRST:
        return known
    scale, size = FIRST, 1
    left, grams = len(sizes), _mixed(ids.astype(np.uint64))
    while longest >= PERIODS * scale:
        while sizes[left - 1] < PERIODS * scale:
            left -= 1
        words = sum(sizes[:left]) + left  # shorter texts are too short for this scale
        grams = grams[:words]
        while size < scale // 2 and len(grams) > size:
            grams, size = _joined(grams, size), size * 2
        known += _by_scale(ids[:words], grams, scale, size, known)
        scale *= 2
    return known


def _searched(texts: list[bytes | None]) -> tuple[list[Runs], list[bytes]]:
    """For each text its runs by start and period, as (start, length, period), and what is left of it."""
    words = [t.split() if t else [] for t in texts]
    number: dict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    order = sorted(range(len(texts)), key=lambda k: -len(words[k]))
    sizes = [len(words[k]) for k in order]
    begins = np.cumsum([0, *(n + 1 for n in sizes)])
    ids = np.empty(begins[-1], np.int64)
    for k, n, at in zip(order, sizes, begins.tolist()):
        ids[at : at + n] = np.fromiter(map(number.__getitem__, words[k]), np.int64, n)
        ids[at + n] = -1 - at
    runs: list[Runs] = [[] for _ in texts]
    kept = np.ones(len(ids), bool)
    for start, end, period in runs_of(ids, sizes):
        of = int(np.searchsorted(begins, start, "right")) - 1
        runs[order[of]].append((start - int(begins[of]), end - start, period))
        kept[start + period : end] = False
    for k, n, at in zip(order, sizes, begins.tolist()):
        if runs[k]:
            runs[k].sort(key=lambda run: (run[0], run[2]))
            words[k] = compress(words[k], kept[at : at + n].tolist())
    return runs, [b" ".join(w) for w in words]


def _run_lists(runs: list[Runs]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, runs)]).astype(np.int32)
    flat = [run for each in runs for run in each]
    columns = [pa.array([run[k] for run in flat], pa.int64()) for k in range(3)]
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.StructArray.from_arrays(columns, names=RUN.names)
    )


def collapse_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the runs of repeated words in each text, and the text with each run cut to one period.

    ``runs`` is an array of (start, length, period), all in words, by start, then period; ``collapsed``
    the words that no run holds after its first period, joined by one space. Words are stretches
    without ASCII white space. Null, empty and blank texts have no words: no runs and an empty
    ``collapsed``, never null. Repeated rows are searched each by itself; other columns stay as they
    are, those named ``runs`` or ``collapsed`` are replaced. Nothing is shuffled.
    """
    docs = without(docs, "runs", "collapsed")
    added = [
        T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("collapsed", T.StringType()),
    ]
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE_ROWS):
            runs, left = _searched(batch.column(place).cast(pa.binary()).to_pylist())
            yield with_columns(
                batch, runs=_run_lists(runs), collapsed=pa.array(left, pa.binary()).cast(pa.string())
            )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))
