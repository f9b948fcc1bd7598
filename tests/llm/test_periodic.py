"""Runs of repeated words against a search of all lags."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parley.llm import periodic
from parley.llm.queries import op11_periodic_runs
from tests.conftest import SF
from tests.llm import brute


def found(*texts):
    return periodic._searched([t.encode() if t is not None else None for t in texts])


def agrees(*texts):
    runs, left = found(*texts)
    for text, own, rest in zip(texts, runs, left):
        w = brute.words(text)
        assert own == brute.word_runs(w), text
        gone = {i for s, length, q in own for i in range(s + q, s + length)}
        assert rest.decode() == " ".join(x for i, x in enumerate(w) if i not in gone)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=80).map(" ".join), max_size=4))
def test_two_letters(texts):
    agrees(*texts)


@st.composite
def nested(draw):
    """Loops within loops, with stray words between."""
    w = draw(st.lists(st.sampled_from("abcdef"), min_size=1, max_size=30))
    for _ in range(draw(st.integers(1, 3))):
        w = w * draw(st.integers(1, 6)) + draw(st.lists(st.sampled_from("abcxyz"), max_size=9))
        w = w[draw(st.integers(0, 5)) :][:1500]
    return " ".join(w)


@settings(max_examples=150, deadline=None)
@given(st.lists(nested(), min_size=1, max_size=3))
def test_loops_within_loops(texts):
    agrees(*texts)


@pytest.mark.parametrize("period", [*range(1, 40), 63, 64, 65, 127, 128, 200, 255, 256, 257])
def test_each_period(period):
    rng = np.random.default_rng(period)
    for alphabet in (2, 4, 1000):
        word = [str(x) for x in rng.integers(0, alphabet, period)]
        head = [str(x) for x in rng.integers(0, 1000, 37)]
        for length in (4 * period, 4 * period - 1, 5 * period + 3):
            agrees(" ".join([*head, *(word * 6)[:length], *head]))


def test_long_period_made_of_one_word_but_for_one():
    for inner in (100, 511, 600):
        agrees(" ".join((["a"] * inner + ["b"]) * 4), " ".join((["a"] * inner + ["b", "c"] * 40) * 4))


def test_no_run_joins_two_texts():
    runs, left = found("a a a", "a a a", "a a a a a", "a a a a a a")
    assert runs == [[], [], [], [(0, 6, 1)]]
    assert left == [b"a a a", b"a a a", b"a a a a a", b"a"]


def test_nulls_empty_texts_and_clashing_columns(spark):
    df = spark.createDataFrame(
        [(1, None, 5), (1, "", 5), (None, " \t\n", 6), (2, "x y " * 4, None), (2, "x y " * 4, None)],
        "doc_id long, text string, RUNS int",
    )
    got = periodic.collapse_runs(df)
    assert got.columns == ["doc_id", "text", "runs", "collapsed"]
    rows = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()]
    assert rows == [(1, [], ""), (1, [], ""), (None, [], ""), (2, [(0, 8, 2)], "x y"), (2, [(0, 8, 2)], "x y")]
    assert periodic.collapse_runs(df.limit(0)).count() == 0


def test_a_text_of_a_million_words():
    rng = np.random.default_rng(3)
    word = " ".join(map(str, rng.integers(0, 5000, 200_000)))
    runs, left = found(" ".join([word] * 5 + ["end"]))
    assert (0, 1_000_000, 200_000) in runs[0] and left[0].decode() == word + " end"


def test_query_over_whole_table(spark, documents):
    got = {r.doc_id: tuple(r)[1:] for r in op11_periodic_runs(spark, SF).collect()}
    assert got == {d.doc_id: brute.run_row(d.doc_id, d.text) for d in documents}
    assert sum(r[0] > 0 for r in got.values()) > len(documents) // 20
