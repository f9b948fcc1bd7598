"""The prefix trie against one built from dictionaries."""

from __future__ import annotations

import random

import pytest

from parley.llm import prefix_trie
from parley.llm.common import table
from parley.llm.queries import op12_prefix_trie, rebuilt_turns
from tests.conftest import SF
from tests.llm import brute

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=lambda r: r[:2])


def plain(rows):
    """The trie of conversations as they are."""
    convs = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        convs.setdefault(conv, []).append((role or "", text or ""))
    return brute.trie(convs)


def made(seed, convs=60, length=8, turns=2, start=0):
    rng = random.Random(seed)
    out = []
    for c in range(start, start + convs):
        for d in range(rng.randint(0, length)):
            out.append((c, d, "u" if d % 2 else "a", "é" * rng.randint(1, turns)))
    return out


@pytest.mark.parametrize("limit", [2, 10_000])
def test_small_containers_give_the_same_trie(spark, limit):
    rows = made(1) + made(2, convs=10, length=0, start=100)
    shared = [(c, d, "s", f"prompt {d}") for c in range(200, 230) for d in range(5)]
    shared += [(c, 5, "u", str(c % 7)) for c in range(200, 225)]
    rows += shared
    assert rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS), limit)) == plain(rows)


@pytest.mark.parametrize("limit", [2, 10_000])
def test_long_conversations_are_cut_into_segments(spark, monkeypatch, limit):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 4)
    monkeypatch.setattr(prefix_trie, "AHEAD", 3)
    monkeypatch.setattr(prefix_trie, "RANGE", 5)
    monkeypatch.setattr(prefix_trie, "BLOCK", 2)
    rows = made(3, length=13)
    rows += [(c, d, "s", "same") for c in range(300, 320) for d in range((c % 3 + 1) * 4)]
    rows += [(c, d, "s", "same") for c in range(400, 403) for d in range(23)]
    assert rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS), limit)) == plain(rows)


def test_nulls_ties_repeats_and_empty_tables(spark):
    rows = [
        (1, None, None, None), (1, 0, "a", ""), (1, 0, "a", ""), (1, 0, "a", "b"), (1, 0, None, "z"),
        (2, 5, None, None), (2, 9, "a:", "x"), (3, -7, None, ""), (3, -2, "a", ":x"), (None, 0, "a", "lost"),
        (-4, 1, "", ""),
    ]
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS depth", "'x' AS head", "2 AS POS")
    assert rows_of(prefix_trie.prefix_trie(df)) == plain([r for r in rows if r[0] is not None])
    assert prefix_trie.prefix_trie(df.limit(0)).count() == 0


def test_rebuilding_and_turnless_members(spark):
    rows = made(5, convs=300, length=9, turns=1, start=-40)
    rows = [r for r in rows if r[0] % 10]  # half of the conversations that lend their turns are absent
    numbered = prefix_trie.number_turns(spark.createDataFrame(rows, TURNS)).cache()
    want = brute.trie(brute.rebuilt(rows))
    assert rows_of(prefix_trie.trie_nodes(*rebuilt_turns(numbered), limit=20)) == want
    assert want[0][3] > 100 and not all(brute.rebuilt(rows).values())


def test_query_over_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(op12_prefix_trie(spark, SF)) == brute.trie(brute.rebuilt(rows))
