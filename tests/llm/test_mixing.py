from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from parley.llm import mixing
from tests.llm import brute


def mixed(df, **options):
    return mixing.taken_words(mixing.mix(df, **options)).collect()


def check(rows, docs):
    sizes = defaultdict(int)
    for _, text, _, source in docs:
        sizes[source] += len(brute.words(text))
    target = brute.targets(sizes)
    taken = Counter()
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
    for source, size in sizes.items():
        assert abs(taken[source] - target[source]) <= max(1, size / 128, sum(sizes.values()) / (1 << 15) + 1)
    assert len(rows) == len(docs)


def corpus(counts, words=lambda i: i % 40):
    docs, at = [], 0
    for source, n in counts.items():
        for i in range(n):
            docs.append((at, " ".join(f"w{j}" for j in range(words(i))), "en", source))
            at += 1
    return docs


def test_targets_are_met(frame):
    docs = corpus({"b": 200, "a": 900, "c": 10, None: 30, "é": 50})
    check(mixed(frame(*docs)), docs)


def test_reruns_agree(frame):
    docs = corpus({"a": 100, "b": 30})
    first = {r.doc_id: r.taken for r in mixed(frame(*docs))}
    assert first == {r.doc_id: r.taken for r in mixed(frame(*docs).repartition(5))}


def test_any_stretch_is_near_the_weights(frame):
    docs = corpus({"a": 400, "b": 300, "c": 300}, words=lambda i: 20)
    plan = mixing.mix(frame(*docs), block_words=10)
    slots = sorted({(r.slot, r.source) for r in plan.parts.collect()}, key=lambda s: s[0])
    share = {r.source: r.target / 20_000 for r in plan.documents.collect()}
    for at in range(0, len(slots) - 200, 50):
        seen = Counter(s for _, s in slots[at : at + 200])
        for source, part in share.items():
            assert abs(seen[source] - 200 * part) <= 6


def test_nulls_empty_repeats_and_tiny_sources(frame):
    docs = [
        (1, None, "en", "a"), (2, "", "en", "b"), (3, "x y z", "en", "c"), (3, "x y z", "en", "c"),
        (None, "p q", "en", None), (4, "one", "en", "d"), (5, " ".join("w" * 500), "en", "e"),
    ]
    check(mixed(frame(*docs)), docs)
    assert mixed(frame((1, "x")).where("false")) == []
    assert [r.taken for r in mixed(frame((1, None), (2, " ")))] == [0, 0]


def test_documents_of_the_mix(frame):
    docs = corpus({"a": 120, "b": 15, "c": 15})
    df = frame(*docs, docs[3], docs[3])
    taken = Counter()
    for r in mixing.taken_words(mixing.mix(df)).collect():
        taken[r.doc_id] += r.taken
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    got, text = Counter(), {d: t for d, t, _, _ in docs}
    for r in out.collect():
        assert r.text in text[r.doc_id]
        got[r.doc_id] += len(brute.words(r.text))
    assert got == +taken
