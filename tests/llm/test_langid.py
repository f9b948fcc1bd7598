"""Language identification against plain context counts, and on held-out documents."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from parley.llm import langid
from parley.llm.common import table
from parley.llm.queries import op13_language_id
from tests.conftest import SF

DOC = "text string, lang string"


class Plain:
    """Prediction by partial matching over dictionaries, byte by byte."""

    def __init__(self, texts, order, kept=None):
        self.order, self.seen = order, defaultdict(Counter)
        for text in texts:
            data = bytes(order) + text
            for i in range(order, len(data)):
                for k in range(order + 1):
                    if kept is None or data[i - k : i + 1] in kept:
                        self.seen[data[i - k : i]][data[i]] += 1

    def bits(self, context, byte):
        follow = self.seen.get(context)
        n, d = (sum(follow.values()), len(follow)) if follow else (0, 0)
        if n and follow[byte]:
            return math.log2((n + d) / follow[byte])
        shorter = self.bits(context[1:], byte) if context else 8.0
        return (math.log2((n + d) / d) if n else 0.0) + shorter

    def length(self, text):
        data = bytes(self.order) + text
        return sum(self.bits(data[i - self.order : i], data[i]) for i in range(self.order, len(data)))


TRAIN = [
    ("the cat sat on the mat", "en"), ("", "en"), (None, "en"), ("that was the end of it all", "en"),
    ("die katze saß auf der matte", "de"), ("das war das ende, über alles", "de"), ("ça été\0\0\0x", "fr"),
    ("no language", None),
]
TESTS = ["the end", "die über", "x", "", "zzz qqq\0", "été ça\0\0", "日本語", "the katze été " * 30]


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_lengths_equal_plain_ones(spark, order):
    model = langid.learn(spark.createDataFrame(TRAIN, DOC), order=order)
    assert model.languages == ("de", "en", "fr")
    got = langid.Scorer(model).lengths([t.encode() for t in TESTS]) / langid.UNIT
    for k, name in enumerate(model.languages):
        plain = Plain([t.encode() for t, lang in TRAIN if t and lang == name], order)
        assert got[:, k] == pytest.approx([plain.length(t.encode()) for t in TESTS], abs=0.02)


def test_a_pruned_tree_is_closed_and_scores_as_the_plain_one(spark, documents, monkeypatch):
    rows = [(d.text, d.lang) for d in documents]
    model = langid.learn(spark.createDataFrame(rows, DOC), nodes=700)
    kept = {int(g).to_bytes(k, "big") for k, grams in enumerate(model.grams, 1) for g in grams}
    assert 300 < len(kept) <= 703
    assert all(g[1:] in kept and g[:-1] in kept for g in kept if len(g) > 1)
    monkeypatch.setattr(langid, "SCORED", 50)  # texts are scored in pieces
    texts = [d.text.encode()[:500] for d in documents[:20] if d.text]
    got = langid.Scorer(model).lengths(texts) / langid.UNIT
    for k, name in enumerate(model.languages):
        plain = Plain([t.encode() for t, lang in rows if t and lang == name], 3, kept)
        assert got[:, k] == pytest.approx([plain.length(t) for t in texts], abs=0.05)


def test_counts_do_not_depend_on_pieces(monkeypatch):
    whole, parts = langid.Counter(3), langid.Counter(3)
    text = bytes(np.random.default_rng(1).integers(0, 4, 5000, dtype=np.uint8))
    whole.add(text)
    whole.settle()
    monkeypatch.setattr(langid, "COUNTED", 97)
    parts.add(text)
    parts.settle()
    assert all((a == b).all() for a, b in zip(whole.kept, parts.kept)) and whole.kept[1].sum() == 5000


def test_texts_without_letters_nulls_and_clashing_names(spark):
    model = langid.learn(spark.createDataFrame(TRAIN, DOC))
    df = spark.createDataFrame(
        [(1, None), (1, ""), (None, "12 !?"), (2, "the end of the cat"), (2, "the end of the cat"), (3, "日本語")],
        "doc_id long, text string",
    ).withColumn("SCORE", langid.F.lit("x"))
    got = langid.predict(df, model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score"]
    rows = got.collect()
    assert [r.lang_pred for r in rows[:5]] == ["und", "und", "und", "en", "en"]
    assert [r.score for r in rows[:3]] == [0.0] * 3 and rows[3] .score == rows[4].score > 0.9
    assert rows[5].lang_pred in model.languages and 0 <= rows[5].score <= 1
    assert langid.predict(df.limit(0), model).count() == 0


def test_nothing_to_learn_from_and_too_many_languages(spark, monkeypatch):
    empty = spark.createDataFrame([(None, "en"), ("", "de"), ("x", None)], DOC)
    model = langid.learn(empty)
    assert [tuple(r)[2:] for r in langid.predict(empty, model).collect()] == [("und", 0.0)] * 3
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    with pytest.raises(ValueError):
        langid.learn(spark.createDataFrame(TRAIN, DOC))
    with pytest.raises(ValueError):
        langid.learn(empty, order=0)


def test_equal_lengths_go_to_the_first_name(spark):
    model = langid.learn(spark.createDataFrame([("same words", "b"), ("same words", "a")], DOC))
    row = langid.predict(spark.createDataFrame([("same words", "b")], DOC), model).first()
    assert (row.lang_pred, row.score) == ("a", 0.5)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_held_out_accuracy(spark, sf):
    got = {r.doc_id: r for r in op13_language_id(spark, sf).collect()}
    docs = table(spark, sf, "documents").collect()
    assert set(got) == {d.doc_id for d in docs}
    for d in docs:
        assert got[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2)
        assert 0 <= got[d.doc_id].score <= 1
    held = [d for d in docs if got[d.doc_id].held_out and got[d.doc_id].lang_pred != "und"]
    right = sum(got[d.doc_id].lang_pred == d.lang for d in held)
    assert right >= 0.97 * len(held) > 0
