from __future__ import annotations

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from parley.llm import quality_rules as q
from tests.llm import brute


def counted(df):
    return {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in q.counted(df).collect()}


def test_counts_of_random_texts(frame):
    rnd = random.Random(2)
    texts = [
        "".join(rnd.choice(["a", "b", "é", " ", " ", "\n", "\t", "#", "&", " ", "\x1c", "\x0b"]) for _ in range(rnd.randint(0, 300)))
        for _ in range(200)
    ]
    texts += [None, "", " \n ", "a b", "a a a", "a a a a", "x y z " * 4000, "same line\n" * 50 + "\n \n"]
    docs = list(enumerate(texts))
    assert counted(frame(*docs)) == {d: brute.counts(t) for d, t in docs}


def binomial(x, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(x + 1))


def test_tail_is_exact(spark):
    cases = [(0, 10, 0.1), (3, 50, 0.1), (5, 300, 0.02), (40, 1000, 0.05)]
    for x, n, p in cases:
        row = spark.range(1).select(q._binomial_tail(F.lit(x).cast("long"), F.lit(n).cast("long"), p)).first()
        assert row[0] == pytest.approx(binomial(x, n, p), rel=1e-9)


def test_cutoffs_hold_the_rate(spark, frame):
    """A stratum with many good documents gets cutoffs; the false rejections allowed are respected."""
    plain = " ".join(f"word{i}" for i in range(80))
    docs = [(i, plain + (" #" * 60 if i % 1000 == 0 else ""), "en") for i in range(4000)]
    docs += [(10_000 + i, plain + " #" * 60, "en") for i in range(50)] + [(20_000 + i, plain, "xx") for i in range(5)]
    labels = spark.createDataFrame([(d, 1 if d < 10_000 or d >= 20_000 else 0, 0) for d, *_ in docs], "doc_id long, quality int, toxic int")
    df = frame(*[(d, t, lang, "s") for d, t, lang in docs])
    limits = {r.stratum: r for r in q.cutoffs(q.counted(df), labels).collect()}
    assert limits["xx"].symbols_per_word is None and limits["xx"].n == 5
    # 4 of 4,000 good documents have 0.43 symbols a word: few enough to certify every cutoff.
    assert limits["en"].symbols_per_word == 0.05
    verdict = {r.doc_id: r.kept for r in q.quality_report(df, labels).collect()}
    assert not any(verdict[10_000 + i] for i in range(50))
    assert sum(not verdict[i] for i in range(4000)) == 4
    assert all(verdict[20_000 + i] for i in range(5))
    kept = q.accepted(df, labels)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, k in verdict.items() if k}


def test_search_stops_at_the_first_cutoff_that_fails(spark, frame):
    plain = " ".join(f"word{i}" for i in range(100))
    docs = [(i, plain + " #" * (25 if i % 10 == 0 else 0), "en", "s") for i in range(3000)]
    labels = spark.createDataFrame([(d[0], 1, 0) for d in docs], "doc_id long, quality int, toxic int")
    row = q.cutoffs(q.counted(frame(*docs)), labels).first()
    assert row.symbols_per_word == 0.2  # a tenth of the good documents has exactly 25 symbols in 125 words


def test_nulls_repeats_clashes_and_empty(spark, frame):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    long = " ".join(f"w{i}" for i in range(60))
    df = frame((1, long), (1, long), (None, long), (2, None), (3, "", None, None), (4, "a b c " * 30))
    df = df.withColumn("N_WORDS", F.lit(1)).withColumn("kept", F.lit("x"))
    got = sorted((r.doc_id or 99, r.n_words, r.base_failed, r.kept) for r in q.quality_report(df, labels).collect())
    assert got == [(1, 60, False, True), (1, 60, False, True), (2, 0, True, False), (3, 0, True, False), (4, 90, True, False), (99, 60, False, True)]
    assert q.accepted(df, labels).columns == df.columns and q.accepted(df, labels).count() == 3
    assert q.quality_report(df.where("false"), labels).collect() == []
    assert q.quality_report(df, labels.where("false")).where("kept").count() == 3


def labelled(spark, good):
    return spark.createDataFrame([(d, int(g), 0) for d, g in good], "doc_id long, quality int, toxic int")


PLAIN = " ".join(f"word{i}" for i in range(80))


def test_some_hundred_labels_a_language_certify(spark, frame):
    """252 good documents without a false rejection are the least with four languages."""
    langs = {"de": 252, "es": 251, "fr": 300, "en": 600}
    docs = [(1000 * k + i, PLAIN, lang, "s") for k, (lang, n) in enumerate(langs.items()) for i in range(n)]
    junk = [(10_000 + k, PLAIN + " #" * 60, lang, "s") for k, lang in enumerate(langs)]
    df, labels = frame(*docs, *junk), labelled(spark, [(d[0], True) for d in docs] + [(d[0], False) for d in junk])
    limits = {r.stratum: r.symbols_per_word for r in q.cutoffs(q.counted(df), labels).collect()}
    assert limits == {"de": 0.05, "es": None, "fr": 0.05, "en": 0.05}
    gone = {r.doc_id for r in q.quality_report(df, labels).where("not kept").collect()}
    assert gone == {10_000, 10_002, 10_003}


def test_a_rule_that_fails_does_not_hold_up_the_others(spark, frame):
    long = " ".join(f"{i:040d}" for i in range(80))
    docs = [(i, long, "en", "s") for i in range(600)]
    row = q.cutoffs(q.counted(frame(*docs)), labelled(spark, [(d[0], True) for d in docs])).first()
    assert row.long_words is None and row.symbols_per_word == 0.05 and row.duplicate_lines == 0.1


def plain_search(cells, strata):
    """The certified number of cutoffs of each rule, from the cutoffs that each good document passes."""
    lengths = [len(cuts) for _, cuts in q.RULES.values()]
    levels, frozen, n = [0] * len(lengths), set(), len(cells)
    sets = [sum(math.prod(c) for c in itertools.combinations(lengths, m)) for m in range(len(lengths) + 1)]
    for level, rule in itertools.product(range(1, max(lengths) + 1), range(len(lengths))):
        if rule in frozen or level > lengths[rule]:
            continue
        tried = [level if r == rule else k for r, k in enumerate(levels)]
        x = sum(any(p < k for p, k in zip(cell, tried)) for cell in cells)
        allowed = q.ERROR / strata / 2 ** (len(frozen) + 1) / sets[len(frozen)]
        if x <= n * q.FALSE_REJECTION and binomial(x, n, q.FALSE_REJECTION) <= allowed:
            levels = tried
        else:
            frozen.add(rule)
    return levels, len(frozen)


def test_search_equals_plain_version(spark):
    """Rules together stay below the rate, also where each alone would."""
    rnd = random.Random(9)
    rows, froze = [], set()
    for lang, n in {"a": 900, "b": 1000, "c": 700, None: 800}.items():
        odds = [rnd.choice([0, 0.001, 0.004, 0.01]) for _ in range(5)]
        for _ in range(n):
            hit = [rnd.random() < odd for odd in odds]
            word = rnd.choice([1.7, 2.2, 3.2]) if hit[4] else rnd.choice([11.0, 16.0, 40.0]) if hit[3] else 6.0
            some = rnd.randrange(100)
            rows.append((len(rows), lang, 100, int(100 * word), some * hit[0], some * hit[1], some // 2 * hit[2], 100))
    counts = spark.createDataFrame(rows, "doc_id long, lang string, " + ", ".join(f"{c} long" for c in q.COUNTED[:6]))
    got = {r.stratum: r for r in q.cutoffs(counts, labelled(spark, [(r[0], True) for r in rows])).collect()}
    for lang in ("a", "b", "c", None):
        cells = []
        for _, stratum, words, chars, symbols, lines, repeats, n_lines in rows:
            if stratum == lang:
                scores = [symbols / words, lines / n_lines, repeats / words, chars / words, -chars / words]
                cells.append([sum(not s > cut for cut in cuts) for s, (_, cuts) in zip(scores, q.RULES.values())])
        levels, failures = plain_search(cells, 4)
        froze.add(failures)
        assert [got[lang][name] for name in q.RULES] == [cuts[k - 1] if k else None for k, (_, cuts) in zip(levels, q.RULES.values())]
        assert sum(any(p < k for p, k in zip(cell, levels)) for cell in cells) <= q.FALSE_REJECTION * len(cells)
    assert len(froze) > 1 and max(froze) > 1
