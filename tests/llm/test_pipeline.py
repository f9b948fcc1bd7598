"""Each stage against a plain version, on what the stage before has kept."""

from __future__ import annotations

import struct
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from parley.llm import bpe, mixing
from parley.llm.common import table, written
from tests.compare import connect
from tests.conftest import SF
from tests.llm import brute


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before and after each stage."""
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, SF), name)
        if name != "byte_bpe":
            assert after.schema.fieldNames() == docs.schema.fieldNames()
        out.append((docs, after))
        docs = after
    return out


def texts(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_quality(stages):
    from parley.llm.oracles import oracles

    before, after = stages[0]
    kept = {r[0] for r in connect(SF).execute(f"SELECT doc_id FROM ({oracles()['op9_quality_rules']}) WHERE kept").fetchall()}
    assert texts(after) == Counter({k: 1 for k in texts(before) if k[0] in kept})
    assert 0 < len(kept) < before.count()


def test_one_of_each_group(stages):
    before, after = stages[1]
    groups = brute.components([(r.doc_id, r.text) for r in before.collect()])
    assert {d for d, _ in texts(after)} == {d for d, (_, root) in groups.items() if d == root}
    assert after.count() < before.count()


def test_no_passage_is_left_twice(stages):
    before, after = stages[2]
    docs = [(r.doc_id, r.text) for r in before.collect()]
    expected = brute.word_repeats(docs)
    got = {r.doc_id: r for r in after.collect()}
    for doc, text in docs:
        n, gone, sha = expected[doc]
        if gone and gone == n:
            assert doc not in got
        else:
            assert brute.sha(" ".join(brute.words(got[doc].text)).encode()) == sha
            assert got[doc].text == text or gone
            assert got[doc].n_chars == len(got[doc].text)


def test_weights(spark, stages):
    before, after = stages[3]
    sizes, taken = Counter(), Counter()
    for r in before.collect():
        sizes[r.source] += len(brute.words(r.text))
    for r in after.collect():
        taken[r.source] += len(brute.words(r.text))
    goal = brute.targets(dict(sizes))
    for source in sizes:
        assert abs(taken[source] - goal[source]) <= sizes[source] / 100
    planned = Counter()
    for r in mixing.taken_words(mixing.mix(before)).collect():
        planned[r.doc_id] += r.taken
    out = Counter()
    for r in after.collect():
        out[r.doc_id] += len(brute.words(r.text))
    assert out == +planned


def test_tokens(stages):
    before, after = stages[4]
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(path), special_tokens={})
    for r in after.collect():
        ids = library.encode_ordinary(r.text)
        assert (r.n_tokens, bytes(r.token_ids)) == (len(ids), struct.pack(f"<{len(ids)}I", *ids))
    assert texts(after) == texts(before)


def test_run_gives_the_last_stage(spark, stages):
    key = lambda r: (r.doc_id, r.text, r.n_tokens)
    assert Counter(map(key, corpus_pipeline.run(spark, SF).collect())) == Counter(map(key, stages[4][1].collect()))


def test_odd_rows_pass_all_stages(spark, frame):
    long = " ".join(f"w{i}" for i in range(80))
    docs = frame((1, long), (1, long), (None, long + " x"), (2, None), (3, ""), (4, "short"), (5, long[::-1], None, None))
    docs = docs.selectExpr("*", "1 AS Shard", "2 AS _copy_of", "'z' AS digest")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "odd")
    assert Counter(r.doc_id for r in docs.collect()).keys() == {1, 5}


def test_empty_table(spark, frame):
    docs = frame((1, "x")).where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "empty")
    assert docs.count() == 0
