"""Ids of any size and type in the operators that compare documents by id."""

from __future__ import annotations

import decimal

import pytest

from parley.llm import jaccard, lz_dedup, suffix_dedup
from parley.session import clear_scratch, scratch_folders
from tests.llm import brute

TOP, LOW = (1 << 63) - 1, -(1 << 63)
A = " ".join(f"word{i}" for i in range(40))
B = " ".join(f"other{i}" for i in range(30))
TEXTS = [A, A + " end", "x " + A, B, B, None, ""]

IDS = {
    "2^62": ([(1 << 62) + k for k in (5, 7, 3, 9, 8, 1, 2)], "long"),
    "both ends": ([TOP, LOW, 0, TOP - 1, -1, LOW + 1, 7], "long"),
    "text": (["x1", "10", "9", "é", "Z", "", "a"], "string"),
    "decimal": ([decimal.Decimal(f"{k}.5") for k in (3, 1, 2, 9, 8, 5, 6)], "decimal(5,1)"),
    "int": ([7, -3, 5, 1, 0, 2, 4], "int"),
}


def frame(spark, ids, kind, texts):
    return spark.createDataFrame(list(zip(ids, texts)), f"doc_id {kind}, text string")


@pytest.mark.parametrize("name", list(IDS))
def test_results_do_not_depend_on_what_ids_are(spark, name):
    ids, kind = IDS[name]
    df = frame(spark, ids, kind, TEXTS)
    docs = list(zip(ids, TEXTS))
    got = {r.doc_id: (r.n_tokens, r.n_removed, brute.sha(bytes(r.kept))) for r in lz_dedup.remove_repeats(df).collect()}
    assert got == brute.word_repeats(docs)
    if name not in ("both ends", "text"):  # they share the places of ids
        return
    got = {r.doc_id: (r.bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept))) for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == brute.byte_repeats(docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect()}
    assert got == brute.components(docs)


@pytest.mark.parametrize("name", ["both ends", "int"])
def test_rows_without_an_id_come_last(spark, name):
    ids, kind = IDS[name]
    df = frame(spark, [*ids[:3], None, None], kind, [A, B, "y " + B, A, B])
    got = sorted((str(r.doc_id), r.n_removed) for r in lz_dedup.remove_repeats(df).collect())
    kept = dict(got[:0])
    for id_, removed in got:
        kept.setdefault(id_, []).append(removed)
    assert sorted(kept["None"]) == [30, 40]  # both whole texts stand before
    found = jaccard.near_duplicates(df).collect()
    by_text = {}
    for r in found:
        by_text.setdefault(r.digest, set()).add(r.component_id)
    assert all(None not in c and len(c) == 1 for c in by_text.values())
    only = frame(spark, [None, None], kind, [A, A])
    assert [r.component_id for r in jaccard.near_duplicates(only).collect()] == [None, None]
    assert lz_dedup.remove_repeats(frame(spark, [], kind, [])).count() == 0


def test_tables_go_with_their_folders(spark):
    clear_scratch(spark)
    before = len(spark.catalog.listTables())
    lz_dedup.remove_repeats(frame(spark, [1, 2], "long", [A, A])).collect()
    assert scratch_folders(spark) and len(spark.catalog.listTables()) > before
    clear_scratch(spark)
    assert len(spark.catalog.listTables()) <= before
