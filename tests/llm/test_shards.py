from __future__ import annotations

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from parley.llm import shards
from parley.llm.queries import all_queries
from tests.conftest import SF


def check_law(rows, n):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    sizes = [len(slots.get(s, [])) for s in range(n)]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)


def test_whole_table(spark, documents):
    rows = all_queries()["op2_shuffled_shards"](spark, SF).collect()
    check_law(rows, 40)
    expected = {d.doc_id: (len(d.text.encode()) + 16, zlib.crc32(d.text.encode())) for d in documents}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == expected
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


@pytest.mark.parametrize("bucket_bytes", [300, 2000, 1 << 20])
def test_any_bucket_size(spark, bucket_bytes):
    df = spark.range(1000).selectExpr("id AS doc_id", "concat('t', id) AS text")
    rows = shards.shuffle_into_shards(df, 7, bucket_bytes=bucket_bytes).collect()
    check_law(rows, 7)
    assert sorted(r.doc_id for r in rows) == list(range(1000))


def test_the_order_is_shuffled_and_repeats(spark):
    df = spark.range(2000).selectExpr("id AS doc_id", "'x' AS text")

    def order(frame, seed):
        rows = shards.shuffle_into_shards(frame, 1, seed, bucket_bytes=4000).collect()
        return [r.doc_id for r in sorted(rows, key=lambda r: r.slot)]

    first = order(df, 3)
    assert first == order(df.repartition(13), 3)
    assert first != order(df, 4)
    rises = sum(a < b for a, b in zip(first, first[1:]))
    assert 900 < rises < 1100
    places = sum(abs(a - b) for a, b in enumerate(first)) / len(first)
    assert 600 < places < 734  # two thirds of a thousand on average


def test_nulls_repeats_clashes_and_empty(spark, frame):
    df = frame((1, None), (1, None), (2, ""), (None, "é"), (None, None)).withColumn("SHARD", F.lit(9))
    rows = shards.shuffle_into_shards(df, 3).collect()
    check_law(rows, 3)
    assert Counter((r.doc_id, r.text) for r in rows) == {(1, None): 2, (2, ""): 1, (None, "é"): 1, (None, None): 1}
    assert shards.shuffle_into_shards(df.where("false"), 3).collect() == []


def test_equal_rows_are_dealt_to_all_buckets(spark, monkeypatch):
    """Two thirds of the rows are equal, another tenth too; no bucket holds much more than its share."""
    monkeypatch.setattr(shards, "COPIES", 100)
    df = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 < 2 THEN 7 WHEN id % 10 = 0 THEN 8 ELSE id END AS doc_id", "'some text' AS text"
    )
    sizes, dealt = [], shards._dealt
    monkeypatch.setattr(shards, "_dealt", lambda *args: sizes.append(dealt(*args)) or sizes[-1])
    rows = shards.shuffle_into_shards(df, 7, bucket_bytes=25_000).collect()
    check_law(rows, 7)
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in df.collect())
    buckets = [r["count"] for r in sizes[0].groupBy("_bucket").count().collect()]
    assert len(buckets) == 30 and max(buckets) < 1.3 * 1000
    key = lambda found: sorted((r.doc_id, r.shard, r.slot) for r in found)
    again = shards.shuffle_into_shards(df.repartition(3, "text"), 7, bucket_bytes=25_000).collect()
    assert key(again) == key(rows)


def test_written_shards(spark, tmp_path):
    df = spark.range(100).selectExpr("id AS doc_id", "'x' AS text")
    sharded = shards.shuffle_into_shards(df, 4)
    shards.write_shards(sharded, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    key = lambda rows: sorted((r.doc_id, r.shard, r.slot) for r in rows)
    assert key(back.collect()) == key(sharded.collect())
