"""Sharding: a two-pass external shuffle into shards of equal row counts.

Pass one scatters rows uniformly into buckets that fit in memory, by a seeded hash of the whole row; equal
rows that would fill half a bucket are made one row with a count, and their copies are dealt one by
one, by the hash of row and number. Pass two gives every bucket a Fisher-Yates shuffle (``functions.shuffle``). The buckets in order are
one random permutation of the table, and shards are equal stretches of it, so that writing them needs
no further shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import n_bytes, without, written

BUCKET_BYTES = 8 << 20
#: Beyond this many buckets they get larger, so that the broadcast table of their offsets stays small.
MAX_BUCKETS = 1 << 19
ROW_BYTES = 16
#: Copies of a crowded row are made so many at a time.
COPIES = 1024


def _dealt(docs: DataFrame, size: Column, much: int, buckets: int, seed: int) -> DataFrame:
    """The rows of ``docs`` (as ``_row``), each with its ``_bucket``.

    Rows are crowded if their copies together have more than ``much`` bytes, half a bucket. There are two sorts of them a bucket at
    most, so their digests are broadcast; their copies are counted map-side and made anew, some at a time.
    """
    cells = [F.col(f"`{c}`") for c in docs.columns]
    digests = {f"_d{k}": F.xxhash64(F.lit(k), *cells) for k in (1, 2)}

    def bucket(*parts: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(buckets)).cast("int").alias("_bucket")

    sizes = docs.select(size.alias("_size"), *[c.alias(n) for n, c in digests.items()])
    sums = sizes.groupBy(*digests).agg(F.count("*").alias("_n"), F.sum("_size").alias("_bytes"))
    crowded = written(sums.where((F.col("_n") > 1) & (F.col("_bytes") > much)).select(*digests), "crowded-rows")
    row = F.struct(*cells).alias("_row")
    if crowded.isEmpty():
        return docs.select(bucket(*cells), row)
    keyed = docs.select(bucket(*cells), row, *[c.alias(n) for n, c in digests.items()])
    alone = keyed.join(F.broadcast(crowded), list(digests), "left_anti")
    counted = (
        keyed.join(F.broadcast(crowded), list(digests), "left_semi")
        .groupBy("_row", *digests)
        .agg(F.count("*").alias("_n"))
    )
    parts = F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {COPIES}"))
    some = counted.withColumn("_part", F.explode(parts)).repartition("_d1", "_d2", "_part")
    first = F.col("_part") * COPIES
    copies = some.withColumn(
        "_copy", F.explode(F.sequence(first, F.least(F.col("_n"), first + COPIES) - 1))
    )
    return alone.select("_bucket", "_row").union(copies.select(bucket(F.col("_row"), F.col("_copy")), "_row"))


def shuffle_into_shards(
    docs: DataFrame,
    shards: int = 40,
    seed: int = 11,
    text: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (0, 1, ... in each shard).

    Row counts of shards differ by one at most; with fewer rows than shards some stay empty. All rows
    are kept: nulls, empty texts, repeated rows, of which any number may be equal. Columns named ``shard`` or ``slot`` are replaced. All
    columns count towards the hash and need an order, so none may be a map. The same rows and
    parameters give the same result, whatever the partitions. Three jobs run at once, for the number of
    buckets, the rows with many copies and the buckets' row counts; the second pass stays lazy.
    """
    docs = without(docs, "shard", "slot")
    size = n_bytes(F.col(f"`{text}`")) + ROW_BYTES
    total = docs.agg(F.sum(size)).first()[0] or 0
    buckets = min(MAX_BUCKETS, max(1, -(-total // bucket_bytes)))
    dealt = _dealt(docs, size, max(bucket_bytes, total // MAX_BUCKETS) // 2, buckets, seed)

    counts = dealt.groupBy("_bucket").agg(F.count("*").alias("_n"))
    ahead = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = counts.select(
        "_bucket",
        F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"),
        F.sum("_n").over(everything).alias("_rows"),
    )
    shuffled = (
        dealt.repartitionById(buckets, F.col("_bucket"))
        .groupBy("_bucket")
        .agg(F.sort_array(F.collect_list("_row")).alias("_list"))
        .join(F.broadcast(offsets), "_bucket")
        .sortWithinPartitions("_bucket")
        .select("_before", "_rows", F.shuffle("_list", F.lit(seed)).alias("_list"))
        .select("_before", "_rows", F.posexplode("_list").alias("_at", "_row"))
    )
    at = F.col("_before") + F.col("_at")
    shard = F.expr(f"({shards} * (_before + _at)) div _rows")
    return (
        shuffled.withColumn("shard", shard.cast("int"))
        .withColumn("slot", at - F.expr(f"(shard * _rows + {shards - 1}) div {shards}"))
        .select("_row.*", "shard", "slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; rows of a shard lie in order of ``slot``."""
    (
        sharded.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
