"""Registered queries of the operators in this package, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import (
    bpe,
    chat,
    jaccard,
    langid,
    lz_dedup,
    mixing,
    neighbours,
    periodic,
    prefix_trie,
    quality_rules,
    shards,
    suffix_dedup,
    token_counts,
)
from parley.llm.common import n_bytes, n_words, table, words, written
from parley.operators.joins import spread_join

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def _query(run: Query) -> Query:
    _QUERIES[run.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


@_query
def op1_chat_perspectives(spark, sf):
    return chat.rotate(table(spark, sf, "conversations"))


@_query
def op2_shuffled_shards(spark, sf):
    sharded = shards.shuffle_into_shards(table(spark, sf, "documents"), shards=40)
    return sharded.select(
        "doc_id",
        (n_bytes(F.col("text")) + shards.ROW_BYTES).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query
def op3_mixed_sources(spark, sf):
    plan = mixing.mix(table(spark, sf, "documents"))
    return mixing.taken_words(plan).select("doc_id", "source", "size", "source_size", "target", "taken")


@_query
def op9_quality_rules(spark, sf):
    report = quality_rules.quality_report(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return report.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@_query
def op4_byte_bpe(spark, sf):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, path, pattern).drop("text")
    decoded = bpe.decode(encoded, path, pattern)
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op7_nearest_vectors(spark, sf):
    vectors = written(neighbours.usable(table(spark, sf, "embeddings")), "vectors")
    return neighbours.nearest(vectors, vectors.where("id % 100 = 0"), k=10)


@_query
def op8_token_counts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select(
        "doc_id",
        n_bytes(F.col("text")).alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 2048).alias("over_limit"),
    )


@_query
def op5_suffix_dedup(spark, sf):
    left = suffix_dedup.remove_repeats(table(spark, sf, "documents"))
    return left.select(
        "doc_id",
        F.col("bytes").alias("n_bytes"),
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@_query
def op10_lz_dedup(spark, sf):
    left = lz_dedup.remove_repeats(table(spark, sf, "documents"))
    return left.select(
        "doc_id",
        F.col("n_tokens").alias("n_words"),
        "n_removed",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@_query
def op6_jaccard_components(spark, sf):
    found = jaccard.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def with_planted_loops(docs: DataFrame) -> DataFrame:
    """doc_id and text; of the documents whose id's checksum ends in 0 the text goes round in circles.

    From a word on that the checksum chooses, such a text repeats its next words. A null id counts as
    an empty one.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    n, g = n_words(F.col("text")), F.floor(h / 10)
    at = F.when(n > 0, g % n)
    period = 1 + F.floor((n - at) / (3 + g % 8))
    turns = F.ceil((n - at) / period)
    found = docs.select("doc_id", "text", h.alias("h"), n.alias("n"), *[
        x.cast("int").alias(name) for name, x in (("at", at), ("period", period), ("turns", turns))
    ])
    own = words(F.col("text"))
    loop = F.flatten(F.array_repeat(F.slice(own, F.col("at") + 1, F.col("period")), F.col("turns")))
    rest = F.slice(loop, F.lit(1), F.col("n").cast("int") - F.col("at"))
    looped = F.array_join(F.concat(F.slice(own, F.lit(1), F.col("at")), rest), " ")
    return found.select("doc_id", F.when(F.expr("h % 10 = 0 AND n > 0"), looped).otherwise(F.col("text")).alias("text"))


@_query
def op11_periodic_runs(spark, sf):
    docs = with_planted_loops(table(spark, sf, "documents"))
    found = periodic.collapse_runs(docs).drop("text")
    # the greatest length, then the smallest start and period
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r.length, -r.start, -r.period))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.col2")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.col3")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@_query
def op13_language_id(spark, sf):
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    docs = table(spark, sf, "documents").withColumn("held_out", held_out)
    model = langid.learn(docs.where(~F.col("held_out")))
    found = langid.predict(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def rebuilt_turns(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conv_id, and its rebuilt turns: a checksum says how many it takes of conversation conv_id - conv_id % 5."""
    most = 8
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    convs = numbered.groupBy("conv_id").agg(h.alias("h"))
    turn = F.struct("pos", "turn_id", "n_bytes")
    firsts = (
        numbered.where(f"pos <= {most} AND conv_id % 5 = 0")
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(turn)).alias("firsts"))
    )
    taken = F.slice(F.coalesce("firsts", F.array().cast("array<struct<pos:long,turn_id:string,n_bytes:long>>")), F.lit(1), F.col("h").cast("int"))
    plans = (
        convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5)
        .join(firsts, "base", "left")
        .select("conv_id", "h", taken.alias("taken"))
    )
    begun = plans.select("conv_id", F.inline("taken"))
    shift = plans.select("conv_id", "h", (F.size("taken") - F.col("h")).alias("shift"))
    own = spread_join(numbered, shift, ["conv_id"], "left").where("pos > h")
    rest = own.select("conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "turn_id", "n_bytes")
    return convs.select("conv_id"), begun.unionByName(rest)


@_query
def op12_prefix_trie(spark, sf):
    numbered = written(prefix_trie.number_turns(table(spark, sf, "conversations")), "turns-numbered")
    return prefix_trie.trie_nodes(*rebuilt_turns(numbered))
