"""The corpus pipeline: quality rules, near duplicates, repeated passages, source weights, tokens."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parley.llm import bpe, jaccard, lz_dedup, mixing, quality_rules
from parley.llm.common import table, written
from parley.session import clear_scratch, scratch_folders

_left: dict[int, list[str]] = {}


def _after(number: int, spark: SparkSession) -> None:
    """Removes what the stages before stage ``number`` have stored on the way. Their results have been
    written by then, and do not need it any more."""
    for earlier in [k for k in _left if k < number]:
        known = set(scratch_folders(spark))
        clear_scratch(spark, [folder for folder in _left.pop(earlier) if folder in known])


def _stage(build):
    """A stage that notes what it stores on the way, for a later one to remove."""

    @wraps(build)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        number = next(k for k, (_, stage) in enumerate(STAGES) if stage is run_stage)
        _after(number, spark)
        before = set(scratch_folders(spark))
        out = build(spark, docs, sf_dir)
        made = [folder for folder in scratch_folders(spark) if folder not in before]
        _left.setdefault(number, []).extend(made)
        return out

    return run_stage


@_stage
def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; cutoffs are certified on the labelled documents."""
    return quality_rules.accepted(docs, table(spark, sf_dir, "labels"))


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.one_of_each(docs)


@_stage
def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 13 words or more that an earlier document has."""
    return lz_dedup.without_repeats(docs)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return mixing.mixed_documents(docs)


@_stage
def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns, with the number of tokens and the packed token ids of each text."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", reject_low_quality),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("source_mix", mix_sources),
    ("byte_bpe", tokenize),
]

#: The mix's order of repeated rows, and tokens, cannot be had from SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to all documents; each result but the last is stored and read again.

    A stage's result has to be written before the next stage is called, as here.
    """
    docs = table(spark, sf_dir, "documents")
    *earlier, (_, last) = STAGES
    for name, stage in earlier:
        docs = written(stage(spark, docs, sf_dir), f"corpus-{name}")
    return last(spark, docs, sf_dir)
