"""Replies of a text model kept from run to run, so that no question is asked twice.

A reply is kept under what was asked: the task, a digest of its template with all that is fixed in it
(version, wording, word limit, topics, most tokens, temperature), and a digest of the transcript. A changed template thus
asks anew. A run asks what the store lacks, adds the replies with their tokens to the store, and reads all
replies from there. Tokens stand in the store, once per call, and not on the rows that share a reply.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.operators.annotate import (
    REPLY_SCHEMA,
    TASKS,
    Templates,
    call_of,
    offline_scorer,
    prepared,
    transcript,
    with_replies,
)
from parley.operators.calls import Caller, Retry, ScorerFactory
from parley.operators.joins import spread_join
from parley.session import scratch_folder

_QUESTION = ["task", "template", "transcript"]
_ANSWER = T.StructType(
    [
        T.StructField("reply", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("prompt_tokens", T.LongType()),
        T.StructField("completion_tokens", T.LongType()),
    ]
)
STORE = T.StructType(
    [
        *[T.StructField(name, T.StringType()) for name in (*_QUESTION, "template_key", "run")],
        *_ANSWER.fields,
    ]
)


def template_digests(templates: Templates | None = None) -> dict[str, str]:
    """Per task a digest of all that its calls have in common."""
    return {
        task: hashlib.sha256(json.dumps(request, sort_keys=True).encode()).hexdigest()
        for task, request in prepared(templates).items()
    }


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Every stored reply; an absent store has none."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], STORE)
    return spark.read.schema(STORE).parquet(path)


def _ask(
    scorer_factory: ScorerFactory, templates: Templates | None, in_flight: int, retry: Retry | None
):
    requests, retry = prepared(templates), retry or Retry()

    def ask(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        caller = Caller(scorer_factory(), in_flight, retry)
        calls = ([call_of(requests[t], text) for t, text in zip(*batch)] for batch in batches)
        for answers in caller.batches(calls):
            columns = zip(*answers) if answers else [[] for _ in _ANSWER.names]
            yield pd.DataFrame(dict(zip(_ANSWER.names, map(list, columns))), dtype=object)

    ask.__annotations__ = {
        "batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.DataFrame],
    }
    return F.pandas_udf(ask, _ANSWER).asNondeterministic()


def annotate_from_store(
    df: DataFrame,
    store: str,
    run: str,
    scorer_factory: ScorerFactory | None = None,
    concurrency: int = 10,
    templates: Templates | None = None,
    retry: Retry | None = None,
) -> DataFrame:
    """``annotate.annotate`` with replies from the store at ``store``; what it lacks is asked first, by a job.

    Each question is asked once per distinct transcript. Only replies are kept: a call that failed leaves its error on the
    rows of this run, and is made again by the next. ``llm_usage`` is empty, as tokens belong to calls,
    see ``usage_of_runs``. ``df`` is read twice and should be a stored table. A run that stops while it
    asks keeps nothing; two runs at a time may both ask a question, and either's reply counts.
    """
    spark = df.sparkSession
    told = df.withColumn("__transcript", transcript(df))
    told = told.withColumn("__digest", F.sha2("__transcript", 256))
    digests, keys = template_digests(templates), {t: r[0] for t, r in prepared(templates).items()}
    tasks = F.array(
        *[
            F.struct(
                F.lit(task).alias("task"), F.lit(digests[task]).alias("template"), F.lit(keys[task]).alias("template_key")
            )
            for task in TASKS
        ]
    )
    texts = told.select(F.col("__digest").alias("transcript"), F.col("__transcript").alias("text")).distinct()
    questions = texts.select("transcript", "text", F.inline(tasks))
    wanted = F.col("template").isin(list(digests.values()))
    kept = read_store(spark, store).where(wanted & F.col("reply").isNotNull())
    open_ = spread_join(questions, kept.select(*_QUESTION).distinct(), _QUESTION, "left_anti")
    ask = _ask(scorer_factory or offline_scorer(), templates, concurrency, retry)
    answered = open_.withColumn("answer", ask("task", "text"))
    folder = scratch_folder(spark, "replies")
    new = answered.select(*_QUESTION, "template_key", F.lit(run).alias("run"), "answer.*").select(*STORE.names)
    new.write.parquet(folder)
    new = spark.read.schema(STORE).parquet(folder)
    new.where("reply IS NOT NULL").write.mode("append").parquet(store)

    answers = read_store(spark, store).where(wanted).unionByName(new.where("reply IS NULL"))
    # of several answers any reply before an error, and then the first in order, so that all rows agree
    first = F.min_by(F.struct("reply", "error"), F.struct(F.col("reply").isNull(), "reply", "error"))
    per_task = answers.groupBy("transcript", "task").agg(first.alias("a")).select("transcript", "task", "a.*")
    given = {
        f"{task}{part}": F.max(F.when(F.col("task") == task, F.col(name)))
        for task in TASKS
        for part, name in (("", "reply"), ("_error", "error"))
    }
    cells = per_task.groupBy(F.col("transcript").alias("__digest")).agg(
        *[c.alias(name) for name, c in given.items()]
    )
    reply = F.struct(
        *[
            F.col(f.name) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name)
            for f in REPLY_SCHEMA
        ]
    )
    replies = cells.select("__digest", reply.alias("__reply"))
    return with_replies(spread_join(told, replies, ["__digest"], "left")).drop("__digest")


def usage_of_runs(store: DataFrame, model: str, *keep: str) -> DataFrame:
    """One row per call that a store holds and whose tokens are known, as the cost operators take them."""
    known = store.where("prompt_tokens IS NOT NULL")
    named = F.when(F.col("prompt_tokens").isNotNull(), model).alias("model")
    return known.select(*keep, "run", "task", named, "prompt_tokens", "completion_tokens")
