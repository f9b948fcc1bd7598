"""Unify by increments: batches of raw rows added to the stored table, as if all had come at once.

A late turn takes the facts of its session from what earlier batches said about it. Late metadata and
clicks reach the turns that are stored already: the days that hold turns of these sessions are read,
these rows are derived anew, and the days are published together with the facts. Days without such a
row are neither read nor written.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.casts import as_timestamp
from parley.functions.scores import date_parts
from parley.operators import session_state as state
from parley.operators.clean import clean_chatbot, clean_clickstream, clean_metadata
from parley.operators.joins import spread_join
from parley.operators.unify import DERIVED, enrich, unify
from parley.session import clear_scratch, scratch_folder
from parley.sources import published
from parley.sources.published import PARTITION_COLUMNS, Pointer
from parley.sources.schemas import CLICKSTREAM, KEYS, METADATA
from parley.sources.writers import TURN_KEYS

_TABLES = ("sessions", "values", "days")


def _known(df: DataFrame, schema) -> DataFrame:
    """The columns of the table's contract, those that ``df`` lacks as nulls."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}
    return df.withColumns(missing).select(*schema.names)


def _state_of(turns: DataFrame, clicks: DataFrame, meta: DataFrame) -> dict[str, DataFrame]:
    """The three tables of a batch, from cleaned rows."""
    dated = turns.withColumns(date_parts(as_timestamp(F.col("created_at"))))
    return {
        "sessions": state.session_sums(clicks, meta),
        "values": state.session_values(clicks),
        "days": state.session_days(dated),
    }


def _stored(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def store_whole(
    spark: SparkSession,
    path: str,
    turns: DataFrame,
    clicks: DataFrame,
    meta: DataFrame,
    rows: DataFrame,
    batch: str | None = None,
) -> Pointer:
    """Make ``rows``, unified from the three raw tables, the whole table at ``path``, with the facts that
    merges need beside them. Published at once."""
    base, version = published.current(spark, path), published.new_version()
    cleaned = clean_chatbot(turns), clean_clickstream(clicks), clean_metadata(_known(meta, METADATA))
    for what, df in _state_of(*cleaned).items():
        published.write_extra(df, path, version, what)
    days = published.write_days(rows, path, version)
    names = [] if batch is None else [batch]
    return published.publish(spark, path, base, Pointer(0, rows.schema.json(), days, [version], names))


def merge_batch(
    spark: SparkSession,
    path: str,
    turns: DataFrame,
    clicks: DataFrame,
    meta: DataFrame,
    run_ts: str,
    batch: str | None = None,
    repeated: str = "replace",
) -> Pointer:
    """Add a batch of the three raw tables to the unified table at ``path``; it is published at once.

    The table then equals one unified from the rows of all batches, whatever the order they came in, up
    to the last digits of averages and ``pipeline_run_at``, which tells when a row was last derived. Any
    of the three may be empty. A table that is not there yet begins with this batch.

    ``batch`` names it: a name that has been merged is not merged again, so that a job can be repeated.
    A batch without a name that comes again counts its clicks again. ``repeated="replace"`` lets a turn
    sent again, known by ``TURN_KEYS`` (null equal to null), take the place of the stored one; ``"keep"``
    keeps both, as one pass over all rows would. Repeated turns within a batch all stay.

    Of metadata and clicks only the columns of the table contracts count.
    """
    if repeated not in ("replace", "keep"):
        raise ValueError(f"repeated must be 'replace' or 'keep', not {repeated!r}")
    base = published.current(spark, path)
    if base is None:
        if published.has_plain_days(spark, path):
            raise ValueError(f"{path} is a plain folder; unify it in full first")
        return store_whole(spark, path, turns, clicks, meta, unify(turns, clicks, meta, run_ts), batch)
    if not base.extra:
        raise ValueError(f"{path} was stored without its sessions' facts; unify it in full first")
    if batch is not None and batch in base.batches:
        return base
    scratch, version = scratch_folder(spark, "increment"), published.new_version()

    fresh = _stored(clean_chatbot(turns), f"{scratch}/turns")
    some_clicks = clean_clickstream(_known(clicks, CLICKSTREAM))
    some_meta = clean_metadata(_known(meta, METADATA))
    schemas = {}
    for what, df in _state_of(fresh, some_clicks, some_meta).items():
        schemas[what] = df.schema
        published.write_extra(df, path, version, what)

    def extra(what: str, *versions: str) -> DataFrame:
        return published.read_extra(spark, path, Pointer(extra=list(versions)), what, schemas[what])

    # the days with a row that changes: those of new turns, and of stored turns of sessions with news
    news = extra("sessions", version)
    reached = state.of_sessions(extra("days", *base.extra), news).union(extra("days", version))
    touched = published.day_names(reached.select(*PARTITION_COLUMNS))
    old = published.read_days(spark, path, base, None, touched)
    if repeated == "replace":
        old = spread_join(old, fresh.select(*TURN_KEYS).distinct(), TURN_KEYS, "left_anti")
    # facts are needed of the sessions that a row is derived of, and of no others
    wanted = _stored(news.select(*KEYS).union(fresh.select(*KEYS)).distinct(), f"{scratch}/wanted")
    sums, values = (
        state.of_sessions(extra(what, *base.extra, version), wanted) for what in ("sessions", "values")
    )
    facts = state.facts(sums, values, some_meta.columns)
    late = news.select(*KEYS).withColumn("__news", F.lit(True))
    facts = _stored(spread_join(facts, late, KEYS, "left"), f"{scratch}/facts")
    rows = _derived_again(old, fresh, facts, run_ts)
    days = published.write_days(rows, path, version)
    done = replace(
        base,
        schema=rows.schema.json(),
        days={**base.days, **days},
        extra=[*base.extra, version],
        batches=[*base.batches, *([] if batch is None else [batch])],
    )
    done = published.publish(spark, path, base, done)
    clear_scratch(spark, [scratch])
    return done


def _derived_again(old: DataFrame, fresh: DataFrame, facts: DataFrame, run_ts: str) -> DataFrame:
    """Fresh rows, stored ones of sessions with news derived anew, and the other stored ones as they are.

    Stored rows meet the facts in the same join as fresh ones and are told apart afterwards, so these wide
    rows are shuffled once for it, not once for each kind.
    """
    known = [c for c in facts.columns if c not in (*KEYS, "__news")]
    kept = [c for c in [*known, *DERIVED, *PARTITION_COLUMNS] if c in old.columns]
    stored = old.withColumnsRenamed({c: f"__{c}" for c in kept}).withColumn("__news", F.lit(False))
    turns = stored.unionByName(fresh.withColumn("__news", F.lit(True)), allowMissingColumns=True)
    turns = turns.withColumnRenamed("__news", "__fresh")
    found = enrich(turns.join(facts, KEYS, "left").select(*[f"`{c}`" for c in turns.columns], *known, "__news"), run_ts)
    changed = F.col("__fresh") | F.coalesce("__news", F.lit(False))
    chosen = {c: F.when(changed, F.col(c)).otherwise(F.col(f"__{c}") if c in kept else None)
              for c in [*known, *DERIVED, *PARTITION_COLUMNS]}
    helping = {"__fresh", "__news", *[f"__{c}" for c in kept]}
    return found.select(*[chosen.get(c, F.col(f"`{c}`")).alias(c) for c in found.columns if c not in helping])


def compact(spark: SparkSession, path: str) -> Pointer:
    """Add the stored facts of all batches up to one row per session, and publish that.

    A merge reads the keys of all that earlier batches stored, so this pays after many batches.
    """
    base = published.current(spark, path)
    if base is None or len(base.extra) < 2:
        raise ValueError(f"{path} holds no two batches")
    version = published.new_version()
    last = f"{path.rstrip('/')}/{published.EXTRA}/{base.extra[-1]}"
    sums, values, days = (
        published.read_extra(spark, path, base, what, spark.read.parquet(f"{last}/{what}").schema)
        for what in _TABLES
    )
    published.write_extra(state.added_up(sums), path, version, "sessions")
    published.write_extra(values.distinct(), path, version, "values")
    published.write_extra(days.distinct(), path, version, "days")
    return published.publish(spark, path, base, replace(base, extra=[version]))
