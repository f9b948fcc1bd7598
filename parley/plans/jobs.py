"""Batch jobs over the raw tables."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.operators.annotate import CALL_ERRORS, Templates, annotate, not_yet_annotated
from parley.operators.calls import Retry, ScorerFactory
from parley.operators.joins import spread_join
from parley.operators.quality import all_sources_report, enforce
from parley.operators.reply_store import annotate_from_store
from parley.operators.unify import unify
from parley.plans.increments import merge_batch, store_whole
from parley.session import clear_scratch, scratch_folders
from parley.sources.published import current
from parley.sources.readers import load_sources, read_unified, sample_rows
from parley.sources.schemas import SOURCES
from parley.sources.writers import write_json_lines


def quality_job(spark: SparkSession, base: str, report_path: str) -> DataFrame:
    """Check the raw tables, write the report, and raise if a check failed.

    The gate reads the written report, so the checks run once.
    """
    before = set(scratch_folders(spark))
    all_sources_report(*load_sources(spark, base)).write.mode("overwrite").parquet(report_path)
    clear_scratch(spark, [f for f in scratch_folders(spark) if f not in before])
    report = spark.read.parquet(report_path)
    enforce(report)
    return report


def _observed(seen: Observation, df: DataFrame) -> int:
    """Rows of ``df`` as observed. The optimizer takes an observation out where no row of the branch can
    matter, for example since another table is empty; asking for its figures fails, and the rows are
    counted instead."""
    try:
        return seen.get["rows"]
    except Py4JJavaError:
        return df.count()


def unify_job(
    spark: SparkSession,
    base: str,
    out: str,
    run_ts: str,
    mode: str = "full",
    batch: str | None = None,
    multi_line: bool | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """Write the unified table; return it as read back, and the rows loaded and written.

    ``mode="full"`` makes the input the whole table. ``mode="merge"`` adds the input to the stored table
    as a batch, which may have a name, see ``increments.merge_batch``; one that has been merged is not
    loaded again. Either is published at once. Rows loaded are observed
    on the way (rows that a lost executor had counted may be counted again); rows written are those of
    the whole table, from its files' footers.
    """
    if mode not in ("full", "merge"):
        raise ValueError(f"mode must be 'full' or 'merge', not {mode!r}")
    stored = current(spark, out)
    if mode == "merge" and stored and batch is not None and batch in stored.batches:
        unified = read_unified(spark, out)
        return unified, {**dict.fromkeys(SOURCES, 0), "unified_interactions": unified.count()}
    counts = {name: Observation(name) for name in SOURCES}
    raw = load_sources(spark, base, multi_line)
    turns, clicks, meta = (
        df.observe(counts[name], F.count(F.lit(1)).alias("rows")) for name, df in zip(SOURCES, raw, strict=True)
    )
    if mode == "full":
        store_whole(spark, out, *raw, unify(turns, clicks, meta, run_ts), batch)
    else:
        merge_batch(spark, out, turns, clicks, meta, run_ts, batch)
    unified = read_unified(spark, out)
    rows = {
        name: _observed(seen, df) for (name, seen), df in zip(counts.items(), raw, strict=True)
    }
    return unified, {**rows, "unified_interactions": unified.count()}


def annotate_job(
    spark: SparkSession,
    unified_path: str,
    out: str,
    scorer_factory: ScorerFactory | None = None,
    limit: int = 0,
    done_paths: list[str] | None = None,
    keys: list[str] | None = None,
    concurrency: int = 10,
    share_replies: bool = False,
    templates: Templates | None = None,
    retry: Retry | None = None,
    store: str | None = None,
    run: str = "",
) -> None:
    """Annotate rows of the unified table and write them as JSON lines.

    ``done_paths`` are the outputs of earlier runs, whose rows are skipped by ``keys`` unless one of
    their calls failed; ``out`` has to be another folder. ``limit`` counts keys: rows that share one are annotated together, so that a
    later run misses none.
    ``concurrency`` sets how many calls each task keeps under way, ``retry`` when a call is made again. With ``store``,
    replies are kept there under the name of this ``run`` and questions it has answered are not asked.
    """
    keys = keys or ["contact_id", "session_id", "created_at"]
    rows = read_unified(spark, unified_path)
    if done_paths:
        if out in done_paths:
            raise ValueError(f"{out} holds finished rows and would be overwritten")
        # naming the fields spares a pass over the finished rows to infer all of theirs
        errors = [T.StructField(name, T.StringType()) for name in CALL_ERRORS]
        fields = T.StructType([*[rows.schema[key] for key in keys], *errors])
        rows = not_yet_annotated(rows, spark.read.schema(fields).json(done_paths), keys)
    if limit:
        chosen = sample_rows(rows.select(*keys).distinct(), limit, keys)
        rows = spread_join(rows, chosen, keys, "left_semi")
    if store:
        annotated = annotate_from_store(
            rows, store, run, scorer_factory, concurrency, templates, retry
        )
    else:
        annotated = annotate(rows, scorer_factory, concurrency, share_replies, templates, retry)
    write_json_lines(annotated, out)


def daily_job(
    spark: SparkSession,
    base: str,
    out: str,
    run_ts: str,
    scorer_factory: ScorerFactory | None = None,
    mode: str = "full",
    batch: str | None = None,
    **annotation,
) -> dict[str, int]:
    """Check, unify and annotate in this order; a failed check stops the rest.

    Returns the rows loaded and written. ``mode`` and ``batch`` go to ``unify_job``, ``annotation`` to
    ``annotate_job``.
    """
    quality_job(spark, base, f"{out}/quality")
    _, rows = unify_job(spark, base, f"{out}/unified", run_ts, mode, batch)
    annotate_job(spark, f"{out}/unified", f"{out}/annotated", scorer_factory, **annotation)
    return rows
