"""The quality gate over new rows: what was checked before is kept as state and added to.

State lies by source under one folder and is published day by day, see ``sources.published`` and
``operators.quality_state``. A batch is read once; of the state it reads the days that the batch has
rows of. The report over all days then reads one cell a day, and the keys.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from parley.operators import quality_state as state
from parley.operators.quality import CHATBOT_RULES, CLICKSTREAM_RULES, METADATA_RULES, RuleSet, enforce
from parley.session import clear_scratch, scratch_folder
from parley.sources import published
from parley.sources.published import PARTITION_COLUMNS, Pointer

SOURCE_RULES = [CHATBOT_RULES, CLICKSTREAM_RULES, METADATA_RULES]


def _folder(path: str, rules: RuleSet) -> str:
    return f"{path.rstrip('/')}/{rules.source}"


def add_rows(
    spark: SparkSession, path: str, df: DataFrame, rules: RuleSet, batch: str | None = None
) -> list[str]:
    """Add rows of a source to its state; the days they are of. A ``batch`` already added adds nothing."""
    folder = _folder(path, rules)
    base = published.current(spark, folder)
    if base and batch is not None and batch in base.batches:
        return []
    scratch = scratch_folder(spark, "gate")
    state.row_state(df, rules).write.parquet(f"{scratch}/new")
    new = spark.read.schema(state.SCHEMA).parquet(f"{scratch}/new")
    days = published.day_names(new.select(*PARTITION_COLUMNS))
    base_or_none = base or Pointer()
    rows = new
    if any(day in base_or_none.days for day in days):  # rows of a first batch are distinct as they are
        old = published.read_days(spark, folder, base_or_none, state.SCHEMA, days)
        rows = state.added_rows(new.unionByName(old.where("kind = 'row'")), rules)
        rows.write.parquet(f"{scratch}/rows")
        rows = spark.read.schema(state.SCHEMA).parquet(f"{scratch}/rows")
    version = published.new_version()
    written = published.write_days(
        rows.unionByName(state.day_state(rows, rules)), folder, version, ("kind",)
    )
    published.publish(spark, folder, base, replace(
        base_or_none,
        schema=state.SCHEMA.json(),
        days={**base_or_none.days, **written},
        batches=[*base_or_none.batches, *([] if batch is None else [batch])],
    ))
    clear_scratch(spark, [scratch])
    return days


def stored_state(
    spark: SparkSession, path: str, rules: RuleSet, days: list[str] | None = None
) -> DataFrame:
    """The state of a source, of all days or of some, given as folders such as year=2024/month=01/day=05."""
    folder = _folder(path, rules)
    return published.read_days(spark, folder, published.current(spark, folder) or Pointer(), state.SCHEMA, days)


def report(
    spark: SparkSession, path: str, rules: list[RuleSet] | None = None, days: list[str] | None = None
) -> DataFrame:
    """Every check of the sources over all days added, or over some."""
    each = rules or SOURCE_RULES
    return state.together([state.report(stored_state(spark, path, r, days), r) for r in each])


def check_batch(
    spark: SparkSession,
    path: str,
    turns: DataFrame,
    clicks: DataFrame,
    meta: DataFrame,
    batch: str | None = None,
    whole: bool = False,
) -> DataFrame:
    """Add a batch of the three sources and stop if a check failed; the report.

    Checked are the days that the batch has rows of, with all their rows, or the whole table. A batch
    that fails stays in the state, as its rows are there; rows that are mended need a state made anew. A source without
    rows in the batch is not checked unless ``whole``.
    """
    reports = []
    for df, rules in zip((turns, clicks, meta), SOURCE_RULES, strict=True):
        days = add_rows(spark, path, df, rules, batch)
        if whole or days:
            reports.append(state.report(stored_state(spark, path, rules, None if whole else days), rules))
    if not reports:
        return report(spark, path, days=[]).limit(0)
    checked = state.together(reports)
    enforce(checked)
    return checked
