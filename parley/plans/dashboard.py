"""All dashboard figures of one selection."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators import kpis, series, topics
from parley.operators.filters import Selection, filter_options, select_rows
from parley.sources.readers import load_timed

# What the reports read; the rest of a turn or session is not worth keeping.
_TURN_COLUMNS = [
    "session_id", "topic_name", "business_unit", "application_channel", "confidence_score",
    "derived_resolution_score", "escalated_to_agent", "thumbs_up", "thumbs_down",
    "handle_seconds_dur", "event_time",
]
_SESSION_COLUMNS = [
    "contained", "escalated_to_agent", "num_turns", "session_duration_seconds", "csat_score",
]


def reports(
    turns: DataFrame, meta: DataFrame, ts: Column, max_gap_days: int | None = None
) -> dict[str, DataFrame]:
    """Every report over rows that are already selected; ``max_gap_days`` goes to the daily series."""
    return {
        "headline": kpis.headline_kpis(turns, meta),
        "daily_volume": series.daily_volume(turns, ts, max_gap_days),
        "daily_escalation": series.daily_escalation(turns, ts, max_gap_days),
        "escalation_by_topic": topics.escalation_by_topic(turns),
        "thumbs_split": kpis.thumbs_split(turns),
        "resolution_histogram": series.resolution_histogram(turns),
        "volume_by_channel": series.volume_by_channel(turns),
        "volume_by_unit": series.volume_by_unit(turns),
        "topic_table": topics.topic_table(turns),
    }


def dashboard_job(
    spark: SparkSession,
    base: str,
    out: str,
    selection: Selection,
    keep: bool = True,
    max_gap_days: int | None = None,
) -> list[str]:
    """Write each report under ``out`` and return their names.

    The text files are parsed once: the selected rows, cut to the columns in use, are kept in
    memory or on executor disk until all reports are written. ``keep=False`` reads them per report
    instead, for selections too large to hold.
    """
    ts = F.col("event_time")
    all_turns, all_meta = load_timed(spark, base)
    turns = select_rows(all_turns, selection, ts).select(*_TURN_COLUMNS)
    meta = select_rows(all_meta, selection, ts).select(*_SESSION_COLUMNS)
    if keep:
        turns.persist(StorageLevel.MEMORY_AND_DISK)
        meta.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tables = {**reports(turns, meta, ts, max_gap_days), "filter_options": filter_options(all_turns, ts)}
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{out}/{name}")
    finally:
        if keep:
            turns.unpersist()
            meta.unpersist()
    return list(tables)
