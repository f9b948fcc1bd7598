"""Reports as JSON documents, and the insight prompt made from one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.casts import as_timestamp
from parley.functions.prompts import get_template
from parley.operators import kpis, topics
from parley.operators.filters import Selection, select_rows

# Fixed value: the answer when a selection holds nothing.
NO_DATA = "No data found for the specified filters."


def _error_document() -> Column:
    return F.to_json(F.struct(F.lit(NO_DATA).alias("error")))


def metrics_document(
    turns: DataFrame, meta: DataFrame, selection: Selection | None = None
) -> DataFrame:
    """The KPI report as one JSON object; figures without data are null."""
    report = kpis.kpi_report(turns, meta, selection)
    echo = F.struct(
        *[
            F.col(f"filter_{name}").alias(name)
            for name in (selection or Selection()).echo()
        ]
    )
    document = F.to_json(
        F.struct(*kpis.ALL_KPIS, echo.alias("filters_applied")), {"ignoreNullFields": "false"}
    )
    empty = F.col("status") == "NO_DATA"
    return report.select(F.when(empty, _error_document()).otherwise(document).alias("document"))


def topics_document(
    turns: DataFrame,
    meta: DataFrame,
    n: int = 5,
    sort_by: str = "volume",
    selection: Selection | None = None,
    include_quality: bool = True,
    include_trend: bool = False,
) -> DataFrame:
    """Leading topics as one JSON object: a summary and the list in ranking order.

    Every listed topic has all its fields, null where there is no figure; only the quality breakdown
    is absent where no session has the topic. At most ``n`` rows are gathered for the list. ``top_topic_by_volume`` is the first topic of the
    chosen ranking, and the record total covers the listed topics only.
    """
    chosen = selection or Selection()
    leading = topics.trending_topics(
        select_rows(turns, selection, as_timestamp(F.col("created_at"))),
        select_rows(meta, selection, as_timestamp(F.col("session_start"))),
        n,
        sort_by,
        include_quality,
        include_trend,
    )
    fields = [
        F.col("topic_name").alias("topic"),
        "volume",
        "escalation_rate_pct",
        "thumbs_up_rate_pct",
        "thumbs_down_rate_pct",
        "avg_confidence_score",
        "avg_resolution_score",
        "avg_handle_seconds",
    ]
    trend = [F.coalesce("wow_trend", F.lit("UNKNOWN")).alias("wow_trend")] if include_trend else []
    keep_nulls = {"ignoreNullFields": "false"}
    entry = F.to_json(F.struct(*fields, *trend), keep_nulls)
    if include_quality:
        quality = F.struct("resolution_quality", "avg_resolution", "session_count")
        known = quality.alias("resolution_quality_breakdown")
        with_quality = F.to_json(F.struct(*fields, known, *trend), keep_nulls)
        entry = F.when(F.col("resolution_quality").isNotNull(), with_quality).otherwise(entry)

    ranking = topics.SORT_COLUMNS.get(sort_by, "volume")
    last = F.lit(float("inf"))
    place = F.coalesce(-F.col(ranking).cast("double"), last)
    ranked = F.array_sort(
        F.collect_list(
            F.struct(place.alias("place"), "topic_name", entry.alias("entry"))
        )
    )
    gathered = leading.agg(
        F.transform(ranked, lambda item: item["entry"]).alias("topics"),
        F.get(ranked, F.lit(0))["topic_name"].alias("first"),
        F.sum("volume").alias("total"),
    )
    summary = F.struct(
        F.col("first").alias("top_topic_by_volume"),
        F.col("total").alias("total_records_in_result"),
        F.lit(sort_by).alias("sort_by"),
        F.struct(
            *[
                F.lit(chosen.echo()[name]).alias(name)
                for name in ("business_unit", "application_channel")
            ]
        ).alias("filters"),
    )
    document = F.concat(
        F.lit('{"summary":'), F.to_json(summary, keep_nulls),
        F.lit(',"topics":['), F.array_join("topics", ","), F.lit("]}"),
    )
    return gathered.select(
        F.when(F.size("topics") == 0, _error_document()).otherwise(document).alias("document")
    )


def insight_messages(
    turns: DataFrame, meta: DataFrame, time_period: str, selection: Selection | None = None
) -> DataFrame:
    """Chat messages that ask for insights into the KPI report."""
    report = metrics_document(turns, meta, selection)
    messages = get_template("insight").messages(
        time_period=time_period, metrics_json=F.col("document")
    )
    return report.select("document", messages.alias("messages"))
