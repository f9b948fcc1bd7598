"""Scores, tiers and flags derived from interaction columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions.rounding import display


def _or(name: str, default) -> Column:
    return F.coalesce(F.col(name), F.lit(default))


def tier(score: Column, high: float, medium: float) -> Column:
    """HIGH / MEDIUM / LOW; a null score is LOW."""
    return F.when(score >= high, "HIGH").when(score >= medium, "MEDIUM").otherwise("LOW")


def resolution_tier(score: Column) -> Column:
    """Tier of one turn."""
    return tier(score, 0.7, 0.4)


def topic_quality(mean_score: Column) -> Column:
    """Tier of a topic's mean score; its upper edge is lower than that of a single turn."""
    return tier(mean_score, 0.65, 0.40)


def effective_confidence() -> Column:
    return F.coalesce("confidence_score", "meta_confidence_score")


def is_self_served() -> Column:
    """1 when neither source reports an escalation and the session was contained."""
    untouched = (_or("escalated_to_agent", 0) == 0) & (_or("meta_escalated", 0) == 0)
    return (untouched & (_or("contained", 1) == 1)).cast("int")


def session_quality_score() -> Column:
    """Weighted mix of confidence, resolution, non-escalation and thumbs up; null counts as 0."""
    return F.round(
        F.coalesce(effective_confidence(), F.lit(0.0)) * 0.35
        + _or("derived_resolution_score", 0.0) * 0.35
        + (1.0 - _or("escalated_to_agent", 0).cast("double")) * 0.15
        + _or("thumbs_up", 0).cast("double") * 0.15,
        4,
    )


def turn_resolution_score() -> Column:
    """Resolution score of a turn from confidence, feedback and escalation, held in [0, 1]."""
    raw = (
        F.col("confidence_score") * 0.5
        + F.col("thumbs_up") * 0.3
        - F.col("thumbs_down") * 0.2
        - F.col("escalated_to_agent") * 0.15
    )
    # greatest/least skip nulls, so an unknown score has to be kept null by hand
    return F.when(
        raw.isNotNull(), display(F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)), 4)
    )


def session_resolution_score() -> Column:
    """Resolution score of a session; an unanswered survey is stood in for by confidence."""
    satisfaction = F.coalesce(F.col("csat_score") / 5.0, F.col("confidence_score"))
    return display(
        F.col("confidence_score") * 0.4 + F.col("contained") * 0.3 + satisfaction * 0.3, 4
    )


def bounce_flag() -> Column:
    """1 for a page view left within five seconds."""
    return (
        (F.col("time_on_page_seconds") < 5) & (F.col("event_type") == "page_view")
    ).cast("int")


def date_parts(ts: Column) -> dict[str, Column]:
    """Partition values as zero-padded text."""
    return {
        "year": F.year(ts).cast("string"),
        "month": F.lpad(F.month(ts).cast("string"), 2, "0"),
        "day": F.lpad(F.dayofmonth(ts).cast("string"), 2, "0"),
    }
