"""Cleaning projections of the three raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions.casts import cast_columns
from parley.sources.schemas import CHATBOT, CLICKSTREAM, KEYS, METADATA

# Metadata columns that would collide with chatbot columns after the join.
METADATA_RENAMES = {
    "confidence_score": "meta_confidence_score",
    "derived_resolution_score": "meta_resolution_score",
    "escalated_to_agent": "meta_escalated",
    "business_unit": "meta_business_unit",
    "application_channel": "meta_channel",
    "topic_name": "meta_topic_name",
}


def clean_chatbot(df: DataFrame) -> DataFrame:
    """Declared types, space-trimmed unit and channel, rows with a null key dropped."""
    return (
        cast_columns(df, CHATBOT)
        .withColumns(
            {c: F.trim(F.col(c)) for c in ("business_unit", "application_channel")}
        )
        .dropna(subset=KEYS)
    )


def clean_clickstream(df: DataFrame) -> DataFrame:
    return cast_columns(df, CLICKSTREAM).dropna(subset=KEYS)


def clean_metadata(df: DataFrame) -> DataFrame:
    """Declared types, ``meta_*`` names, rows with a null key dropped; text is left untrimmed."""
    return (
        cast_columns(df, METADATA).withColumnsRenamed(METADATA_RENAMES).dropna(subset=KEYS)
    )


def rated_turns(df: DataFrame) -> DataFrame:
    """Turns with explicit feedback, the denominator of the feedback rates."""
    return df.filter((F.col("thumbs_up") == 1) | (F.col("thumbs_down") == 1))
