"""Fields of model replies, read from their JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions.casts import as_double
from parley.sources.schemas import TOPICS

INVALID_REPLY = "reply is not a JSON object"


# The fields read from the reply to each task.
SUMMARY = "summary string, core_issue string, outcome string"
# Numbers and truth values are read as text first, because models also write them in quotes.
SENTIMENT = (
    "overall_sentiment string, sentiment_score string, frustration_signal string, "
    "churn_risk string"
)
TOPIC = "topic string, confidence string"


def as_object(reply: Column, fields: str) -> Column:
    """The reply as a struct, or null unless it is exactly one JSON object.

    Spark's parser stops after the first value. Read as the only element of an array, a reply with
    anything behind its object does not parse.
    """
    wrapped = F.concat(F.lit("["), reply, F.lit("]"))
    parsed = F.from_json(wrapped, f"array<struct<{fields}>>", {"allowSingleQuotes": "false"})
    return F.when(F.size(parsed) == 1, F.get(parsed, F.lit(0)))


def _blank(reply: Column) -> Column:
    return reply.isNull() | (F.trim(reply) == "")


def summary_fields(reply: Column, parsed: Column) -> dict[str, Column]:
    """Summary, issue and outcome; a reply that cannot be read leaves an error text."""
    unreadable = ~_blank(reply) & parsed.isNull()
    return {
        "llm_summary": parsed["summary"],
        "llm_core_issue": parsed["core_issue"],
        "llm_outcome": parsed["outcome"],
        "llm_processing_error": F.when(unreadable, INVALID_REPLY),
    }


def sentiment_fields(parsed: Column) -> dict[str, Column]:
    """Sentiment, score, frustration and churn risk; null when the reply cannot be read.

    Numbers and truth values may be quoted. What is neither, and a score that is no number, is null.
    """
    return {
        "llm_sentiment": parsed["overall_sentiment"],
        "llm_sentiment_score": as_double(parsed["sentiment_score"]),
        "llm_frustration": parsed["frustration_signal"].try_cast("boolean"),
        "llm_churn_risk": parsed["churn_risk"],
    }


def topic_fields(parsed: Column) -> dict[str, Column]:
    """Topic, confidence, and whether the topic is one of the offered ones."""
    return {
        "llm_topic": parsed["topic"],
        "llm_topic_confidence": as_double(parsed["confidence"]),
        "topic_in_list": parsed["topic"].isin(TOPICS),
    }
