from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parley.sources.schemas import CHATBOT, CLICKSTREAM, METADATA

TURN = dict(
    contact_id="c1", session_id="s1", topic_name="Billing Inquiry", confidence_score=0.8,
    response_type="FAQ", thumbs_up=0, thumbs_down=0, escalated_to_agent=0, business_unit="Retail",
    application_channel="Web", handle_seconds_dur=30, derived_resolution_score=0.5,
    created_at="2024-01-10T10:00:00",
)
CLICK = dict(
    contact_id="c1", session_id="s1", event_type="page_view", page_name="/home",
    application_channel="Web", business_unit="Retail", time_on_page_seconds=10,
    scroll_depth_pct=50.0, is_bounce=0, event_timestamp="2024-01-10T10:00:00",
)
SESSION = dict(
    contact_id="c1", session_id="s1", topic_name="Billing Inquiry", business_unit="Retail",
    application_channel="Web", language="en", num_turns=3, contained=1, escalated_to_agent=0,
    csat_score=4.0, queue_name=None, session_duration_seconds=60, confidence_score=0.7,
    derived_resolution_score=0.6, session_start="2024-01-10T09:59:00",
)


def _frame(spark: SparkSession, schema, base: dict, rows: list[dict]) -> DataFrame:
    data = [tuple({**base, **row}[name] for name in schema.names) for row in rows]
    return spark.createDataFrame(data, schema)


def turns(spark: SparkSession, *rows: dict) -> DataFrame:
    return _frame(spark, CHATBOT, TURN, list(rows))


def clicks(spark: SparkSession, *rows: dict) -> DataFrame:
    return _frame(spark, CLICKSTREAM, CLICK, list(rows))


def sessions(spark: SparkSession, *rows: dict) -> DataFrame:
    return _frame(spark, METADATA, SESSION, list(rows))


def texts(spark: SparkSession, *values) -> DataFrame:
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, text string")


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
