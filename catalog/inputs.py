"""Interaction tables derived from the given ``events`` and ``conversations`` tables.

The statements are plain SQL that Spark and DuckDB both accept, so a registered query and its SQL
counterpart start from the same rows. They hold nulls, duplicates, padding, out-of-range values and
unreadable dates on purpose. Every event is a chatbot turn; some turns have no click event and some
sessions no metadata, so that the joins meet rows without a partner. Nothing happens on 17 January.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parley.sources.schemas import BUSINESS_UNITS, CHANNELS, TOPICS

# Those the given tables are described with, see FIXTURES.md.
RESPONSE_TYPES = ["FAQ", "Guided Flow", "Free Text", "Escalation", "Handoff", "Self-Service"]
PAGES = [
    "/home", "/account", "/billing", "/support", "/products",
    "/checkout", "/orders", "/faq", "/contact", "/settings",
]
LANGUAGES = ["en", "es", "fr", "de", "ja", "pt", "zh"]
QUEUES = ["Tier1-Support", "Billing-Ops", "Tech-Escalation", "General-Service"]


def _pick(values: list[str], index: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {cases} END"


_ESCALATED = "CASE WHEN event_type = 'error' AND k % 2 = 0 THEN 1 ELSE 0 END"

BASE = """
SELECT event_id, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-17' THEN ts - INTERVAL 1 DAY ELSE ts END AS ts,
       user_id, event_type, value,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
       concat('CONT-', CAST(user_id AS VARCHAR(20))) AS contact_id,
       concat('SESS-', CAST(user_id AS VARCHAR(20)), '-',
              CAST(CAST(ts AS DATE) AS VARCHAR(20))) AS session_id
FROM {events}
"""

_TURN_COLUMNS = f"""
  CASE WHEN event_id % 97 = 3 THEN NULL ELSE contact_id END AS contact_id,
  session_id,
  {_pick(TOPICS, 'k % 10')} AS topic_name,
  CASE WHEN k % 37 = 5 THEN NULL WHEN k % 10 = 8 THEN NULL WHEN k = 99 THEN CAST(1.5 AS DOUBLE)
       ELSE CAST(k AS DOUBLE) / 100 END AS confidence_score,
  {_pick(RESPONSE_TYPES, 'event_id % 6')} AS response_type,
  CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS thumbs_up,
  CASE WHEN event_id % 11 <> 0 AND event_id % 13 = 0 THEN 1 ELSE 0 END AS thumbs_down,
  {_ESCALATED} AS escalated_to_agent,
  CASE WHEN event_id % 50 = 1 THEN concat('  ', {_pick(BUSINESS_UNITS, 'user_id % 5')}, ' ')
       ELSE {_pick(BUSINESS_UNITS, 'user_id % 5')} END AS business_unit,
  CASE WHEN event_id % 61 = 7 THEN 'Fax'
       ELSE {_pick(CHANNELS, '(k + user_id) % 5')} END AS application_channel,
  CASE WHEN event_id % 211 = 9 THEN -1 ELSE CAST(floor(value) AS INT) END AS handle_seconds_dur,
  CASE WHEN event_id % 331 = 17 THEN CAST(0.14999 AS DOUBLE)
       WHEN event_id % 331 = 18 THEN CAST(0.15001 AS DOUBLE)
       ELSE CAST((k * 7 + event_id) % 101 AS DOUBLE) / 100 END AS derived_resolution_score,
  CASE WHEN event_id % 173 = 4 THEN 'not-a-date'
       ELSE replace(CAST(date_trunc('second', ts) AS VARCHAR(30)), ' ', 'T') END AS created_at
"""

CHATBOT = f"""
SELECT {_TURN_COLUMNS} FROM base
UNION ALL
SELECT {_TURN_COLUMNS} FROM base WHERE event_id % 200 = 11
"""

CLICKSTREAM = f"""
SELECT
  contact_id,
  session_id,
  CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'button_click'
       WHEN 'signup' THEN 'form_submit' WHEN 'purchase' THEN 'chat_close'
       ELSE 'chat_open' END AS event_type,
  {_pick(PAGES, 'k % 10')} AS page_name,
  {_pick(CHANNELS, '(k + user_id) % 5')} AS application_channel,
  {_pick(BUSINESS_UNITS, 'user_id % 5')} AS business_unit,
  CAST(floor(value) AS INT) AS time_on_page_seconds,
  CAST((event_id * 13) % 1001 AS DOUBLE) / 10 AS scroll_depth_pct,
  CASE WHEN floor(value) < 5 AND event_type = 'view' THEN 1 ELSE 0 END AS is_bounce,
  replace(CAST(date_trunc('second', ts) AS VARCHAR(30)), ' ', 'T') AS event_timestamp
FROM base WHERE event_id % 2 = 0
"""

METADATA = f"""
SELECT
  contact_id,
  session_id,
  {_pick(TOPICS, 'max(k) % 10')} AS topic_name,
  {_pick(BUSINESS_UNITS, 'max(user_id) % 5')} AS business_unit,
  {_pick(CHANNELS, 'max(k + user_id) % 5')} AS application_channel,
  {_pick(LANGUAGES, 'max(user_id) % 7')} AS language,
  CAST(count(*) AS INT) AS num_turns,
  1 - max({_ESCALATED}) AS contained,
  max({_ESCALATED}) AS escalated_to_agent,
  CASE WHEN max(k) % 2 = 0 THEN CAST(10 + max(k) % 41 AS DOUBLE) / 10 END AS csat_score,
  CASE WHEN max({_ESCALATED}) = 1 THEN {_pick(QUEUES, 'max(user_id) % 4')} END AS queue_name,
  CAST(sum(CAST(floor(value) AS INT)) AS INT) AS session_duration_seconds,
  CAST(min(k) AS DOUBLE) / 100 AS confidence_score,
  CAST(max(k) AS DOUBLE) / 100 AS derived_resolution_score,
  replace(CAST(date_trunc('second', min(ts)) AS VARCHAR(30)), ' ', 'T') AS session_start
FROM base WHERE user_id % 4 <> 3 GROUP BY contact_id, session_id
"""

# A metadata table in which some users' sessions were reported twice, the later report with other
# values, or with a time that cannot be read: input for the key-duplicate rules.
REPEATED_METADATA = """
SELECT * FROM conversation_metadata
UNION ALL
SELECT contact_id, session_id, topic_name, business_unit, application_channel, language,
       num_turns + 1, contained, escalated_to_agent, csat_score, queue_name,
       session_duration_seconds + 60, confidence_score, derived_resolution_score,
       concat(substr(session_start, 1, 10), 'T23:59:59')
FROM conversation_metadata WHERE language IN ('en', 'fr')
UNION ALL
SELECT contact_id, session_id, topic_name, business_unit, application_channel, language,
       num_turns + 2, contained, escalated_to_agent, csat_score, queue_name,
       session_duration_seconds, confidence_score, derived_resolution_score, 'not-a-date'
FROM conversation_metadata WHERE language IN ('en', 'de')
"""

# Model names as they occur in call records; the last one has no price.
MODELS = ["gpt-4o", "GPT-4o-mini", "gpt-4-turbo", "gpt-3.5-turbo", "house-model"]

MODEL_CALLS = f"""
SELECT conv_id * 1000 + turn AS call_id,
       concat('RUN-', CAST(conv_id % 7 AS VARCHAR(20))) AS session_id,
       {_pick(MODELS, 'conv_id % 5')} AS model,
       CAST(floor(length(text) / 4) AS INT) AS prompt_tokens,
       CAST(floor(length(text) / 12) AS INT) AS completion_tokens,
       CASE turn % 3 WHEN 0 THEN 'summarization' WHEN 1 THEN 'sentiment'
            ELSE 'topic_classification' END AS task,
       CAST(length(text) % 97 AS DOUBLE) / 10 AS elapsed_seconds
FROM {{conversations}}
"""

# One reply per task and event; by event number: well-formed, fenced, cut off, without some fields,
# not an object, empty and missing.
REPLIES = """
SELECT event_id,
  CASE event_id % 7
    WHEN 0 THEN concat('{"summary": "case ', CAST(event_id AS VARCHAR(20)),
                       '", "core_issue": "issue é", "outcome": "RESOLVED", "key_entities": ["a"]}')
    WHEN 1 THEN '```json {"summary": "fenced"} ```'
    WHEN 2 THEN concat('{"summary": "cut off ', CAST(event_id AS VARCHAR(20)))
    WHEN 3 THEN '{"outcome": "ESCALATED"}'
    WHEN 4 THEN '"just text"'
    WHEN 5 THEN ''
  END AS summary_reply,
  CASE event_id % 7
    WHEN 0 THEN concat('{"overall_sentiment": "NEGATIVE", "sentiment_score": -0.', CAST(k AS VARCHAR(20)),
                       ', "frustration_signal": true, "urgency_signal": false, "churn_risk": "HIGH"}')
    WHEN 1 THEN 'not json'
    WHEN 2 THEN '{"overall_sentiment": "NEUTRAL", "sentiment_score": 0}'
    WHEN 3 THEN CASE WHEN event_id % 2 = 0 THEN '{"churn_risk": "LOW", "frustration_signal": false}'
                     ELSE '{"frustration_signal": "true", "sentiment_score": "-0.25"}' END
    WHEN 4 THEN '{"overall_sentiment": "MIXED"} trailing'
    WHEN 5 THEN ''
  END AS sentiment_reply,
  CASE event_id % 7
    WHEN 0 THEN '{"topic": "Billing Inquiry", "confidence": 0.91, "reasoning": "bill"}'
    WHEN 1 THEN '{"topic": "Space Travel", "confidence": 0.2}'
    WHEN 2 THEN '[1, 2]'
    WHEN 3 THEN CASE event_id % 3 WHEN 0 THEN '{"topic": "Returns & Refunds"}'
                     WHEN 1 THEN '{"topic": "Returns & Refunds", "confidence": "0.75"}'
                     ELSE '{"topic": "Order Status", "confidence": "none"}' END
    WHEN 4 THEN '{"topic": '
    WHEN 5 THEN ''
  END AS topic_reply
FROM base
"""

LOG_RECORDS = """
SELECT event_id,
  replace(CAST(date_trunc('second', ts) AS VARCHAR(30)), 'T', ' ') AS "timestamp",
  CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
  concat('job.', event_type) AS logger,
  CASE
    WHEN event_id % 9 = 8 THEN
      concat('mail user', CAST(user_id AS VARCHAR(20)), '@example.com about 123-45-',
             CAST(1000 + k AS VARCHAR(20)))
    WHEN event_id % 9 = 7 THEN
      concat('used sk-abcdefghijklmnopqrst', CAST(user_id AS VARCHAR(20)), ' and AKIAABCDEFGHIJKLMN',
             CAST(10 + k % 90 AS VARCHAR(20)))
    WHEN event_id % 3 = 2 THEN
      CASE WHEN event_type = 'error' THEN 'Block failed' ELSE 'Block completed' END
    WHEN event_id % 3 = 1 THEN 'Step started'
    ELSE CASE WHEN event_type = 'error' THEN 'Step failed' ELSE 'Step completed' END
  END AS message,
  'contact-analytics' AS service,
  CASE WHEN event_id % 3 < 2 AND event_id % 9 < 7 THEN concat('step_', event_type) END AS step,
  CASE WHEN event_id % 3 = 2 AND event_id % 9 < 7 THEN concat('block_', event_type) END AS block,
  CASE WHEN event_id % 3 <> 1 AND event_id % 9 < 7
       THEN CAST(floor(value * 100) AS DOUBLE) / 1000 END AS elapsed_seconds,
  CASE WHEN event_type = 'error' AND event_id % 3 <> 1 AND event_id % 9 < 7
       THEN 'ValueError: bad row' END AS error
FROM base
"""

# Table name -> (statement, earlier statements it reads).
_TABLES = {
    "base": (BASE, []),
    "chatbot_interactions": (CHATBOT, ["base"]),
    "clickstream_events": (CLICKSTREAM, ["base"]),
    "conversation_metadata": (METADATA, ["base"]),
    "repeated_metadata": (REPEATED_METADATA, ["base", "conversation_metadata"]),
    "model_calls": (MODEL_CALLS, []),
    "replies": (REPLIES, ["base"]),
    "log_records": (LOG_RECORDS, ["base"]),
}
_GIVEN = ("events", "conversations")


def _given(text: str, names: dict[str, str]) -> str:
    for name, value in names.items():
        text = text.replace("{" + name + "}", value)
    return text


def with_clause(*tables: str) -> str:
    """``WITH`` clause that defines the derived tables for DuckDB."""
    order: list[str] = []
    for table in tables:
        for name in _TABLES[table][1] + [table]:
            if name not in order:
                order.append(name)
    given = {name: name for name in _GIVEN}
    parts = [f"{name} AS ({_given(_TABLES[name][0], given)})" for name in order]
    return "WITH " + ",\n".join(parts)


def given_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table as a lazy DataFrame over the given Parquet files."""
    given = {n: f"parquet.`{sf_dir}/{n}.parquet`" for n in _GIVEN}
    chain = _TABLES[name][1] + [name]
    parts = [f"{n} AS ({_given(_TABLES[n][0], given)})" for n in chain]
    text = "WITH " + ",\n".join(parts) + f"\nSELECT * FROM {name}"
    return spark.sql(text.replace('"timestamp"', "`timestamp`"))


def interactions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    turns, clicks, meta = (
        derived_table(spark, sf_dir, name)
        for name in ("chatbot_interactions", "clickstream_events", "conversation_metadata")
    )
    return turns, clicks, meta
