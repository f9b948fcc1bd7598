"""Column contracts of the stored tables.

Time columns of the raw tables are ISO text without a zone; the operators turn them into
``timestamp_ntz`` so that no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
}


def _table(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


KEYS = ["contact_id", "session_id"]

CHATBOT = _table(
    contact_id="string",
    session_id="string",
    topic_name="string",
    confidence_score="double",
    response_type="string",
    thumbs_up="int",
    thumbs_down="int",
    escalated_to_agent="int",
    business_unit="string",
    application_channel="string",
    handle_seconds_dur="int",
    derived_resolution_score="double",
    created_at="string",
)

CLICKSTREAM = _table(
    contact_id="string",
    session_id="string",
    event_type="string",
    page_name="string",
    application_channel="string",
    business_unit="string",
    time_on_page_seconds="int",
    scroll_depth_pct="double",
    is_bounce="int",
    event_timestamp="string",
)

METADATA = _table(
    contact_id="string",
    session_id="string",
    topic_name="string",
    business_unit="string",
    application_channel="string",
    language="string",
    num_turns="int",
    contained="int",
    escalated_to_agent="int",
    csat_score="double",
    queue_name="string",
    session_duration_seconds="int",
    confidence_score="double",
    derived_resolution_score="double",
    session_start="string",
)

MODEL_CALLS = _table(
    model="string",
    prompt_tokens="int",
    completion_tokens="int",
    task="string",
    elapsed_seconds="double",
)

LOG_LINE = _table(
    timestamp="string",
    level="string",
    logger="string",
    message="string",
    service="string",
    step="string",
    block="string",
    elapsed_seconds="double",
    error="string",
)

SOURCES = {
    "chatbot_interactions": CHATBOT,
    "clickstream_events": CLICKSTREAM,
    "conversation_metadata": METADATA,
}

# Which raw text column carries the event time of each source.
TIME_COLUMN = {
    "chatbot_interactions": "created_at",
    "clickstream_events": "event_timestamp",
    "conversation_metadata": "session_start",
}

# The allowed categories.
BUSINESS_UNITS = ["Retail", "Financial Services", "Healthcare", "Technology", "Travel"]
CHANNELS = ["Web", "Mobile App", "Kiosk", "IVR", "Partner API"]
TOPICS = [
    "Account Management",
    "Billing Inquiry",
    "Product Support",
    "Order Status",
    "Returns & Refunds",
    "Technical Troubleshooting",
    "Subscription Management",
    "Password Reset",
    "Loyalty Program",
    "General Inquiry",
]
