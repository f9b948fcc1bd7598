"""Join the three sources into one enriched row per chatbot turn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions import scores
from parley.functions.casts import as_timestamp
from parley.functions.rounding import display
from parley.operators.clean import clean_chatbot, clean_clickstream, clean_metadata
from parley.operators.joins import spread_join
from parley.sources.schemas import KEYS


def click_sessions(clicks: DataFrame, approximate_distinct: bool = False) -> DataFrame:
    """One row per session with its click measures.

    Every measure combines map-side and the distinct counts are first spread over
    (session, value), so one session holding most of the events is not gathered in one task.
    """
    distinct = F.approx_count_distinct if approximate_distinct else F.count_distinct
    return clicks.groupBy(*KEYS).agg(
        F.count("*").alias("click_event_count"),
        F.sum("is_bounce").alias("bounce_events"),
        F.avg("scroll_depth_pct").alias("avg_scroll_depth_pct"),
        F.sum("time_on_page_seconds").alias("total_time_on_page_seconds"),
        distinct("page_name").alias("unique_pages_visited"),
        distinct("event_type").alias("unique_event_types"),
    )


def latest_metadata(meta: DataFrame, order_by: str = "session_start") -> DataFrame:
    """One metadata row per session: the latest, ties decided by the remaining columns.

    A row whose time cannot be read is older than any other. A maximum over the row as a struct is
    combined map-side, unlike a row_number window, which would sort all copies of a key in one task.
    """
    rest = [c for c in meta.columns if c not in KEYS and c != order_by]
    time = as_timestamp(F.col(order_by).cast("string")).alias("__time")
    packed = F.max(F.struct(time, order_by, *rest)).alias("row")
    kept = [c if c in KEYS else f"row.{c}" for c in meta.columns]
    return meta.groupBy(*KEYS).agg(packed).select(*kept)


def session_facts(
    meta: DataFrame, click_summary: DataFrame, unique_metadata: bool = True
) -> DataFrame:
    """Metadata and click measures side by side, for every session known to either.

    With one metadata row per session both inputs are already spread by session and a full join
    needs no further shuffle. Otherwise a repeated session is kept out of a full join, which cannot
    be split: metadata takes its click measures by a left join, and the sessions without metadata
    are appended.
    """
    if unique_metadata:
        return meta.join(click_summary, KEYS, "full")
    clicks_only = spread_join(click_summary, meta.select(*KEYS).distinct(), KEYS, "left_anti")
    return spread_join(meta, click_summary, KEYS, "left").unionByName(
        clicks_only, allowMissingColumns=True
    )


def join_sources(
    turns: DataFrame,
    click_summary: DataFrame,
    meta: DataFrame,
    dedupe_metadata: bool = True,
) -> DataFrame:
    """Left-join metadata and click measures onto every turn.

    The two session-level inputs are small next to the turns and already spread by session, so they
    are put together first. The turns then take part in a single join whose inputs are both plain
    shuffles, which is the form adaptive execution can split when one session holds a large share
    of the turns; two joins in a row on the same keys would not be split.

    ``dedupe_metadata=False`` lets a repeated metadata key multiply its turns.
    """
    kept = latest_metadata(meta) if dedupe_metadata else meta
    sessions = session_facts(kept, click_summary, dedupe_metadata)
    names = turns.columns + [c for c in sessions.columns if c not in KEYS]
    return turns.join(sessions, KEYS, "left").select(*names)


#: What ``enrich`` adds, besides the partition columns.
DERIVED = [
    "effective_confidence_score", "resolution_tier", "is_self_served", "session_quality_score",
    "created_at_ts", "pipeline_run_at",
]


def enrich(df: DataFrame, run_ts: str) -> DataFrame:
    """Derived scores, date partitions and the audit stamp ``run_ts``."""
    staged = df.withColumns(
        {
            "effective_confidence_score": scores.effective_confidence(),
            "resolution_tier": scores.resolution_tier(F.col("derived_resolution_score")),
            "is_self_served": scores.is_self_served(),
            "session_quality_score": scores.session_quality_score(),
            "created_at_ts": as_timestamp(F.col("created_at")),
        }
    )
    return staged.withColumns(
        {**scores.date_parts(F.col("created_at_ts")), "pipeline_run_at": F.lit(run_ts)}
    )


def unify(
    turns: DataFrame,
    clicks: DataFrame,
    meta: DataFrame,
    run_ts: str,
    dedupe_metadata: bool = True,
) -> DataFrame:
    """Clean, aggregate, join and enrich the raw tables."""
    joined = join_sources(
        clean_chatbot(turns),
        click_sessions(clean_clickstream(clicks)),
        clean_metadata(meta),
        dedupe_metadata,
    )
    return enrich(joined, run_ts)


def _presence(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key with a flag for each side it occurs in.

    Appending both sides and grouping once needs one shuffle and reduces frequent keys before it; a
    semi join would shuffle every row of both.
    """
    tagged = [
        side.select(*keys, F.lit(here).alias("in_left"), F.lit(not here).alias("in_right"))
        for side, here in ((left, True), (right, False))
    ]
    return (
        tagged[0]
        .union(tagged[1])
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.max("in_left").alias("in_left"), F.max("in_right").alias("in_right"))
    )


def shared_contacts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Contacts that occur in both sources."""
    contacts = _presence(left, right, ["contact_id"])
    return contacts.filter("in_left AND in_right").select("contact_id")


def metadata_coverage(turns: DataFrame, meta: DataFrame) -> DataFrame:
    """How many distinct chatbot sessions have metadata, and which share of all that is."""
    sessions, known = F.count("*"), F.count_if("in_right")
    return (
        _presence(turns, meta, KEYS)
        .filter("in_left")
        .agg(
            sessions.alias("chatbot_sessions"),
            known.alias("with_metadata"),
            (sessions - known).alias("without_metadata"),
            display(F.try_divide(known, sessions), 4).alias("coverage"),
        )
    )
