"""Session facts as sums that can be added up later: what batches of metadata and clicks say, and what follows.

A batch gives three narrow tables. Rows of one session in several batches add up to what one pass over all of them
gives, so a batch is stored beside the earlier ones and none is written again.

* ``sessions``: per session its latest metadata, and sums and counts over its clicks
* ``values``: the distinct pages and event types of each session; a row each, so a session with very many
  is no large row
* ``days``: the days on which a session has turns
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions.casts import as_timestamp
from parley.operators.joins import spread_join
from parley.sources.published import PARTITION_COLUMNS
from parley.sources.schemas import KEYS

_KEY_FIELDS = [T.StructField(name, T.StringType()) for name in KEYS]
#: Which click columns the distinct counts are over, and the names of these.
_VALUES = {"page_name": "unique_pages_visited", "event_type": "unique_event_types"}
VALUES = T.StructType([*_KEY_FIELDS, *[T.StructField(n, T.StringType()) for n in ("kind", "value")]])
DAYS = T.StructType([*_KEY_FIELDS, *[T.StructField(n, T.StringType()) for n in PARTITION_COLUMNS]])


def session_sums(clicks: DataFrame, meta: DataFrame, order_by: str = "session_start") -> DataFrame:
    """One row per session that the batch says anything about; input is cleaned."""
    rest = [c for c in meta.columns if c not in KEYS and c != order_by]
    time = as_timestamp(F.col(order_by).cast("string")).alias("time")
    latest = meta.groupBy(*KEYS).agg(F.max(F.struct(time, order_by, *rest)).alias("meta"))
    sums = clicks.groupBy(*KEYS).agg(
        F.count("*").alias("clicks"),
        F.sum("is_bounce").alias("bounces"),
        F.sum("scroll_depth_pct").alias("scroll"),
        F.count("scroll_depth_pct").alias("scrolled"),
        F.sum("time_on_page_seconds").alias("seconds"),
    )
    return latest.join(sums, KEYS, "full")


def session_values(clicks: DataFrame) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in _VALUES])
    rows = clicks.select(*KEYS, F.inline(pairs))
    return rows.where("value IS NOT NULL").distinct()


def session_days(turns: DataFrame) -> DataFrame:
    """The days of sessions with turns; ``turns`` has the partition columns."""
    return turns.select(*KEYS, *PARTITION_COLUMNS).distinct()


def added_up(sums: DataFrame) -> DataFrame:
    """One row per session from the rows of several batches. A sum over nothing stays null."""
    added = ("clicks", "bounces", "scroll", "scrolled", "seconds")
    return sums.groupBy(*KEYS).agg(F.max("meta").alias("meta"), *[F.sum(c).alias(c) for c in added])


def facts(sums: DataFrame, values: DataFrame, meta_columns: list[str]) -> DataFrame:
    """Metadata and click measures per session, as ``unify.session_facts`` gives them.

    ``values`` may repeat a row, as batches do.
    """
    kinds = [F.count_if(F.col("kind") == c).alias(name) for c, name in _VALUES.items()]
    distinct = values.distinct().groupBy(*KEYS).agg(*kinds)
    rows = added_up(sums).join(distinct, KEYS, "left")
    clicked = F.col("clicks").isNotNull()
    return rows.select(
        *KEYS,
        *[F.col(f"meta.{c}").alias(c) for c in meta_columns if c not in KEYS],
        F.col("clicks").alias("click_event_count"),
        F.col("bounces").alias("bounce_events"),
        F.try_divide("scroll", "scrolled").alias("avg_scroll_depth_pct"),
        F.col("seconds").alias("total_time_on_page_seconds"),
        *[F.when(clicked, F.coalesce(name, F.lit(0))).alias(name) for name in _VALUES.values()],
    )


def of_sessions(df: DataFrame, sessions: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of the given sessions, or with ``left_anti`` of all others."""
    return spread_join(df, sessions.select(*KEYS), KEYS, how)
