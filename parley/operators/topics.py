"""Topic-level aggregates, rankings and the week-over-week trend.

Rows without a topic do not form a group of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.casts import as_timestamp
from parley.functions.rounding import display
from parley.functions.scores import topic_quality

# The columns a ranking may be asked for; anything else ranks by volume.
SORT_COLUMNS = {
    "volume": "volume",
    "escalation_rate": "escalation_rate_pct",
    "resolution_score": "avg_resolution_score",
    "thumbs_up_rate": "thumbs_up_rate_pct",
}


# What is added up of a topic's turns, and of its sessions.
_TOTALS = {
    "escalation_count": "escalated_to_agent",
    "thumbs_up_count": "thumbs_up",
    "thumbs_down_count": "thumbs_down",
}
_MEANS = {
    "confidence": "confidence_score",
    "resolution": "derived_resolution_score",
    "handle": "handle_seconds_dur",
}
TURN_SUMS = ["volume", *_TOTALS, *[f"{m}_{part}" for m in _MEANS for part in ("sum", "n")]]
SESSION_SUMS = ["session_count", "session_resolution_sum", "session_resolution_n"]


def turn_sums(turns: DataFrame, *by: str | Column, also: tuple[Column, ...] = ()) -> DataFrame:
    """Volume, totals, sums and counts per group, which add up over groups, and further aggregates."""
    return turns.groupBy(*by).agg(
        *also,
        F.count("*").alias("volume"),
        *[F.sum(c).cast("long").alias(name) for name, c in _TOTALS.items()],
        *[
            x
            for name, c in _MEANS.items()
            for x in (F.sum(F.col(c).cast("double")).alias(f"{name}_sum"), F.count(c).alias(f"{name}_n"))
        ],
    )


def session_sums(meta: DataFrame, *by: str | Column) -> DataFrame:
    score = F.col("derived_resolution_score")
    return meta.groupBy(*by).agg(
        F.count("*").alias("session_count"),
        F.sum(score).alias("session_resolution_sum"),
        F.count(score).alias("session_resolution_n"),
    )


def derived(sums: DataFrame) -> DataFrame:
    """Means and totals from sums; groups without turns or topic are left out."""
    return sums.filter(F.col("topic_name").isNotNull() & (F.col("volume") > 0)).withColumns(
        {
            **{name: F.coalesce(name, F.lit(0)) for name in _TOTALS},
            **{f"avg_{m}": F.try_divide(f"{m}_sum", f"{m}_n") for m in _MEANS},
        }
    )


def _topic_sums(turns: DataFrame, *by: str) -> DataFrame:
    named = turns.filter(F.col("topic_name").isNotNull())
    return derived(turn_sums(named, "topic_name", *by))


def _rate(count: str) -> Column:
    return F.col(count) / F.col("volume") * 100


def topic_measures(turns: DataFrame, *by: str) -> DataFrame:
    """Volume, counts, mean scores and rates per topic; rates are shares of the topic's volume.

    Further columns break each topic down, for example by unit or channel.
    """
    return measures_of(_topic_sums(turns, *by), *by)


def measures_of(sums: DataFrame, *by: str) -> DataFrame:
    """``topic_measures`` from sums that are derived already."""
    return sums.select(
        "topic_name",
        *by,
        "volume",
        "escalation_count",
        "thumbs_up_count",
        "thumbs_down_count",
        display(F.col("avg_confidence"), 4).alias("avg_confidence_score"),
        display(F.col("avg_resolution"), 4).alias("avg_resolution_score"),
        display(F.col("avg_handle"), 1).alias("avg_handle_seconds"),
        display(_rate("escalation_count"), 2).alias("escalation_rate_pct"),
        display(_rate("thumbs_up_count"), 2).alias("thumbs_up_rate_pct"),
        display(_rate("thumbs_down_count"), 2).alias("thumbs_down_rate_pct"),
    )


def topic_session_quality(meta: DataFrame) -> DataFrame:
    """Mean session resolution per topic, its tier (from the unrounded mean) and session count."""
    named = meta.filter(F.col("topic_name").isNotNull())
    return session_quality_of(session_sums(named, "topic_name"))


def session_quality_of(sums: DataFrame) -> DataFrame:
    """``topic_session_quality`` from sums per topic."""
    mean = F.try_divide("session_resolution_sum", "session_resolution_n")
    known = sums.filter(F.col("topic_name").isNotNull() & (F.col("session_count") > 0))
    return known.select(
        "topic_name",
        topic_quality(mean).alias("resolution_quality"),
        display(mean, 4).alias("avg_resolution"),
        "session_count",
    )


def top_topics(measures: DataFrame, n: int = 5, sort_by: str = "volume") -> DataFrame:
    """The ``n`` leading topics by a rounded measure; equal values are ordered by topic name."""
    if not 1 <= n <= 10:
        raise ValueError(f"n must lie between 1 and 10, not {n}")
    column = SORT_COLUMNS.get(sort_by, "volume")
    return measures.orderBy(F.desc(column), "topic_name").limit(n)


def weekly_trend(
    turns: DataFrame, ts: Column | None = None, volume: Column | None = None
) -> DataFrame:
    """Direction of each topic's volume from the last but one to the last week that has turns.

    A row counts as one turn, or as many as ``volume`` says.

    Weeks are ISO weeks together with their ISO year. A topic absent from the earlier week is NEW;
    with fewer than two weeks every topic is UNKNOWN.

    The two weeks come from a scalar subquery over the (topic, week) counts. Both it and the label
    read the same counts, none filtered or narrowed below the aggregation, so Spark shuffles them
    once and reuses that; rows without a topic are dropped last for the same reason.
    """
    ts = as_timestamp(F.col("created_at")) if ts is None else ts
    week = F.extract(F.lit("YEAROFWEEK"), ts) * 100 + F.weekofyear(ts)
    many = F.count("*") if volume is None else F.sum(volume)
    counts = turns.groupBy("topic_name", week.alias("week")).agg(many.alias("turns"))
    weekly = counts.groupBy("week").agg(F.sum("turns").alias("turns"))
    last_two = weekly.filter(F.col("turns") > 0).orderBy(F.desc_nulls_last("week")).limit(2)
    bounds = last_two.agg(
        F.struct(
            F.min("week").alias("previous"),
            F.max("week").alias("current"),
            F.count("week").alias("n"),
        )
    ).scalar()

    def volume_of(which: str) -> Column:
        picked = F.sum(F.when(F.col("week") == F.col(f"bounds.{which}"), F.col("turns")))
        return F.coalesce(picked, F.lit(0)).alias(which)

    volumes = (
        counts.withColumn("bounds", bounds)
        .groupBy("topic_name")
        .agg(
            volume_of("previous"),
            volume_of("current"),
            F.max("bounds.n").alias("weeks"),
            F.count("topic_name").alias("named"),
        )
        .filter("named > 0")
    )
    before, now = F.col("previous"), F.col("current")
    label = (
        F.when(F.col("weeks") < 2, "UNKNOWN")
        .when(before == 0, "NEW")
        .when(now > before * 1.10, "TRENDING_UP")
        .when(now < before * 0.90, "TRENDING_DOWN")
        .otherwise("STABLE")
    )
    return volumes.select(
        "topic_name",
        before.alias("previous_volume"),
        now.alias("current_volume"),
        label.alias("wow_trend"),
    )


def trending_topics(
    turns: DataFrame,
    meta: DataFrame,
    n: int = 5,
    sort_by: str = "volume",
    include_quality: bool = True,
    include_trend: bool = False,
    ts: Column | None = None,
) -> DataFrame:
    """Leading topics with, on request, their session quality and weekly trend."""
    return put_together(
        top_topics(topic_measures(turns), n, sort_by),
        topic_session_quality(meta) if include_quality else None,
        weekly_trend(turns, ts) if include_trend else None,
    )


def put_together(
    top: DataFrame, quality: DataFrame | None = None, trend: DataFrame | None = None
) -> DataFrame:
    if quality is not None:
        top = top.join(quality, "topic_name", "left")
    if trend is not None:
        top = top.join(trend.select("topic_name", "wow_trend"), "topic_name", "left").withColumn(
            "wow_trend", F.coalesce("wow_trend", F.lit("UNKNOWN"))
        )
    return top


def topic_table(turns: DataFrame) -> DataFrame:
    """Topics by descending volume with display rounding."""
    return table_of(_topic_sums(turns))


def table_of(sums: DataFrame) -> DataFrame:
    """``topic_table`` from sums that are derived already."""
    return (
        sums.select(
            "topic_name",
            F.col("volume"),
            display(_rate("escalation_count"), 1).alias("escalation_rate_pct"),
            display(_rate("thumbs_up_count"), 1).alias("thumbs_up_rate_pct"),
            display(F.col("avg_confidence"), 3).alias("avg_confidence"),
            display(F.col("avg_resolution"), 3).alias("avg_resolution"),
            display(F.col("avg_handle"), 0).cast("int").alias("avg_handle_secs"),
        )
        .orderBy(F.desc("volume"), "topic_name")
    )


# Column headings of the topic table.
TOPIC_TABLE_HEADINGS = {
    "topic_name": "Topic",
    "volume": "Volume",
    "escalation_rate_pct": "Escalation %",
    "thumbs_up_rate_pct": "Thumbs Up %",
    "avg_confidence": "Avg Confidence",
    "avg_resolution": "Avg Resolution",
    "avg_handle_secs": "Avg Handle (s)",
}


def with_headings(table: DataFrame) -> DataFrame:
    """The topic table under its display headings."""
    return table.select(
        *[F.col(name).alias(title) for name, title in TOPIC_TABLE_HEADINGS.items()]
    )


def escalation_by_topic(turns: DataFrame, n: int = 8) -> DataFrame:
    """The topics that escalate most, with their unrounded rate."""
    return escalation_of(_topic_sums(turns), n)


def escalation_of(sums: DataFrame, n: int = 8) -> DataFrame:
    """``escalation_by_topic`` from sums that are derived already."""
    return (
        sums.select(
            "topic_name",
            "volume",
            F.col("escalation_count").alias("escalations"),
            _rate("escalation_count").alias("escalation_rate"),
        )
        .orderBy(F.desc("escalation_rate"), "topic_name")
        .limit(n)
    )
