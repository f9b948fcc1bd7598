"""Daily series, breakdowns by one column and the score histogram."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parley.functions.casts import as_timestamp


def _by_day(turns: DataFrame, ts: Column | None, *measures: Column) -> DataFrame:
    ts = as_timestamp(F.col("created_at")) if ts is None else ts
    daily = turns.groupBy(ts.cast("date").alias("date")).agg(*measures)
    return daily.filter(F.col("date").isNotNull())


def _fill_days(daily: DataFrame, max_gap_days: int | None, **missing: Column) -> DataFrame:
    """Add the days between the first and last that have no row.

    Each day is stretched to the day before the next one present. A caller whose data may hold stray
    dates, centuries away, can set ``max_gap_days``: longer gaps then stay as they are. The window
    sees one row per calendar day, however many turns there are.
    """
    following = F.lead("date").over(W.orderBy("date"))
    near = following.isNotNull()
    if max_gap_days is not None:
        near = F.datediff(following, F.col("date")) <= max_gap_days
    last = F.when(near, F.date_sub(following, 1)).otherwise(F.col("date"))
    stretched = daily.withColumn("last", last).withColumn(
        "day", F.explode(F.sequence("date", "last"))
    )
    return stretched.select(
        F.col("day").alias("date"),
        *[
            F.when(F.col("day") == F.col("date"), F.col(name)).otherwise(value).alias(name)
            for name, value in missing.items()
        ],
    )


def daily_volume(
    turns: DataFrame, ts: Column | None = None, max_gap_days: int | None = None
) -> DataFrame:
    """Turns with a session per calendar day; a day without any counts 0.

    Every gap is filled, or those where the next day present is at most ``max_gap_days`` later.
    """
    daily = _by_day(turns, ts, F.count("session_id").alias("interactions"))
    return _fill_days(daily, max_gap_days, interactions=F.lit(0)).orderBy("date")


def daily_escalation(
    turns: DataFrame, ts: Column | None = None, max_gap_days: int | None = None
) -> DataFrame:
    """Escalation share per calendar day in percent (unrounded); a day without turns is null.

    Every gap is filled, or those where the next day present is at most ``max_gap_days`` later.
    """
    rate = (F.avg("escalated_to_agent") * 100).alias("escalation_rate")
    daily = _by_day(turns, ts, rate)
    return _fill_days(daily, max_gap_days, escalation_rate=F.lit(None)).orderBy("date")


def volume_by(turns: DataFrame, column: str) -> DataFrame:
    """Turns per value of a column, most first; rows without a value are left out."""
    return (
        turns.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("volume"))
        .orderBy(F.desc("volume"), column)
    )


def volume_by_channel(turns: DataFrame) -> DataFrame:
    return volume_by(turns, "application_channel")


def volume_by_unit(turns: DataFrame) -> DataFrame:
    return volume_by(turns, "business_unit")


def resolution_histogram(turns: DataFrame, bins: int = 20) -> DataFrame:
    """Turns per equal-width score bin of [0, 1]; the last bin includes 1.

    Scores are compared with the edges themselves, the doubles nearest to 0.05, 0.1 and so on, as
    0.15 / 0.05 is just below 3. Scores below 0 are counted in bin -1 and scores above 1 in the bin
    after the last, without edges.
    """
    score = F.col("derived_resolution_score")
    edges = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    place = F.size(F.filter(edges, lambda edge: edge <= score))
    number = F.when(score < 0, -1).when(score > 1, bins).otherwise(place)
    inside = F.col("bin").between(0, bins - 1)
    return (
        turns.filter(score.isNotNull())
        .groupBy(number.alias("bin"))
        .agg(F.count("*").alias("turns"))
        .select(
            "bin",
            F.when(inside, F.col("bin") / bins).alias("lower"),
            F.when(inside, (F.col("bin") + 1) / bins).alias("upper"),
            "turns",
        )
        .orderBy("bin")
    )
