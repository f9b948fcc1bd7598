"""Topic reports from daily cells: sums per day, topic, unit and channel, kept for later reports.

A cell holds sums and counts, which are exact and add up over any days, and a sketch of its distinct sessions,
which merges too. The table grows with days, not with turns. Reports over cells equal the reports over
the rows of the same whole days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.casts import as_timestamp
from parley.operators import topics
from parley.operators.filters import Selection, select_days
from parley.operators.kpis import DIMENSIONS
from parley.sources.schemas import KEYS

#: Sketches have 2^12 registers: estimates have a standard error of 1.04 / 64, 1.6 %.
LG_REGISTERS = 12
STANDARD_ERROR = 1.04 / 2 ** (LG_REGISTERS / 2)


def session_id() -> Column:
    """What tells sessions apart in a sketch; null if a key is null."""
    contact, session = (F.col(k) for k in KEYS)
    return F.concat(F.length(contact).cast("string"), F.lit(":"), contact, session)


def topic_cells(
    turns: DataFrame,
    meta: DataFrame,
    turn_time: Column | None = None,
    session_time: Column | None = None,
) -> DataFrame:
    """Cells of both tables. A cell is of the turns or of the sessions of a day, the other's sums being null."""
    turn_time = as_timestamp(F.col("created_at")) if turn_time is None else turn_time
    session_time = as_timestamp(F.col("session_start")) if session_time is None else session_time
    by = ["topic_name", *DIMENSIONS]
    sketch = F.hll_sketch_agg(session_id(), LG_REGISTERS).alias("sessions")
    cells = topics.turn_sums(turns, turn_time.cast("date").alias("day"), *by, also=(sketch,))
    return cells.unionByName(
        topics.session_sums(meta, session_time.cast("date").alias("day"), *by), allowMissingColumns=True
    )


def added_up(cells: DataFrame, *by: str) -> DataFrame:
    """Sums over cells per topic, and further columns."""
    names = topics.TURN_SUMS + topics.SESSION_SUMS
    return cells.groupBy("topic_name", *by).agg(*[F.sum(c).alias(c) for c in names])


def topic_measures(cells: DataFrame, *by: str, selection: Selection | None = None) -> DataFrame:
    """``topics.topic_measures`` of a selection."""
    return topics.measures_of(topics.derived(added_up(select_days(cells, selection), *by)), *by)


def topic_session_quality(cells: DataFrame, selection: Selection | None = None) -> DataFrame:
    return topics.session_quality_of(added_up(select_days(cells, selection)))


def topic_table(cells: DataFrame, selection: Selection | None = None) -> DataFrame:
    return topics.table_of(topics.derived(added_up(select_days(cells, selection))))


def escalation_by_topic(
    cells: DataFrame, n: int = 8, selection: Selection | None = None
) -> DataFrame:
    return topics.escalation_of(topics.derived(added_up(select_days(cells, selection))), n)


def weekly_trend(cells: DataFrame, selection: Selection | None = None) -> DataFrame:
    chosen = select_days(cells, selection).filter("volume > 0")
    return topics.weekly_trend(chosen, F.col("day").cast("timestamp_ntz"), F.col("volume"))


def trending_topics(
    cells: DataFrame,
    n: int = 5,
    sort_by: str = "volume",
    include_quality: bool = True,
    include_trend: bool = False,
    selection: Selection | None = None,
) -> DataFrame:
    """``topics.trending_topics`` of a selection."""
    return topics.put_together(
        topics.top_topics(topic_measures(cells, selection=selection), n, sort_by),
        topic_session_quality(cells, selection) if include_quality else None,
        weekly_trend(cells, selection) if include_trend else None,
    )


def topic_sessions(cells: DataFrame, *by: str, selection: Selection | None = None) -> DataFrame:
    """Distinct sessions with turns per topic, estimated; a session on several days counts once.

    ``low`` and ``high`` are three standard errors away. Turns without a key count nowhere.
    """
    merged = F.hll_sketch_estimate(F.hll_union_agg("sessions"))
    found = (
        select_days(cells, selection)
        .filter(F.col("topic_name").isNotNull() & F.col("sessions").isNotNull())
        .groupBy("topic_name", *by)
        .agg(merged.alias("sessions"))
    )
    three = 3 * STANDARD_ERROR
    return found.withColumns(
        {
            "low": F.floor(F.col("sessions") * (1 - three)),
            "high": F.ceil(F.col("sessions") * (1 + three)),
        }
    )
