"""KPI measures over turns and sessions.

All reports share one shape: sums and counts per group first (combined map-side, so the result is as
small as the number of groups), then rates and means from those sums. Reports over both tables
append the two sets of sums and add them up, which needs no join between the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.casts import as_timestamp
from parley.functions.rounding import display
from parley.operators.clean import rated_turns
from parley.operators.filters import Selection, select_days, select_rows

DIMENSIONS = ["business_unit", "application_channel"]

_TURN_VALUES = {
    "escalated": "escalated_to_agent",
    "confidence": "confidence_score",
    "handle": "handle_seconds_dur",
    "resolution": "derived_resolution_score",
}
_SESSION_VALUES = {
    "contained": "contained",
    "session_escalated": "escalated_to_agent",
    "session_turns": "num_turns",
    "duration": "session_duration_seconds",
    "csat": "csat_score",
}

TURN_KPIS = [
    "total_chatbot_turns",
    "escalation_rate_chatbot",
    "avg_confidence_score",
    "avg_handle_seconds",
    "avg_resolution_score",
]
FEEDBACK_KPIS = ["thumbs_up_rate", "thumbs_down_rate", "feedback_volume"]
SESSION_KPIS = [
    "total_sessions",
    "containment_rate",
    "escalation_rate_session",
    "avg_turns_per_session",
    "avg_session_duration_seconds",
]
CSAT_KPIS = ["avg_csat_score", "csat_response_rate"]
ALL_KPIS = TURN_KPIS + FEEDBACK_KPIS + SESSION_KPIS + CSAT_KPIS

_TURN_SUMS = ["turns", "rated", "rated_up", "rated_down"] + [
    f"{name}_{part}" for name in _TURN_VALUES for part in ("sum", "n")
]
_SESSION_SUMS = ["sessions"] + [
    f"{name}_{part}" for name in _SESSION_VALUES for part in ("sum", "n")
]


def _sums_and_counts(values: dict[str, str]) -> list[Column]:
    out = []
    for name, column in values.items():
        out += [F.sum(column).alias(f"{name}_sum"), F.count(column).alias(f"{name}_n")]
    return out


def turn_sums(turns: DataFrame, *groups: str | Column) -> DataFrame:
    rated = (F.col("thumbs_up") == 1) | (F.col("thumbs_down") == 1)
    return turns.groupBy(*groups).agg(
        F.count("*").alias("turns"),
        F.count_if(rated).alias("rated"),
        F.sum(F.when(rated, F.coalesce("thumbs_up", F.lit(0)))).alias("rated_up"),
        F.sum(F.when(rated, F.coalesce("thumbs_down", F.lit(0)))).alias("rated_down"),
        *_sums_and_counts(_TURN_VALUES),
    )


def session_sums(meta: DataFrame, *groups: str | Column) -> DataFrame:
    return meta.groupBy(*groups).agg(
        F.count("*").alias("sessions"), *_sums_and_counts(_SESSION_VALUES)
    )


def _add_up(sums: list[str]) -> list[Column]:
    return [F.sum(c).alias(c) for c in sums]


def _mean(name: str) -> Column:
    return F.try_divide(F.col(f"{name}_sum"), F.col(f"{name}_n"))


def _percent(part: str, whole: str) -> Column:
    return display(F.try_divide(F.col(part), F.col(whole)) * 100, 2)


def _kpi_columns() -> dict[str, Column]:
    return {
        "total_chatbot_turns": F.coalesce("turns", F.lit(0)),
        "escalation_rate_chatbot": display(_mean("escalated") * 100, 2),
        "avg_confidence_score": display(_mean("confidence"), 4),
        "avg_handle_seconds": display(_mean("handle"), 1),
        "avg_resolution_score": display(_mean("resolution"), 4),
        "thumbs_up_rate": _percent("rated_up", "rated"),
        "thumbs_down_rate": _percent("rated_down", "rated"),
        "feedback_volume": F.coalesce("rated", F.lit(0)),
        "total_sessions": F.coalesce("sessions", F.lit(0)),
        "containment_rate": display(_mean("contained") * 100, 2),
        "escalation_rate_session": display(_mean("session_escalated") * 100, 2),
        "avg_turns_per_session": display(_mean("session_turns"), 2),
        "avg_session_duration_seconds": display(_mean("duration"), 1),
        "avg_csat_score": display(_mean("csat"), 2),
        "csat_response_rate": _percent("csat_n", "sessions"),
    }


def figures(names: list[str]) -> list[Column]:
    """Named KPI columns over a frame of sums."""
    columns = _kpi_columns()
    return [columns[name].alias(name) for name in names]


def turn_kpis(turns: DataFrame, *groups: str) -> DataFrame:
    """Turn volume, escalation rate and mean scores, overall or per group."""
    return turn_sums(turns, *groups).select(*groups, *figures(TURN_KPIS))


def feedback_kpis(turns: DataFrame, *groups: str) -> DataFrame:
    """Thumbs up and down as shares of the rated turns."""
    return turn_sums(turns, *groups).select(*groups, *figures(FEEDBACK_KPIS))


def session_kpis(meta: DataFrame, *groups: str) -> DataFrame:
    """Session volume, containment, escalation and mean length."""
    return session_sums(meta, *groups).select(*groups, *figures(SESSION_KPIS))


def csat_kpis(meta: DataFrame, *groups: str) -> DataFrame:
    """Mean satisfaction and the share of sessions that answered."""
    return session_sums(meta, *groups).select(*groups, *figures(CSAT_KPIS))


def kpi_report(
    turns: DataFrame,
    meta: DataFrame,
    selection: Selection | None = None,
    turn_time: Column | None = None,
    session_time: Column | None = None,
) -> DataFrame:
    """All KPIs of a selection in one row, with the selection echoed.

    ``status`` is NO_DATA when neither table has a row in the selection.
    """
    turn_time, session_time = _times(turn_time, session_time)
    sums = turn_sums(select_rows(turns, selection, turn_time)).unionByName(
        session_sums(select_rows(meta, selection, session_time)), allowMissingColumns=True
    )
    return _report(sums, selection)


def _times(turn_time: Column | None, session_time: Column | None) -> tuple[Column, Column]:
    return (
        as_timestamp(F.col("created_at")) if turn_time is None else turn_time,
        as_timestamp(F.col("session_start")) if session_time is None else session_time,
    )


def _report(sums: DataFrame, selection: Selection | None) -> DataFrame:
    turns, sessions = F.coalesce("turns", F.lit(0)), F.coalesce("sessions", F.lit(0))
    status = F.when(turns + sessions == 0, "NO_DATA").otherwise("OK")
    return sums.agg(*_add_up(_TURN_SUMS + _SESSION_SUMS)).select(
        status.alias("status"),
        *figures(ALL_KPIS),
        *[
            F.lit(value).alias(f"filter_{name}")
            for name, value in (selection or Selection()).echo().items()
        ],
    )


def daily_cells(
    turns: DataFrame,
    meta: DataFrame,
    turn_time: Column | None = None,
    session_time: Column | None = None,
) -> DataFrame:
    """Sums of both tables per day, unit and channel: a small table to keep for later reports."""
    turn_time, session_time = _times(turn_time, session_time)
    return turn_sums(turns, turn_time.cast("date").alias("day"), *DIMENSIONS).unionByName(
        session_sums(meta, session_time.cast("date").alias("day"), *DIMENSIONS),
        allowMissingColumns=True,
    )


def report_from_cells(cells: DataFrame, selection: Selection | None = None) -> DataFrame:
    """The KPI report of a selection from kept cells, without reading turns or sessions again.

    Cells hold whole days, so a range that starts or ends inside a day, or ends at midnight, has to
    be answered by ``kpi_report``.
    """
    return _report(select_days(cells, selection), selection)


def kpi_cube(turns: DataFrame, meta: DataFrame) -> DataFrame:
    """The KPI report of every unit and channel, of each of the two alone, and of everything.

    Cells match a report restricted to the same unit and channel, so spelling is compared without
    case and shown in its first variant. The cube runs over the per-cell sums, not over the rows:
    its fourfold expansion touches as many rows as there are cells.
    """
    keys = [F.lower(c).alias(f"{c}_key") for c in DIMENSIONS]
    shown = [F.min(c).alias(c) for c in DIMENSIONS]

    def cells(sums: DataFrame, parts: list[str]) -> DataFrame:
        return sums.groupBy(*keys).agg(*shown, *_add_up(parts))

    both = cells(turn_sums(turns, *DIMENSIONS), _TURN_SUMS).unionByName(
        cells(session_sums(meta, *DIMENSIONS), _SESSION_SUMS), allowMissingColumns=True
    )
    cubed = both.cube(*[f"{c}_key" for c in DIMENSIONS]).agg(
        *[F.min(c).alias(c) for c in DIMENSIONS],
        *[F.grouping(f"{c}_key").alias(f"{c}_all") for c in DIMENSIONS],
        *_add_up(_TURN_SUMS + _SESSION_SUMS),
    )
    return cubed.select(
        *[
            F.when(F.col(f"{c}_all") == 1, "ALL").otherwise(F.col(c)).alias(c)
            for c in DIMENSIONS
        ],
        (F.col("business_unit_all") * 2 + F.col("application_channel_all"))
        .cast("int")
        .alias("grouping_level"),
        *figures(ALL_KPIS),
    )


def headline_kpis(turns: DataFrame, meta: DataFrame) -> DataFrame:
    """The five headline figures, unrounded; without sessions containment is 0 and CSAT null."""
    sums = turn_sums(turns).unionByName(session_sums(meta), allowMissingColumns=True)
    return sums.agg(*_add_up(_TURN_SUMS + _SESSION_SUMS)).select(
        F.when(F.col("sessions") == 0, 0.0)
        .otherwise(_mean("contained") * 100)
        .alias("containment_rate"),
        (_mean("escalated") * 100).alias("escalation_rate"),
        _mean("confidence").alias("avg_confidence"),
        _mean("resolution").alias("avg_resolution"),
        _mean("csat").alias("csat_score"),
    )


def thumbs_split(turns: DataFrame) -> DataFrame:
    """Unrounded share of each kind of feedback among rated turns; no rows without any."""
    totals = rated_turns(turns).agg(
        F.count("*").alias("rated"),
        F.sum(F.coalesce("thumbs_up", F.lit(0))).alias("up"),
        F.sum(F.coalesce("thumbs_down", F.lit(0))).alias("down"),
    )

    def row(label: str, column: str) -> Column:
        share = F.try_divide(F.col(column), F.col("rated")) * 100
        return F.struct(F.lit(label).alias("feedback"), share.alias("percent"))

    return totals.filter("rated > 0").select(
        F.inline(F.array(row("Thumbs Up", "up"), row("Thumbs Down", "down")))
    )
