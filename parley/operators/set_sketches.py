"""Overlap and completeness of sources from sketches of their contacts and sessions, one a day and source.

The exact forms (``unify.shared_contacts``, ``unify.metadata_coverage``) shuffle ids. Here each task
makes sketches of bounded size, and only these are shuffled; they merge over days and can be kept, so any span of
days can be asked later without reading the rows. Sketches of up to ``2 ** LG_NOMINAL`` ids hold
them all and answer exactly; beyond, answers are estimates with a known error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.casts import as_timestamp
from parley.operators.filters import Selection, select_days
from parley.operators.topic_cells import session_id
from parley.sources.schemas import TIME_COLUMN

#: 2^12 ids a sketch: a distinct count has a standard error of 1 / 64, 1.6 %.
LG_NOMINAL = 12
IDS = ("contacts", "sessions")


def daily_sketches(lg_nominal: int = LG_NOMINAL, **sources: DataFrame) -> DataFrame:
    """Per day and source: sketches of the distinct contacts and sessions, null keys left out.

    Sources are named as in ``schemas.SOURCES``, which tells their time column.
    """
    made = []
    for name, df in sources.items():
        day = as_timestamp(F.col(TIME_COLUMN[name]).cast("string")).cast("date")
        ids = df.select(day.alias("day"), F.col("contact_id").alias("contacts"), session_id().alias("sessions"))
        sketches = [F.theta_sketch_agg(c, lg_nominal).alias(c) for c in IDS]
        made.append(ids.groupBy("day").agg(*sketches).withColumn("source", F.lit(name)))
    return reduce(DataFrame.unionByName, made).select("day", "source", *IDS)


def _merged(
    sketches: DataFrame, left: str, right: str, ids: str, selection: Selection | None, lg_nominal: int
) -> DataFrame:
    """One row with both sources' sketches over the selected days."""
    if ids not in IDS:
        raise ValueError(f"ids must be one of {IDS}, not {ids!r}")
    chosen = select_days(sketches, selection)

    def of(source: str) -> Column:
        return F.theta_union_agg(F.when(F.col("source") == source, F.col(ids)), lg_nominal)

    return chosen.agg(of(left).alias("a"), of(right).alias("b"))


def overlap(
    sketches: DataFrame,
    left: str,
    right: str,
    ids: str = "contacts",
    selection: Selection | None = None,
    lg_nominal: int = LG_NOMINAL,
) -> DataFrame:
    """How many ids are in each of two sources, in both and in any; one row.

    ``standard_error`` is that of ``both``, as a share of it: the root of any / both, over the root of the
    sketch's nominal size less one; 0 where the sketches hold all ids, null where ``both`` is 0.
    """
    both = F.theta_sketch_estimate(F.theta_intersection("a", "b"))
    either = F.theta_sketch_estimate(F.theta_union("a", "b", lg_nominal))
    found = _merged(sketches, left, right, ids, selection, lg_nominal).select(
        F.theta_sketch_estimate("a").alias("in_left"),
        F.theta_sketch_estimate("b").alias("in_right"),
        both.alias("both"),
        either.alias("any"),
    )
    kept = 2**lg_nominal
    spread = F.sqrt(F.try_divide("any", "both")) / F.sqrt(F.lit(kept - 1.0))
    exact = (F.col("any") <= kept) & (F.col("in_left") <= kept) & (F.col("in_right") <= kept)
    return found.withColumn("standard_error", F.when(exact, F.lit(0.0)).otherwise(spread))


def coverage(
    sketches: DataFrame,
    left: str = "chatbot_interactions",
    right: str = "conversation_metadata",
    selection: Selection | None = None,
    lg_nominal: int = LG_NOMINAL,
) -> DataFrame:
    """Distinct sessions of ``left``, how many of them ``right`` knows, and which share that is.

    Days select either source's rows by its own time.
    """
    found = overlap(sketches, left, right, "sessions", selection, lg_nominal)
    return found.select(
        F.col("in_left").alias("sessions"),
        F.col("both").alias("known"),
        F.when(F.col("in_left") > 0, F.least(F.col("both") / F.col("in_left"), F.lit(1.0))).alias("coverage"),
        "standard_error",
    )
