"""Dimension and date filters."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.sources.readers import PARTITION_COLUMNS


# Fixed value: the choice that stands for every unit or channel.
ANY = "All"

_DATE = re.compile(r"\s*(\d{4})(?:-(\d{1,2})(?:-(\d{1,2})(?:[T ](.*\S))?)?)?\s*", re.ASCII)


def parse_bound(text: str) -> dt.datetime:
    """The moment that a date text names: ``2024``, ``2024-1``, ``2024-01-05`` or with a time of day.

    A missing month or day is the first. Anything else is refused, as is a time zone.
    """
    found = _DATE.fullmatch(text)
    if not found:
        raise ValueError(f"not a date: {text!r}")
    year, month, day, clock = found.groups()
    date = dt.date(int(year), int(month or 1), int(day or 1))
    time = dt.time.fromisoformat(clock) if clock else dt.time()
    if time.tzinfo is not None:
        raise ValueError(f"a date bound has no time zone: {text!r}")
    return dt.datetime.combine(date, time)


@dataclass(frozen=True)
class Selection:
    """What a report is restricted to; an empty field does not restrict.

    ``exact`` compares unit and channel byte for byte instead of ignoring case, and takes ``"All"``
    as no restriction.
    ``end_mode`` is ``"day"`` (the whole end day counts) or ``"midnight"`` (it stops at 00:00, or at
    the time of day given). Dates are parsed once, here, so their spelling does not matter.
    """

    business_unit: str | None = None
    application_channel: str | None = None
    start_date: str | None = None
    end_date: str | None = None
    exact: bool = False
    end_mode: str = "day"

    def __post_init__(self) -> None:
        if self.end_mode not in ("day", "midnight"):
            raise ValueError(f"end_mode must be 'day' or 'midnight', not {self.end_mode!r}")
        _ = self.start, self.end

    @property
    def start(self) -> dt.datetime | None:
        return parse_bound(self.start_date) if self.start_date else None

    @property
    def end(self) -> dt.datetime | None:
        return parse_bound(self.end_date) if self.end_date else None

    def echo(self) -> dict[str, str]:
        """The restriction as shown in a report."""
        return {
            "business_unit": self.business_unit or "ALL",
            "application_channel": self.application_channel or "ALL",
            "start_date": self.start_date or "ALL",
            "end_date": self.end_date or "ALL",
        }


def by_dimensions(df: DataFrame, selection: Selection) -> DataFrame:
    for name in ("business_unit", "application_channel"):
        wanted = getattr(selection, name)
        if not wanted or (selection.exact and wanted == ANY):
            continue
        if selection.exact:
            df = df.filter(F.col(name) == wanted)
        else:
            df = df.filter(F.lower(name) == F.lower(F.lit(wanted)))
    return df


def by_time(df: DataFrame, ts: Column, selection: Selection) -> DataFrame:
    """Keep rows whose time lies in the range; unknown times fail any bound."""
    start, end = selection.start, selection.end
    if start:
        df = df.filter(ts >= F.lit(start.isoformat()).cast("timestamp_ntz"))
    if end:
        if selection.end_mode == "midnight":
            df = df.filter(ts <= F.lit(end.isoformat()).cast("timestamp_ntz"))
        else:
            after = F.date_add(F.lit(end.date().isoformat()).cast("date"), 1).cast("timestamp_ntz")
            df = df.filter(ts < after)
    if set(PARTITION_COLUMNS) <= set(df.columns):
        df = _prune_days(df, selection)
    return df


def _prune_days(df: DataFrame, selection: Selection) -> DataFrame:
    """Repeat the range on the partition columns, so that other days are never listed or read.

    The days compared are those of the parsed bounds, in the padded spelling of the partitions.
    """
    day = F.concat_ws("-", *PARTITION_COLUMNS)
    if selection.start:
        df = df.filter(day >= selection.start.date().isoformat())
    if selection.end:
        df = df.filter(day <= selection.end.date().isoformat())
    return df


def select_rows(df: DataFrame, selection: Selection | None, ts: Column) -> DataFrame:
    if selection is None:
        return df
    return by_time(by_dimensions(df, selection), ts, selection)


def select_days(cells: DataFrame, selection: Selection | None, day: str = "day") -> DataFrame:
    """Cells of whole days in a selection. One that starts or ends inside a day, or ends at midnight, cuts
    a day, which cells cannot: it is refused, and has to be answered from rows."""
    if selection and selection.end and selection.end_mode != "day":
        raise ValueError("daily cells cannot cut a day")
    if selection and selection.start and selection.start.time() != dt.time():
        raise ValueError("daily cells cannot cut a day")
    return select_rows(cells, selection, F.col(day).cast("timestamp_ntz"))


def filter_options(turns: DataFrame, ts: Column) -> DataFrame:
    """Values a report can be restricted to, as (option, value) rows.

    The turns are reduced once to one row per unit and channel; both lists and the date span come
    from that.
    """
    cells = turns.groupBy("business_unit", "application_channel").agg(
        F.min(ts.cast("date")).alias("first"), F.max(ts.cast("date")).alias("last")
    )

    def option(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("option"), value.cast("string").alias("value"))

    names = ("business_unit", "application_channel")
    values = cells.select(F.inline(F.array(*[option(n, F.col(n)) for n in names]))).distinct()
    span = cells.agg(F.min("first").alias("first"), F.max("last").alias("last")).select(
        F.inline(F.array(option("min_date", F.col("first")), option("max_date", F.col("last"))))
    )
    return values.union(span).dropna().orderBy("option", "value")
