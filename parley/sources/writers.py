"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from parley.operators.joins import spread_join
from parley.sources.published import (
    PARTITION_COLUMNS,
    Pointer,
    current,
    has_plain_days,
    new_version,
    publish,
    read_days,
    write_days,
)
from parley.sources.csv_files import CSV_OPTIONS
from parley.sources.readers import read_unified

# What tells the rows of the unified table apart when a batch is merged into it.
TURN_KEYS = ["contact_id", "session_id", "created_at"]


def write_unified(df: DataFrame, path: str, mode: str = "full", plain: bool = False) -> None:
    """Date-partitioned snappy Parquet, published at once.

    ``mode="full"`` makes ``df`` the whole table. ``mode="days"`` replaces the days present in ``df``
    and leaves the others; it is right only if ``df`` holds all rows of those days. For a batch of
    further rows there is ``merge_unified``. ``df`` may be read from the table itself. A job that stops on the way
    changes nothing for readers; ``published.remove_superseded`` clears what is no longer needed.

    ``plain=True`` writes the day folders straight under ``path``, for tools that know nothing of the
    pointer; readers then see days come and go one by one.
    """
    if mode not in ("full", "days"):
        raise ValueError(f"mode must be 'full' or 'days', not {mode!r}")
    if plain:
        (
            df.hint("rebalance", *PARTITION_COLUMNS)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static" if mode == "full" else "dynamic")
            .option("compression", "snappy")
            .partitionBy(*PARTITION_COLUMNS)
            .parquet(path)
        )
        return
    spark, base, version = df.sparkSession, current(df.sparkSession, path), new_version()
    if mode == "days" and base is None and has_plain_days(spark, path):
        raise ValueError(f"{path} is a plain folder: write it in full first, or use plain=True")
    days = write_days(df, path, version)
    kept = base.days if base and mode == "days" else {}
    publish(spark, path, base, Pointer(schema=df.schema.json(), days={**kept, **days}))


def merge_unified(batch: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """Add a batch of unified rows to the stored table.

    Rows of the batch take the place of stored rows with the same ``keys`` (null equal to null); all
    other stored rows stay, those without a readable time included. So a late turn joins its day, and
    a batch merged twice leaves no duplicates. A key whose rows move to another day is not looked for
    there. Only the days that the batch touches are read and written, and they are published together.

    The rows are taken as they are: what a batch says about sessions does not reach stored turns. For
    batches of raw tables there is ``plans.increments.merge_batch``.
    """
    keys = keys or TURN_KEYS
    spark = batch.sparkSession
    base, version = current(spark, path), new_version()
    if base is None:
        read_unified(spark, path, batch.schema)  # there has to be a folder
        if has_plain_days(spark, path):
            raise ValueError(f"{path} is a plain folder: write it in full first")
    # the batch is written where it stays, day by day, and the stored rows that remain are put beside it
    days = write_days(batch, path, version)
    written = Pointer(days=days)
    fresh = read_days(spark, path, written, batch.schema)
    touched = read_days(spark, path, base or Pointer(), batch.schema, list(days))
    kept = spread_join(touched, fresh.select(*keys).distinct(), keys, "left_anti")
    write_days(kept, path, version)
    publish(spark, path, base, Pointer(schema=fresh.schema.json(), days={**(base.days if base else {}), **days}))


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per row, null fields kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; padding inside text cells is kept."""
    (
        df.write.mode("overwrite")
        .options(**CSV_OPTIONS)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
