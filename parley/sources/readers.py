"""Scans: CSV, Parquet and JSON-lines inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions.casts import as_timestamp, cast_columns
from parley.sources import csv_files
from parley.sources.published import PARTITION_COLUMNS, current, read_days
from parley.sources.schemas import SOURCES, TIME_COLUMN


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool | None = None
) -> DataFrame:
    """CSV with a header, matched to ``schema`` by column name.

    Spark would bind an explicit CSV schema by position, so cells are read as text (only header lines are
    looked at up front, no inference pass) and cast afterwards. Blank cells and text that does not parse
    become null; columns the schema does not name stay as text.

    Files of a folder may have different headers: columns are matched by name file by file, and one that
    a file lacks is null there. Without any file, or with empty files only, there are no rows.

    Quoted cells may hold line breaks. By default one pass over the text finds the files in which
    some do: each of these is read by a single task, the others are cut as usual. ``multi_line=True`` says that any
    file may have them, ``False`` that none has; either saves the pass. What ``False`` is wrong about is
    read as two rows.
    """
    raw = csv_files.scan(spark, path, multi_line)
    return spark.createDataFrame([], schema) if raw is None else cast_columns(raw, schema)


def load_sources(
    spark: SparkSession, base: str, multi_line: bool | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Chatbot turns, clickstream events and session metadata found as CSV under ``base``."""
    root = base.rstrip("/")
    turns, clicks, meta = (
        read_csv(spark, f"{root}/{name}.csv", schema, multi_line)
        for name, schema in SOURCES.items()
    )
    return turns, clicks, meta


def with_event_time(df: DataFrame, source: str, to: str = "event_time") -> DataFrame:
    """Add the parsed event time of a source; unparseable text gives null."""
    return df.withColumn(to, as_timestamp(F.col(TIME_COLUMN[source])))


def load_timed(
    spark: SparkSession, base: str, multi_line: bool | None = None
) -> tuple[DataFrame, DataFrame]:
    """Chatbot turns and session metadata from CSV, each with its parsed ``event_time``.

    Reports that run several times over one load should ``persist()`` what they filter out of it.
    """
    turns, _, meta = load_sources(spark, base, multi_line)
    return (
        with_event_time(turns, "chatbot_interactions"),
        with_event_time(meta, "conversation_metadata"),
    )


def sample_rows(df: DataFrame, limit: int, order_by: list[str] | None = None) -> DataFrame:
    """The first ``limit`` rows by ``order_by`` (all columns by default); 0 keeps every row.

    Ordering by all columns makes the sample repeatable. Spark plans this as a per-task top-n. An
    empty list takes any ``limit`` rows and reads no more of the table than it needs for them.
    """
    if not limit:
        return df
    if order_by is not None and not order_by:
        return df.limit(limit)
    return df.orderBy(*(order_by or df.columns)).limit(limit)


def read_parquet_sample(
    spark: SparkSession, path: str, limit: int = 0, order_by: list[str] | None = None
) -> DataFrame:
    return sample_rows(spark.read.parquet(path), limit, order_by)


def read_csv_sample(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    limit: int = 0,
    order_by: list[str] | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    return sample_rows(read_csv(spark, path, schema, multi_line), limit, order_by)


def read_unified(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Unified table with its partition columns kept as text ('05', not 5).

    Of a published table the current version is read, whole, see ``sources.published``. A plain folder is
    read as it is: Spark infers partition values as integers unless a schema names their type, so without
    one the file schema is taken from the Parquet footer and the partition columns are added as strings.
    """
    if pointer := current(spark, path):
        return read_days(spark, path, pointer, schema)
    if schema is None:
        inferred = spark.read.parquet(path).schema
        schema = T.StructType(
            [f for f in inferred if f.name not in PARTITION_COLUMNS]
            + [T.StructField(name, T.StringType()) for name in PARTITION_COLUMNS]
        )
    return spark.read.schema(schema).parquet(path)
