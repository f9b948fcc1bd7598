"""Run times and failures from structured log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.rounding import display
from parley.functions.text import mask_sensitive
from parley.sources.schemas import LOG_LINE


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """JSON log lines with sensitive values in the message masked."""
    return _masked(spark.read.schema(LOG_LINE).json(path))


def parse_log_lines(lines: DataFrame, column: str) -> DataFrame:
    """The same from a text column that holds one log line per row."""
    parsed = lines.withColumn("__line", F.from_json(F.col(column), LOG_LINE)).drop(column)
    rest = [c for c in parsed.columns if c != "__line"]
    return _masked(parsed.select(*rest, "__line.*"))


def _masked(logs: DataFrame) -> DataFrame:
    return logs.withColumn("message", mask_sensitive(F.col("message")))


def _run_times(logs: DataFrame, kind: str) -> DataFrame:
    """Finished runs per step or block: a completed or failed line ends one."""
    label = kind.capitalize()
    ended = logs.filter(F.col("message").isin(f"{label} completed", f"{label} failed"))
    elapsed: Column = F.col("elapsed_seconds")
    return ended.groupBy(kind).agg(
        F.count("*").alias("runs"),
        F.count_if(F.col("message") == f"{label} failed").alias("failures"),
        display(F.avg(elapsed), 3).alias("mean_seconds"),
        F.max(elapsed).alias("max_seconds"),
    )


def step_run_times(logs: DataFrame) -> DataFrame:
    return _run_times(logs, "step")


def block_run_times(logs: DataFrame) -> DataFrame:
    return _run_times(logs, "block")
