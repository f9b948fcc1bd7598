"""The text guard over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions import text


def flag_injection(df: DataFrame, column: str) -> DataFrame:
    """Add one boolean per pattern family and their disjunction."""
    flags = {
        f"{family}_hit": text.matches_family(F.col(column), family)
        for family in text.INJECTION_FAMILIES
    }
    any_hit = F.col("prompt_hit") | F.col("sql_hit") | F.col("shell_hit")
    return df.withColumns(flags).withColumn("injection", any_hit)


def sanitize(df: DataFrame, column: str) -> DataFrame:
    """Add ``clean`` (null when rejected), ``verdict`` and ``reason``.

    Patterns are looked for before white space is collapsed.
    """
    bare = df.withColumn("__bare", text.strip_control(text.strip(F.col(column))))
    prepared = bare.withColumn("__prepared", text.normalize(F.col("__bare"))).drop("__bare")
    hit = text.contains_injection(F.col("__prepared"))
    # the pattern test comes first: a first condition is always evaluated, so its parts are shared
    reason = F.when(hit, "INJECTION").when(F.col(column).isNull(), "NOT_TEXT")
    return (
        prepared.withColumn("reason", reason)
        .withColumn("verdict", F.when(F.col("reason").isNull(), "OK").otherwise("REJECTED"))
        .withColumn(
            "clean",
            F.when(F.col("reason").isNull(), text.collapse_whitespace(F.col("__prepared"))),
        )
        .drop("__prepared")
    )


def sanitize_filter_values(df: DataFrame, column: str) -> DataFrame:
    """Add ``clean`` (stripped, null when rejected) and ``verdict`` for a filter value."""
    verdict = text.filter_value_verdict(F.col(column))
    return df.withColumn("verdict", verdict).withColumn(
        "clean", F.when(F.col("verdict") == "OK", text.strip(F.col(column)))
    )


def mask(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, text.mask_sensitive(F.col(column)))


def guard_summary(df: DataFrame, column: str, source: str) -> DataFrame:
    """Rows per source, verdict and reason; length problems are looked for before patterns."""
    length = text.question_length_verdict(F.col(column))
    judged = sanitize(df.withColumn("__length", length), column)
    reason = F.when(F.col("__length") != "OK", F.col("__length")).otherwise(
        F.coalesce("reason", F.lit("NONE"))
    )
    verdict = F.when(F.col("reason") == "NONE", "OK").otherwise("REJECTED")
    return (
        judged.select(source, reason.alias("reason"))
        .groupBy(source, verdict.alias("verdict"), "reason")
        .agg(F.count("*").alias("rows"))
    )
