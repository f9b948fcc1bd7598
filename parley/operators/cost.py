"""Token cost of model calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.rounding import display

# USD per million input and output tokens, and the price of any other model.
PRICES = {
    "gpt-4o": (5.00, 15.00),
    "gpt-4o-mini": (0.15, 0.60),
    "gpt-4-turbo": (10.00, 30.00),
    "gpt-3.5-turbo": (0.50, 1.50),
}
OTHER_PRICE = (0.50, 1.50)


def price_table(spark: SparkSession) -> DataFrame:
    """The built-in prices as a table of (model, input_usd, output_usd)."""
    rows = ", ".join(f"('{m}', {i}D, {o}D)" for m, (i, o) in PRICES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(model, input_usd, output_usd)")


def price_calls(calls: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """Add ``cost_usd`` to every call; models are looked up without case.

    The built-in table has four rows and is broadcast. A given table, with one row per lower-case
    model, is joined as its size asks for.
    """
    table = F.broadcast(price_table(calls.sparkSession)) if prices is None else prices
    priced = table.select(F.col("model").alias("__model"), "input_usd", "output_usd")
    other_in, other_out = OTHER_PRICE
    cost = F.col("prompt_tokens") / 1_000_000 * F.coalesce("input_usd", F.lit(other_in)) + F.col(
        "completion_tokens"
    ) / 1_000_000 * F.coalesce("output_usd", F.lit(other_out))
    return (
        calls.join(priced, F.lower("model") == F.col("__model"), "left")
        .withColumn("cost_usd", cost)
        .drop("__model", "input_usd", "output_usd")
    )


def usage_summary(
    calls: DataFrame, *groups: str, prices: DataFrame | None = None
) -> DataFrame:
    """Calls, tokens and cost per model as written, with subtotals and a grand total.

    ``groups`` may put other columns, such as the session, before the model. The rollup runs over
    the sums per group, not over the calls.
    """
    by = [*groups, "model"]
    sums = (
        price_calls(calls, prices)
        .groupBy(*by)
        .agg(
            F.count("*").alias("calls"),
            F.sum("prompt_tokens").alias("prompt_tokens"),
            F.sum("completion_tokens").alias("completion_tokens"),
            F.sum("cost_usd").alias("cost_usd"),
        )
    )
    totals = sums.rollup(*by).agg(
        *[F.grouping(c).alias(f"{c}_all") for c in by],
        F.sum("calls").alias("calls"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.sum("cost_usd").alias("cost_usd"),
    )
    return totals.select(
        *[F.when(F.col(f"{c}_all") == 1, "ALL").otherwise(F.col(c)).alias(c) for c in by],
        "calls",
        "prompt_tokens",
        "completion_tokens",
        (F.col("prompt_tokens") + F.col("completion_tokens")).alias("total_tokens"),
        display(F.col("cost_usd"), 6).alias("cost_usd"),
    )
