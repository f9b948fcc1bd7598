"""A join that stays balanced when one key holds much of its left input."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on ``keys``, null equal to null, keeping the columns of both sides once.

    Adaptive execution cuts a frequent key of ``left`` into several tasks, provided both inputs come
    straight from a shuffle made for this join. An aggregated input would instead be used as the
    aggregation left it. Null-safe keys are shuffled by expressions of their own, so neither input
    counts as already placed.
    """
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"__{k}" for k in keys])
