"""Rounding of reported figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_GUARD_PLACES = 6


def display(c: Column, places: int) -> Column:
    """Round half to even, after dropping digits that depend on the order of summation.

    The sum of doubles varies in its last digits with how rows are spread over tasks. Without the
    first step a figure on the edge between two roundings could change from run to run.
    """
    return F.bround(F.round(c, places + _GUARD_PLACES), places)
