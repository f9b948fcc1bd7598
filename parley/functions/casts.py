"""Casts that turn bad text into null instead of raising under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_double(c: Column) -> Column:
    number = c.try_cast("double")
    return F.when(~F.isnan(number), number)


def as_int(c: Column) -> Column:
    """Whole part of a number; text such as ``1.0`` counts as a number."""
    return c.try_cast("double").try_cast("int")


def as_timestamp(c: Column) -> Column:
    return c.try_cast("timestamp_ntz")


def cast_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give every column of ``schema`` that ``df`` has its declared type; leave the rest alone."""
    have = {field.name: field.dataType for field in df.schema}
    changes = {}
    for field in schema:
        if field.name not in have or have[field.name] == field.dataType:
            continue
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.IntegerType):
            changes[field.name] = as_int(column)
        elif isinstance(field.dataType, T.DoubleType):
            changes[field.name] = as_double(column)
        else:
            changes[field.name] = column.cast(field.dataType)
    return df.withColumns(changes) if changes else df
