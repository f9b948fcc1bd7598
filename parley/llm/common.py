"""What several operators share: word columns, written tables, running totals over hot groups."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parley.session import clear_scratch, scratch_folder, scratch_folders

#: The bytes that part words, as the contracts state them.
SPACE = r"\x20\x09-\x0D"
SPACES = " \t\n\x0b\x0c\r"
WORD = f"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` stored in the shared scratch folder and read back: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``build`` gives, stored; the tables that it stored on the way are removed."""
    before = set(scratch_folders(spark))
    result = written(build(), label)
    made = [folder for folder in scratch_folders(spark) if folder not in before]
    clear_scratch(spark, made[:-1])
    return result


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of finished jobs, which it does when the driver collects
    garbage; a driver with little to do may not for hours, while executor disks fill up."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in smaller ones, so that few long texts are in memory at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def with_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    arrays = [*batch.columns, *columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *columns])


def to_batch(fields: dict[str, pa.DataType], columns: Iterable) -> pa.RecordBatch:
    """Columns of values as a batch; no columns at all make an empty one."""
    given = list(columns) or [[] for _ in fields]
    arrays = [pa.array(column, kind) for column, kind in zip(given, fields.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=list(fields))


def words(text: Column) -> Column:
    """The words of a text in order; an empty array for null, empty or blank text."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(bare != "", F.split(bare, f"[{SPACE}]+")).otherwise(
        F.array().cast("array<string>")
    )


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def n_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns an operator is about to add, however they are spelled."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def running_total(
    df: DataFrame, group: list[str], bucket: str, order: list[str], value: str, name: str
) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the same group that come before.

    Rows are ordered by ``bucket``, then ``order``. A hot group is no single task: its buckets are
    summed first, and only these sums are ordered as a whole. ``df`` is read twice, so it should be a
    stored table; ``group`` and ``bucket`` hold no nulls.
    """
    every, earlier = Window.unboundedPreceding, -1
    keys = [*group, bucket]
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    before = sums.select(
        *keys,
        F.sum("_sum")
        .over(Window.partitionBy(*group).orderBy(bucket).rowsBetween(every, earlier))
        .alias("_before"),
    )
    inner = F.sum(value).over(
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(every, earlier)
    )
    zero = F.lit(0).cast("long")
    return (
        df.withColumn("_inner", inner)
        .join(before, keys)
        .withColumn(name, F.coalesce("_before", zero) + F.coalesce("_inner", zero))
        .drop("_inner", "_before")
    )
