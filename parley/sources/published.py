"""Folders published at once: day folders of several versions, and one pointer to those that are current.

A version is written beside the others, under a name of its own. Then one small file, the pointer, is
put in place; from then on readers see the new version, all of it. A job that stops before leaves what
readers see as it was. The pointer says for each day which version holds it, so a batch writes the days it
touches and leaves the others where they are.

    <table>/version=<name>/year=2024/month=01/day=05/part-....parquet
    <table>/_extra/<name>/<what>/part-....parquet      further tables published with the days
    <table>/_published/00000007.json                   the pointer; the highest number counts

There is one pointer file per number, made without overwriting: of two jobs that publish at the same
time one fails. A pointer that is not complete is as good as none.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

POINTERS, EXTRA, VERSION = "_published", "_extra", "version"
# The partition columns of the unified table are zero-padded text.
PARTITION_COLUMNS = ["year", "month", "day"]


@dataclass(frozen=True)
class Pointer:
    """What is current: a version for each day, versions of further tables, and names of merged batches."""

    number: int = 0
    schema: str | None = None
    days: dict[str, str] = field(default_factory=dict)
    extra: list[str] = field(default_factory=list)
    batches: list[str] = field(default_factory=list)


class PublishedMeanwhile(RuntimeError):
    """Another job has published since this one read the pointer."""


def _root(path: str) -> str:
    return path.rstrip("/")


def _fs(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, place = _fs(spark, f"{_root(path)}/{POINTERS}")
    if not fs.exists(place):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(place)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _load(spark: SparkSession, path: str, number: int) -> Pointer | None:
    fs, place = _fs(spark, f"{_root(path)}/{POINTERS}/{number:08d}.json")
    stream = fs.open(place)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return Pointer(**json.loads(text))
    except (ValueError, TypeError):  # not written to its end
        return None


def current(spark: SparkSession, path: str) -> Pointer | None:
    """The pointer that counts, or None if nothing has been published here."""
    for number in reversed(_numbers(spark, path)):
        if found := _load(spark, path, number):
            return found
    return None


def new_version() -> str:
    return uuid.uuid4().hex[:16]


def write_days(
    df: DataFrame, path: str, version: str, further: tuple[str, ...] = ()
) -> dict[str, str]:
    """Write ``df`` as a version, which nobody reads yet; the days it holds, each with the version.

    ``further`` names columns by which each day is split up into folders. Rows may be added to a version
    by a further call, as long as it is not published.

    The rebalance hint gathers each day's rows like a repartition by day would, but lets adaptive
    execution cut a large day into several tasks and files instead of one.
    """
    folder = f"{_root(path)}/{VERSION}={version}"
    (
        df.hint("rebalance", *PARTITION_COLUMNS, *further)
        .write.mode("append")
        .option("compression", "snappy")
        .partitionBy(*PARTITION_COLUMNS, *further)
        .parquet(folder)
    )
    fs, place = _fs(df.sparkSession, f"{folder}/{'/'.join(f'{c}=*' for c in PARTITION_COLUMNS)}")
    days = [status.getPath() for status in fs.globStatus(place)]
    return {
        "/".join([d.getParent().getParent().getName(), d.getParent().getName(), d.getName()]): version
        for d in days
    }


def day_names(days: DataFrame) -> list[str]:
    """The folders of a table of distinct days; as many as there are days."""
    none = "__HIVE_DEFAULT_PARTITION__"
    rows = days.select(*PARTITION_COLUMNS).distinct().collect()
    return ["/".join(f"{c}={none if r[c] is None else r[c]}" for c in PARTITION_COLUMNS) for r in rows]


def has_plain_days(spark: SparkSession, path: str) -> bool:
    """Whether day folders lie straight under ``path``."""
    fs, place = _fs(spark, f"{_root(path)}/{PARTITION_COLUMNS[0]}=*")
    return bool(fs.globStatus(place))


def publish(spark: SparkSession, path: str, base: Pointer | None, pointer: Pointer) -> Pointer:
    """Make ``pointer`` the one that counts, provided ``base`` still is."""
    now = _numbers(spark, path)
    if now and now[-1] != (base.number if base else 0) and current(spark, path) != base:
        raise PublishedMeanwhile(path)
    done = replace(pointer, number=(now[-1] if now else 0) + 1)
    fs, place = _fs(spark, f"{_root(path)}/{POINTERS}/{done.number:08d}.json")
    try:
        stream = fs.create(place, False)
    except Exception as error:
        raise PublishedMeanwhile(path) from error
    try:
        stream.write(bytearray(json.dumps(done.__dict__, sort_keys=True).encode()))
    finally:
        stream.close()
    return done


def read_days(
    spark: SparkSession,
    path: str,
    pointer: Pointer,
    schema: T.StructType | None = None,
    days: list[str] | None = None,
) -> DataFrame:
    """The days that the pointer names, or those of ``days`` among them; one scan, pruned by date as any."""
    schema = schema or T.StructType.fromJson(json.loads(pointer.schema))
    chosen = pointer.days if days is None else {d: pointer.days[d] for d in days if d in pointer.days}
    if not chosen:
        return spark.createDataFrame([], schema)
    paths = [f"{_root(path)}/{VERSION}={version}/{day}" for day, version in sorted(chosen.items())]
    rows = spark.read.schema(schema).option("basePath", _root(path)).parquet(*paths)
    return rows.select(*[f"`{c}`" for c in rows.columns if c != VERSION])


def write_extra(df: DataFrame, path: str, version: str, what: str) -> None:
    df.write.parquet(f"{_root(path)}/{EXTRA}/{version}/{what}")


def read_extra(spark: SparkSession, path: str, pointer: Pointer, what: str, schema: T.StructType) -> DataFrame:
    paths = [f"{_root(path)}/{EXTRA}/{version}/{what}" for version in pointer.extra]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def remove_superseded(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove folders that none of the last ``keep`` pointers names, and older pointers.

    What jobs that stopped have left goes too; so no other job may be writing. Readers that began with a
    removed version fail. Returns the folders removed.
    """
    numbers = _numbers(spark, path)
    loaded = [p for n in numbers if (p := _load(spark, path, n))][-max(1, keep) :]
    days = {f"{VERSION}={v}/{day}" for p in loaded for day, v in p.days.items()}
    needed = {*days, *(d.split("/")[0] for d in days), *(f"{EXTRA}/{v}" for p in loaded for v in p.extra)}
    removed = []

    def remove(pattern: str) -> None:
        fs, place = _fs(spark, f"{_root(path)}/{pattern}")
        depth = pattern.count("/") + 1
        for status in fs.globStatus(place) or []:
            name = "/".join(status.getPath().toString().split("/")[-depth:])
            if name not in needed:
                fs.delete(status.getPath(), True)
                removed.append(name)

    if loaded:
        remove(f"{VERSION}=*")
        remove(f"{VERSION}=*/{'/'.join(f'{c}=*' for c in PARTITION_COLUMNS)}")
        remove(f"{EXTRA}/*")
        fs, place = _fs(spark, f"{_root(path)}/{POINTERS}")
        for number in numbers:
            if number < loaded[0].number:
                fs.delete(_fs(spark, f"{_root(path)}/{POINTERS}/{number:08d}.json")[1], False)
    return removed
