"""What the quality checks know of each day, in a form that days and late rows can be added to.

A day has three kinds of rows, told apart by ``kind``:

* ``row``: a row for each distinct row of the source that day, as keys, three 64-bit hashes of two kinds and what the
  rules say of it, with its number of copies. Read only when more rows of that day come.
* ``cell``: one row with the day's counts, sums, surplus copies, oldest and newest time.
* ``key``: a row for each key, with the number of rows that hold it.

A report adds cells up, and counts keys over days. Copies of a row have the same time, so they meet within a
day, those without a readable time in a day of their own; keys do not. A report therefore reads cells and keys, never the source.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions.casts import as_timestamp
from parley.functions.scores import date_parts
from parley.operators.quality import (
    RuleSet,
    digest,
    duplicate_results,
    recency_result,
    result_rows,
    row_results,
    second_digest,
)
from parley.sources.published import PARTITION_COLUMNS
from parley.sources.schemas import TIME_COLUMN

_ROW = ["keys", "d1", "d2", "check", "bits", "values", "time"]
_LONGS, _STRINGS = T.ArrayType(T.LongType()), T.ArrayType(T.StringType())
SCHEMA = T.StructType(
    [
        T.StructField(name, kind)
        for names, kind in [
            ("keys", _STRINGS), ("d1 d2 check", T.LongType()), ("bits", _LONGS),
            ("values", T.ArrayType(T.DoubleType())), ("time", T.TimestampNTZType()),
            ("rows", T.LongType()), ("counts", _LONGS), ("sums", T.ArrayType(T.DoubleType())),
            ("surplus", T.LongType()), ("missing", _STRINGS), ("oldest newest", T.TimestampNTZType()),
            ("year month day kind", T.StringType()),
        ]
        for name in names.split()
    ]
)


def _columns_of(rules: RuleSet) -> list[str]:
    """All columns that the rules look at; a source that lacks one is taken to hold nulls there."""
    looked_at = [*rules.critical, *rules.keys, *rules.allowed, *[r.column for r in rules.ranges]]
    if rules.check_confidence:
        looked_at.append("confidence_score")
    return list(dict.fromkeys([*rules.required, *looked_at]))


def _measures(rules: RuleSet, missing: Column | None = None):
    return row_results(rules, set(_columns_of(rules)), missing)


def _filled(rows: DataFrame, kind: str) -> DataFrame:
    have = set(rows.columns)
    return rows.withColumn("kind", F.lit(kind)).select(
        *[
            F.col(f.name) if f.name in have or f.name == "kind" else F.lit(None).cast(f.dataType).alias(f.name)
            for f in SCHEMA
        ]
    )


def row_state(df: DataFrame, rules: RuleSet) -> DataFrame:
    """The distinct rows of a source by day, with their copies."""
    missing = [c for c in rules.required if c not in df.columns]
    df = df.withColumns({c: F.lit(None).cast("string") for c in _columns_of(rules) if c not in df.columns})
    columns = sorted(df.columns)  # the order of columns does not tell rows apart
    measures, _ = _measures(rules)
    packed = measures.packed()
    bits = [c for name, c in packed.items() if name.startswith("__b")]
    values = [c for name, c in packed.items() if name.startswith("__v")]
    hashes = digest(columns)
    time = as_timestamp(F.col(TIME_COLUMN[rules.source]).cast("string"))
    found = df.select(
        F.array(*[F.col(c).cast("string") for c in rules.keys]).cast("array<string>").alias("keys"),
        hashes["__d1"].alias("d1"),
        hashes["__d2"].alias("d2"),
        second_digest(columns).alias("check"),
        F.array(*bits).cast("array<long>").alias("bits"),
        F.array(*values).cast("array<double>").alias("values"),
        time.alias("time"),
        *[c.alias(name) for name, c in date_parts(time).items()],
    )
    rows = found.groupBy(*_ROW, *PARTITION_COLUMNS).agg(F.count("*").alias("rows"))
    lacks = F.array(*map(F.lit, sorted(missing))).cast("array<string>")
    return _filled(rows.withColumn("missing", lacks), "row")


def _lacks(rules: RuleSet) -> dict[str, Column]:
    """Which required columns some row lacked. Flags, as an aggregate over arrays would have to sort all rows."""
    return {f"__m{k}": F.bool_or(F.array_contains("missing", c)) for k, c in enumerate(sorted(rules.required))}


def _lacking(rules: RuleSet) -> Column:
    """The names of these columns, from the flags."""
    names = [F.when(F.col(f"__m{k}"), c) for k, c in enumerate(sorted(rules.required))]
    return F.array_compact(F.array(*names)).cast("array<string>").alias("missing")


def added_rows(rows: DataFrame, rules: RuleSet) -> DataFrame:
    """Copies of a row from several batches made one."""
    added = rows.groupBy(*_ROW, *PARTITION_COLUMNS).agg(
        F.sum("rows").alias("rows"), *[c.alias(name) for name, c in _lacks(rules).items()]
    )
    return _filled(added.withColumn("missing", _lacking(rules)), "row")


def day_state(rows: DataFrame, rules: RuleSet) -> DataFrame:
    """The cell and the keys of each day, from all its rows' state."""
    measures, _ = _measures(rules)
    named = rows.withColumns(
        {
            "__copies": F.col("rows"),
            **{f"__b{k}": F.get("bits", F.lit(k)) for k in range(-(-len(measures.conditions) // measures.BITS))},
            **{f"__v{k}": F.get("values", F.lit(k)) for k in range(len(measures.values))},
        }
    )
    cells = named.groupBy(*PARTITION_COLUMNS).agg(
        *measures.over_groups(),
        (F.sum("rows") - F.count("*")).alias("surplus"),
        *[c.alias(name) for name, c in _lacks(rules).items()],
        F.min("time").alias("oldest"),
        F.max("time").alias("newest"),
    )
    counted = [f"c{k}" for k in range(len(measures.conditions))] + [f"n{k}" for k in range(len(measures.values))]
    cells = cells.select(
        *PARTITION_COLUMNS, "surplus", "oldest", "newest",
        F.col("total").alias("rows"),
        F.array(*counted).cast("array<long>").alias("counts"),
        F.array(*[f"s{k}" for k in range(len(measures.values))]).cast("array<double>").alias("sums"),
        _lacking(rules),
    )
    keys = rows.groupBy(*PARTITION_COLUMNS, "keys").agg(F.sum("rows").alias("rows"))
    return _filled(cells, "cell").unionByName(_filled(keys, "key"))


def report(state: DataFrame, rules: RuleSet) -> DataFrame:
    """Every check of a source over the days of ``state``, as ``quality.quality_report`` gives them."""
    missing = F.array_sort("missing")
    measures, results = _measures(rules, missing)
    counted = [f"c{k}" for k in range(len(measures.conditions))] + [f"n{k}" for k in range(len(measures.values))]
    zero = F.lit(0).cast("long")
    cells = state.where("kind = 'cell'").agg(
        F.coalesce(F.sum("rows"), zero).alias("total"),
        F.coalesce(F.sum("surplus"), zero).alias("surplus"),
        *[F.coalesce(F.sum(F.get("counts", F.lit(k))), zero).alias(n) for k, n in enumerate(counted)],
        *[F.sum(F.get("sums", F.lit(k))).alias(f"s{k}") for k in range(len(measures.values))],
        F.array_distinct(F.flatten(F.collect_set("missing"))).alias("missing"),
    )
    held = state.where("kind = 'key'").groupBy("keys").agg(F.sum("rows").alias("rows"))
    several = held.agg(F.count_if(F.col("rows") > 1).alias("repeated"))
    surplus = state.where("kind = 'cell'").agg(
        F.coalesce(F.sum("rows"), zero).alias("total"), F.coalesce(F.sum("surplus"), zero).alias("surplus")
    )
    zeros = F.lit(0).cast("long")
    both = surplus.withColumn("repeated", zeros).unionByName(
        several.withColumns({"total": zeros, "surplus": zeros})
    )
    totals = both.agg(*[F.sum(c).alias(c) for c in ("total", "surplus", "repeated")])
    return result_rows(cells, rules.source, results).unionByName(
        result_rows(totals, rules.source, duplicate_results(rules.keys))
    )


def recency(state: DataFrame, rules: RuleSet, as_of: str, max_age_hours: float = 24.0) -> DataFrame:
    """``quality.recency_check`` from cells."""
    newest = state.where("kind = 'cell'").agg(F.max("newest").alias("newest"))
    return recency_result(newest, rules.source, as_of, max_age_hours)


def together(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)
