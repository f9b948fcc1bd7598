"""Data-quality checks: a declarative rule set per source, evaluated into one table of results.

A report reads its source once. Rows are grouped by key, a digest of the whole row and, packed into
numbers, what the rules say about the row; these groups are stored, and everything else follows from
them: the row-level measures, as sums over groups, and the duplicates. So a report with duplicates runs
a job when it is set up; the row-level checks alone do not.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.casts import as_double, as_timestamp
from parley.functions.rounding import display
from parley.operators.joins import spread_join
from parley.session import scratch_folder
from parley.sources.schemas import (
    BUSINESS_UNITS,
    CHANNELS,
    CHATBOT,
    CLICKSTREAM,
    KEYS,
    METADATA,
    TIME_COLUMN,
)

NULL_LIMIT = 0.05
LOW_MEAN_CONFIDENCE = 0.4


@dataclass(frozen=True)
class Range:
    """Allowed numbers of a column; ``None`` leaves an end open."""

    column: str
    low: float | None = None
    high: float | None = None

    def broken(self, value: Column) -> Column | None:
        tests = []
        if self.low is not None:
            tests.append(value < self.low)
        if self.high is not None:
            tests.append(value > self.high)
        return reduce(lambda a, b: a | b, tests) if tests else None

    def __str__(self) -> str:
        low = "-inf" if self.low is None else self.low
        high = "inf" if self.high is None else self.high
        return f"[{low}, {high}]"


@dataclass(frozen=True)
class RuleSet:
    source: str
    required: list[str]
    critical: list[str]
    keys: list[str]
    allowed: dict[str, list[str]] = field(default_factory=dict)
    ranges: list[Range] = field(default_factory=list)
    check_confidence: bool = False
    null_limit: float = NULL_LIMIT


_CATEGORIES = {"business_unit": BUSINESS_UNITS, "application_channel": CHANNELS}

# Which checks each source gets.
CHATBOT_RULES = RuleSet(
    source="chatbot_interactions",
    required=CHATBOT.names,
    critical=["contact_id", "session_id", "confidence_score", "business_unit"],
    keys=KEYS,
    allowed=_CATEGORIES,
    ranges=[Range("handle_seconds_dur", 0), Range("derived_resolution_score", 0.0, 1.0)],
    check_confidence=True,
)
CLICKSTREAM_RULES = RuleSet(
    source="clickstream_events",
    required=CLICKSTREAM.names,
    critical=["contact_id", "session_id", "event_type", "business_unit"],
    keys=KEYS + ["event_type"],
    allowed=_CATEGORIES,
    ranges=[Range("scroll_depth_pct", 0.0, 100.0), Range("time_on_page_seconds", 0)],
)
METADATA_RULES = RuleSet(
    source="conversation_metadata",
    # csat_score and queue_name are optional
    required=[c for c in METADATA.names if c not in ("csat_score", "queue_name")],
    critical=["contact_id", "session_id", "confidence_score", "contained"],
    keys=KEYS,
    allowed=_CATEGORIES,
    ranges=[Range("num_turns", 1), Range("session_duration_seconds", 0)],
    check_confidence=True,
)


def _result(
    check: str,
    column: str | None,
    status: Column,
    observed: Column,
    threshold: str,
    message: Column,
    applies: Column | None = None,
) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).cast("string").alias("column"),
        status.alias("status"),
        observed.cast("double").alias("observed"),
        F.lit(threshold).alias("threshold"),
        message.alias("message"),
        (F.lit(True) if applies is None else applies).alias("applies"),
    )


def _status(bad: Column, otherwise: str) -> Column:
    return F.when(bad, otherwise).otherwise("OK")


def _percent(share: Column, places: int) -> Column:
    pattern = F.lit("0." + "0" * places)
    return F.concat(F.call_function("format_number", share * 100, pattern), F.lit("%"))


def result_rows(one_row: DataFrame, source: str, results: list[Column]) -> DataFrame:
    return (
        one_row.select(F.inline(F.array(*results)))
        .filter("applies")
        .select(F.lit(source).alias("source"), "*")
        .drop("applies")
    )


class Measures:
    """What the rules ask of each row, gathered so that one pass answers all of it.

    A measure is the number of rows that meet a condition, or the mean of a value. Either is made of sums,
    so it can be had from rows, from groups of equal rows, or from sums of parts of the table.
    """

    BITS = 62

    def __init__(self) -> None:
        self.conditions: list[Column] = []
        self.values: list[Column] = []
        self.total = F.col("total")

    def count(self, condition: Column) -> Column:
        self.conditions.append(F.coalesce(condition, F.lit(False)))
        return F.col(f"c{len(self.conditions) - 1}")

    def mean(self, value: Column) -> Column:
        self.values.append(value)
        return F.try_divide(f"s{len(self.values) - 1}", f"n{len(self.values) - 1}")

    def sums(self) -> list[str]:
        """Names of all sums, besides the total."""
        means = [f"{kind}{k}" for k in range(len(self.values)) for kind in "sn"]
        return [f"c{k}" for k in range(len(self.conditions))] + means

    def over_rows(self) -> list[Column]:
        return [
            F.count("*").alias("total"),
            *[F.count_if(c).alias(f"c{k}") for k, c in enumerate(self.conditions)],
            *[F.sum(v).alias(f"s{k}") for k, v in enumerate(self.values)],
            *[F.count(v).alias(f"n{k}") for k, v in enumerate(self.values)],
        ]

    def packed(self) -> dict[str, Column]:
        """The conditions of a row as bits of few numbers, and its values."""
        bits = [F.when(c, 1 << k % self.BITS).otherwise(0) for k, c in enumerate(self.conditions)]
        packs = [bits[at : at + self.BITS] for at in range(0, len(bits), self.BITS)]
        masks = {f"__b{k}": reduce(lambda a, b: a + b, p).cast("long") for k, p in enumerate(packs)}
        return masks | {f"__v{k}": v for k, v in enumerate(self.values)}

    def over_groups(self) -> list[Column]:
        """From groups of rows packed like that, with the number of rows in each."""
        rows = F.col("__copies")
        met = [
            F.col(f"__b{k // self.BITS}").bitwiseAND(1 << k % self.BITS) != 0
            for k in range(len(self.conditions))
        ]
        values = [F.col(f"__v{k}") for k in range(len(self.values))]
        zero = F.lit(0).cast("long")
        return [
            F.coalesce(F.sum(rows), zero).alias("total"),
            *[F.coalesce(F.sum(F.when(c, rows)), zero).alias(f"c{k}") for k, c in enumerate(met)],
            *[F.sum(v * rows).alias(f"s{k}") for k, v in enumerate(values)],
            *[F.coalesce(F.sum(F.when(v.isNotNull(), rows)), zero).alias(f"n{k}") for k, v in enumerate(values)],
        ]


def row_results(
    rules: RuleSet, present: set[str], missing: Column | None = None
) -> tuple[Measures, list[Column]]:
    """The measures of the row-level checks, and their results in terms of the sums."""
    measures = Measures()
    total = measures.total
    missing = missing_columns(rules, present) if missing is None else missing
    results = [_schema_result(rules, missing), _empty_result(total)]

    for column in rules.critical:
        if column in present:
            share = F.try_divide(measures.count(F.col(column).isNull()), total)
            results.append(_null_result(column, share, rules.null_limit, total))

    if rules.check_confidence and "confidence_score" in present:
        score = as_double(F.col("confidence_score"))
        results.append(_range_result(measures, Range("confidence_score", 0.0, 1.0), score))
        results.append(_mean_result(measures.mean(score)))

    for column, allowed in rules.allowed.items():
        if column in present:
            results.append(_category_result(measures, column, allowed))

    for limits in rules.ranges:
        if limits.column in present and limits.broken(F.lit(0)) is not None:
            value = as_double(F.col(limits.column))
            results.append(_range_result(measures, limits, value))

    return measures, results


def row_checks(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Schema, null share, confidence, category and range checks in one aggregation."""
    measures, results = row_results(rules, set(df.columns))
    return result_rows(df.agg(*measures.over_rows()), rules.source, results)


def _schema_result(rules: RuleSet, missing: Column) -> Column:
    """``missing`` is the sorted array of required columns that are not there."""
    text = F.concat(F.lit("missing columns: "), F.array_join(missing, ", "))
    some = F.size(missing) > 0
    return _result(
        "schema", None, _status(some, "FAIL"), F.size(missing), f"{len(rules.required)} columns",
        F.when(some, text).otherwise("all required columns present"),
    )


def missing_columns(rules: RuleSet, present: set[str]) -> Column:
    names = sorted(set(rules.required) - present)
    return F.array(*map(F.lit, names)).cast("array<string>")


def _empty_result(total: Column) -> Column:
    return _result(
        "not_empty", None, _status(total == 0, "FAIL"), total, "> 0 rows",
        F.concat(total.cast("string"), F.lit(" rows")),
    )


def _null_result(column: str, share: Column, limit: float, total: Column) -> Column:
    return _result(
        "nulls", column, _status(share > limit, "FAIL"), display(share, 6), f"<= {limit:.0%}",
        F.concat(_percent(share, 1), F.lit(" of values are null")),
        applies=total > 0,
    )


def _range_result(measures: Measures, limits: Range, value: Column) -> Column:
    outside = measures.count(limits.broken(value))
    return _result(
        "range", limits.column, _status(outside > 0, "FAIL"), outside, str(limits),
        F.concat(outside.cast("string"), F.lit(f" values outside {limits}")),
    )


def _mean_result(mean: Column) -> Column:
    shown = F.coalesce(F.call_function("format_number", mean, F.lit("0.0000")), F.lit("unknown"))
    return _result(
        "mean_confidence", "confidence_score",
        _status(mean < LOW_MEAN_CONFIDENCE, "WARN"), display(mean, 4),
        f">= {LOW_MEAN_CONFIDENCE}", F.concat(F.lit("mean confidence "), shown),
    )


def _category_result(measures: Measures, column: str, allowed: list[str]) -> Column:
    unexpected = measures.count(~F.col(column).isin(allowed))
    return _result(
        "category", column, _status(unexpected > 0, "WARN"), unexpected,
        ", ".join(sorted(allowed)),
        F.concat(unexpected.cast("string"), F.lit(" rows with unexpected values")),
    )


def digest(columns: list[str]) -> dict[str, Column]:
    """128 bits of a row; which columns are null counts as well."""
    cells = [part for c in columns for part in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return {f"__d{seed}": F.xxhash64(F.lit(seed), *cells) for seed in (1, 2)}


def second_digest(columns: list[str]) -> Column:
    """64 bits of a row by another kind of hash."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00")) for c in columns]
    return F.xxhash64(F.md5(F.concat_ws("\x1f", *cells).cast("binary")))


def _grouped(df: DataFrame, keys: list[str], measures: Measures, **more: Column) -> DataFrame:
    """Rows grouped by key, digest, what the rules say of them, and more that follows from the row.

    Copies collapse map-side, so a key or a row that makes up much of the table is reduced before the
    shuffle, and whole rows are never shuffled. Null keys form a group.
    """
    found = {**digest(df.columns), **measures.packed(), **more}
    narrow = df.select(*keys, second_digest(df.columns).alias("__check"), *[c.alias(n) for n, c in found.items()])
    return narrow.groupBy(*keys, *found).agg(
        F.count("*").alias("__copies"), F.min("__check").alias("__low"), F.max("__check").alias("__high")
    )


def _stored(groups: DataFrame) -> DataFrame:
    folder = scratch_folder(groups.sparkSession, "row-groups")
    groups.write.parquet(folder)
    return groups.sparkSession.read.schema(groups.schema).parquet(folder)


def _distinct_among(df: DataFrame, groups: DataFrame) -> DataFrame | None:
    """The number of distinct rows among those whose digests are equal but whose second digests are not,
    or None if there are none. These rows, and no others, are grouped by all their columns."""
    collided = groups.filter("__low <> __high").select("__d1", "__d2").distinct()
    if collided.isEmpty():
        return None
    rows = df.withColumns(digest(df.columns))
    rows = spread_join(rows, collided, ["__d1", "__d2"], "left_semi")
    return rows.groupBy(*df.columns).agg(F.lit(1).alias("__one")).agg(F.count("*").alias("distinct"))


def duplicate_results(keys: list[str]) -> list[Column]:
    total, surplus, repeated = F.col("total"), F.col("surplus"), F.col("repeated")
    share = F.coalesce(F.try_divide(surplus, total), F.lit(0.0))
    results = [
        _result(
            "duplicate_rows", None, _status(surplus > 0, "WARN"), surplus, "0 copies",
            F.concat(
                surplus.cast("string"), F.lit(" surplus copies ("), _percent(share, 2), F.lit(")")
            ),
        )
    ]
    if keys:
        results.append(
            _result(
                "duplicate_keys", ", ".join(keys), _status(repeated > 0, "WARN"), repeated,
                "0 keys", F.concat(repeated.cast("string"), F.lit(" keys held by several rows")),
            )
        )
    return results


def _duplicates(df: DataFrame, groups: DataFrame, rules: RuleSet, keys: list[str]) -> DataFrame:
    """Surplus copies and repeated keys from stored groups.

    A group whose rows agree in both digests is one row and its copies; the others are compared whole.
    """
    others = _distinct_among(df, groups)
    alike = F.col("__low") == F.col("__high")
    if others is not None:  # rows that collide with different ones are counted among these, copies or not
        mixed = groups.filter(~alike).select("__d1", "__d2").distinct().withColumn("__mixed", F.lit(True))
        groups = spread_join(groups, mixed, ["__d1", "__d2"], "left")
        alike = F.col("__mixed").isNull()
    # without keys each group of equal digests stands for itself
    by_key = groups.groupBy(*(keys or ["__d1", "__d2"])).agg(
        F.sum("__copies").alias("__rows"), F.count_if(alike).alias("__single")
    )
    totals = by_key.agg(
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("__single"), F.lit(0)).alias("distinct"),
        F.count_if(F.col("__rows") > 1).alias("repeated"),
    )
    if others is not None:
        totals = totals.unionByName(others, allowMissingColumns=True).agg(
            *[F.sum(c).alias(c) for c in ("total", "distinct", "repeated")]
        )
    surplus = (F.col("total") - F.col("distinct")).alias("surplus")
    return result_rows(totals.select("total", surplus, "repeated"), rules.source, duplicate_results(keys))


def _keys(df: DataFrame, rules: RuleSet) -> list[str]:
    return [c for c in rules.keys if c in df.columns]


def duplicate_checks(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Surplus copies of whole rows, and number of keys held by more than one row.

    Only keys and digests are shuffled, and stored. Rows with equal digests count as copies if a second digest of
    another kind agrees; if not, they are compared whole, so the answer is exact. A job runs when
    the check is set up.
    """
    keys = _keys(df, rules)
    return _duplicates(df, _stored(_grouped(df, keys, Measures())), rules, keys)


def quality_report(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Every check of a source, one row each; the source is read once, by a job at set-up."""
    keys = _keys(df, rules)
    measures, results = row_results(rules, set(df.columns))
    groups = _stored(_grouped(df, keys, measures))
    row_level = result_rows(groups.agg(*measures.over_groups()), rules.source, results)
    return row_level.unionByName(_duplicates(df, groups, rules, keys))


def all_sources_report(turns: DataFrame, clicks: DataFrame, meta: DataFrame) -> DataFrame:
    """Every check of the three sources; the jobs that set the checks up run side by side."""
    sources = [(turns, CHATBOT_RULES), (clicks, CLICKSTREAM_RULES), (meta, METADATA_RULES)]
    with ThreadPoolExecutor(len(sources)) as pool:
        found = list(pool.map(lambda source: quality_report(*source), sources))
    return reduce(DataFrame.unionByName, found)


def gate_summary(report: DataFrame) -> DataFrame:
    """Per source: whether it passed, and how many checks failed or warned."""
    return report.groupBy("source").agg(
        (F.count_if(F.col("status") == "FAIL") == 0).alias("passed"),
        F.count_if(F.col("status") == "FAIL").alias("errors"),
        F.count_if(F.col("status") == "WARN").alias("warnings"),
    )


class QualityGateError(RuntimeError):
    """Raised when a quality report holds a failed check."""


def enforce(report: DataFrame) -> None:
    """Stop the job if any check failed; warnings pass. Reads one small row per rule."""
    failed = report.filter(F.col("status") == "FAIL").select("source", "check", "column", "message")
    found = failed.collect()
    if found:
        lines = [f"[{r.source}] {r.check} {r.column or ''}: {r.message}" for r in found]
        raise QualityGateError("\n".join(lines))


def recency_check(df: DataFrame, source: str, as_of: str, max_age_hours: float = 24.0) -> DataFrame:
    """WARN when the newest event is older than the limit, seen from ``as_of``."""
    newest = df.agg(F.max(as_timestamp(F.col(TIME_COLUMN[source]))).alias("newest"))
    return recency_result(newest, source, as_of, max_age_hours)


def recency_result(newest: DataFrame, source: str, as_of: str, max_age_hours: float) -> DataFrame:
    """The check for a table of one row, the time ``newest``."""
    seconds = F.timestamp_diff("SECOND", F.col("newest"), F.lit(as_of).cast("timestamp_ntz"))
    age = F.round(seconds / 3600, 2)
    stale = F.coalesce(age > max_age_hours, F.lit(True))
    message = F.coalesce(
        F.concat(F.lit("newest event at "), F.col("newest").cast("string")),
        F.lit("no event has a readable time"),
    )
    return result_rows(
        newest, source,
        [_result("recency", TIME_COLUMN[source], _status(stale, "WARN"), age,
                 f"<= {max_age_hours:g} h", message)],
    )


def row_counts(**tables: DataFrame) -> DataFrame:
    """Rows per named table."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("source"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
