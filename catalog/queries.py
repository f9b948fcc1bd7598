"""Registered queries: one per operator, over the given tables or tables derived from them."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.inputs import derived_table, given_table, interactions
from parley.functions import scores, text
from parley.functions.casts import as_timestamp
from parley.functions.prompts import TEMPLATES, get_template
from parley.functions.rounding import display
from parley.operators import (
    annotate,
    clean,
    cost,
    filters,
    guard,
    kpis,
    logs,
    quality,
    reports,
    series,
    set_sketches,
    topic_cells,
    topics,
    unify,
)
from parley.operators.filters import Selection
from parley.plans import gate, increments
from parley.session import scratch_folder
from parley.sources import readers, schemas, writers

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = "2024-02-01T00:00:00"
AS_OF = "2024-02-01 00:00:00"
RETAIL_WEB = Selection(
    business_unit="retail",
    application_channel="WEB",
    start_date="2024-01-05",
    end_date="2024-01-20",
    end_mode="midnight",
)
DASHBOARD = Selection(
    business_unit="Healthcare", start_date="2024-01-03", end_date="2024-01-17", exact=True
)
FULL_WEEKS = Selection(end_date="2024-01-28")

_QUERIES: dict[str, Query] = {}


def _query(run: Query) -> Query:
    _QUERIES[run.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    return derived_table(spark, sf, "chatbot_interactions")


def _clicks(spark: SparkSession, sf: str) -> DataFrame:
    return derived_table(spark, sf, "clickstream_events")


def _meta(spark: SparkSession, sf: str) -> DataFrame:
    return derived_table(spark, sf, "conversation_metadata")


def _unified(spark: SparkSession, sf: str) -> DataFrame:
    return unify.unify(*interactions(spark, sf), run_ts=RUN_TS)


def _turn_time():
    return as_timestamp(F.col("created_at"))


def _session_time():
    return as_timestamp(F.col("session_start"))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Unrounded measures are cut for comparison: their last digits depend on summation order."""
    return df.withColumns({c: display(F.col(c), 4) for c in columns})


def _day_as_text(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("string"))


def _together(label: str, tables: dict[str, DataFrame]) -> DataFrame:
    """All rows of several tables, each with the name of its table."""
    named = [df.withColumn(label, F.lit(name)) for name, df in tables.items()]
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), named)


def _numbered(df: DataFrame, number: Column) -> DataFrame:
    """The rows stored once, each with its number: a part of them is then a plain filter.

    A filter on a hash of derived columns is pushed below them, where it holds every expression once more,
    in code too long to be compiled; and each part would derive all rows anew.
    """
    folder, rows = scratch_folder(df.sparkSession, "numbered"), df.withColumn("__number", number)
    rows.write.parquet(folder)
    return df.sparkSession.read.schema(rows.schema).parquet(folder)


def _with_number(rows: DataFrame, chosen: Column) -> DataFrame:
    return rows.filter(chosen).drop("__number")


def _csv_base(spark: SparkSession, sf: str) -> str:
    base = scratch_folder(spark, "raw-csv")
    for name in schemas.SOURCES:
        writers.write_csv(derived_table(spark, sf, name), f"{base}/{name}.csv")
    return base


# --- scans and sinks ---------------------------------------------------------------------------


@_query
def a1_csv_scan(spark, sf):
    path = scratch_folder(spark, "turns-csv")
    writers.write_csv(_turns(spark, sf), path)
    return readers.read_csv(spark, path, schemas.CHATBOT)


@_query
def a2_load_sources(spark, sf):
    loaded = readers.load_sources(spark, _csv_base(spark, sf))
    return _together("source", dict(zip(schemas.SOURCES, loaded, strict=True)))


@_query
def a3_partitioned_parquet(spark, sf):
    path = scratch_folder(spark, "unified")
    writers.write_unified(_unified(spark, sf), path)
    return _rounded(readers.read_unified(spark, path), "avg_scroll_depth_pct")


@_query
def a3_merged_batch(spark, sf):
    """All rows but some late ones are stored; then a batch with them, and others, is merged twice."""
    path, rows = scratch_folder(spark, "unified"), _unified(spark, sf)
    rows = _numbered(rows, F.pmod(F.xxhash64(*writers.TURN_KEYS), F.lit(10)))
    writers.write_unified(_with_number(rows, F.col("__number") > 1), path)
    for _ in range(2):
        writers.merge_unified(_with_number(rows, F.col("__number") < 4), path)
    return _rounded(readers.read_unified(spark, path), "avg_scroll_depth_pct")


@_query
def a4_parquet_sample(spark, sf):
    path = scratch_folder(spark, "clicks")
    _clicks(spark, sf).write.parquet(path)
    return readers.read_parquet_sample(spark, path, 500)


@_query
def a5_csv_sample(spark, sf):
    path = scratch_folder(spark, "meta-csv")
    writers.write_csv(_meta(spark, sf), path)
    return readers.read_csv_sample(spark, path, schemas.METADATA, 100, schemas.KEYS)


@_query
def a6_json_lines(spark, sf):
    path = scratch_folder(spark, "meta-json")
    writers.write_json_lines(_meta(spark, sf), path)
    lines = spark.read.text(path).withColumn("row", F.from_json("value", schemas.METADATA))
    return lines.select(
        "row.*",
        F.col("value").contains('"csat_score":null').alias("null_csat_kept"),
        F.col("value").contains('"queue_name":null').alias("null_queue_kept"),
    )


@_query
def a7_parsed_timestamps(spark, sf):
    turns, meta = readers.load_timed(spark, _csv_base(spark, sf))
    return _together("kind", {"turn": turns, "session": meta})


@_query
def a8_metrics_document(spark, sf):
    return reports.metrics_document(_turns(spark, sf), _meta(spark, sf), RETAIL_WEB)


@_query
def a8_topics_document(spark, sf):
    return reports.topics_document(
        _turns(spark, sf), _meta(spark, sf), n=10, sort_by="escalation_rate", include_trend=True
    )


@_query
def a9_row_counts(spark, sf):
    turns, clicks, meta = interactions(spark, sf)
    return quality.row_counts(
        chatbot_interactions=turns, clickstream_events=clicks, conversation_metadata=meta
    )


# --- cleaning ----------------------------------------------------------------------------------


@_query
def b1_clean_chatbot(spark, sf):
    return clean.clean_chatbot(_turns(spark, sf))


@_query
def b2_clean_clickstream(spark, sf):
    return clean.clean_clickstream(_clicks(spark, sf))


@_query
def b3_clean_metadata(spark, sf):
    return clean.clean_metadata(_meta(spark, sf))


@_query
def b4_rated_turns(spark, sf):
    return clean.rated_turns(_turns(spark, sf))


@_query
def b5_topic_table_headings(spark, sf):
    return topics.with_headings(topics.topic_table(_turns(spark, sf)))


# --- derived columns ---------------------------------------------------------------------------


def _unified_columns(*names: str) -> Query:
    def run(spark, sf):
        return _unified(spark, sf).select("contact_id", "session_id", "created_at", *names)

    return run


_QUERIES["c1_effective_confidence"] = _unified_columns(
    "confidence_score", "meta_confidence_score", "effective_confidence_score"
)
_QUERIES["c2_resolution_tier"] = _unified_columns("derived_resolution_score", "resolution_tier")
_QUERIES["c3_is_self_served"] = _unified_columns("is_self_served")
_QUERIES["c4_session_quality_score"] = _unified_columns("session_quality_score")
_QUERIES["c5_date_parts"] = _unified_columns("created_at_ts", "year", "month", "day")
_QUERIES["c6_run_stamp"] = _unified_columns("pipeline_run_at")


@_query
def c7_topic_quality_label(spark, sf):
    return topics.topic_session_quality(_meta(spark, sf)).select("topic_name", "resolution_quality")


@_query
def c8_turn_resolution_score(spark, sf):
    turns = _turns(spark, sf)
    return turns.select(*schemas.KEYS, scores.turn_resolution_score().alias("resolution_score"))


@_query
def c9_session_resolution_score(spark, sf):
    meta = _meta(spark, sf)
    return meta.select(*schemas.KEYS, scores.session_resolution_score().alias("resolution_score"))


@_query
def c10_bounce_flag(spark, sf):
    clicks = _clicks(spark, sf)
    return clicks.select(*schemas.KEYS, "event_timestamp", scores.bounce_flag().alias("bounce"))


# --- filters -----------------------------------------------------------------------------------


@_query
def d1_dimension_filter(spark, sf):
    chosen = Selection(business_unit="FINANCIAL services", application_channel="mobile app")
    return filters.by_dimensions(_turns(spark, sf), chosen)


@_query
def d2_midnight_range(spark, sf):
    chosen = Selection(start_date="2024-01-10", end_date="2024-01-12", end_mode="midnight")
    return filters.by_time(_turns(spark, sf), _turn_time(), chosen)


@_query
def d3_whole_day_range(spark, sf):
    return filters.select_rows(_turns(spark, sf), DASHBOARD, _turn_time())


@_query
def d3_whole_day_range_on_unified(spark, sf):
    path = scratch_folder(spark, "unified")
    writers.write_unified(_unified(spark, sf), path)
    days = readers.read_unified(spark, path)
    chosen = filters.select_rows(days, DASHBOARD, F.col("created_at_ts"))
    return kpis.turn_kpis(chosen, "application_channel")


@_query
def d3_unpadded_range_on_unified(spark, sf):
    path = scratch_folder(spark, "unified")
    writers.write_unified(_unified(spark, sf), path)
    chosen = Selection(start_date="2024-1-5", end_date="2024-1-9T08:00:00")
    days = filters.select_rows(readers.read_unified(spark, path), chosen, F.col("created_at_ts"))
    return _rounded(days, "avg_scroll_depth_pct")


@_query
def d4_filter_options(spark, sf):
    return filters.filter_options(_turns(spark, sf), _turn_time())


# --- joins -------------------------------------------------------------------------------------


@_query
def e1_latest_metadata(spark, sf):
    return unify.latest_metadata(derived_table(spark, sf, "repeated_metadata"))


@_query
def e1_join_metadata(spark, sf):
    turns, clicks, _ = interactions(spark, sf)
    meta = clean.clean_metadata(derived_table(spark, sf, "repeated_metadata"))
    joined = unify.join_sources(
        clean.clean_chatbot(turns), unify.click_sessions(clean.clean_clickstream(clicks)), meta
    )
    return joined.select(*schemas.KEYS, "created_at", "topic_name", "num_turns", "meta_topic_name")


@_query
def e1_join_metadata_all_copies(spark, sf):
    turns, clicks, _ = interactions(spark, sf)
    meta = clean.clean_metadata(derived_table(spark, sf, "repeated_metadata"))
    joined = unify.join_sources(
        clean.clean_chatbot(turns),
        unify.click_sessions(clean.clean_clickstream(clicks)),
        meta,
        dedupe_metadata=False,
    )
    return joined.select(*schemas.KEYS, "created_at", "topic_name", "num_turns", "meta_topic_name")


@_query
def e2_join_clicks(spark, sf):
    return _unified(spark, sf).select(
        *schemas.KEYS,
        "created_at",
        "click_event_count",
        "bounce_events",
        display(F.col("avg_scroll_depth_pct"), 4).alias("avg_scroll_depth_pct"),
        "total_time_on_page_seconds",
        "unique_pages_visited",
        "unique_event_types",
    )


@_query
def e3_unified_interactions(spark, sf):
    return _rounded(_unified(spark, sf), "avg_scroll_depth_pct")


@_query
def e3_unified_by_increments(spark, sf):
    """The three raw tables arrive in three batches, late rows of each in the later ones."""
    path = scratch_folder(spark, "unified")

    by = (writers.TURN_KEYS, ["event_timestamp", "page_name"], ["session_id"])
    tables = [
        _numbered(df, F.pmod(F.xxhash64(*columns), F.lit(3)))
        for df, columns in zip(interactions(spark, sf), by, strict=True)
    ]
    for number in range(3):
        batch = [
            _with_number(df, F.col("__number") == (number + late) % 3) for late, df in enumerate(tables)
        ]
        increments.merge_batch(spark, path, *batch, RUN_TS, batch=f"batch {number}")
    return _rounded(readers.read_unified(spark, path), "avg_scroll_depth_pct")


@_query
def e4_shared_contacts(spark, sf):
    turns, clicks, _ = interactions(spark, sf)
    return unify.shared_contacts(turns, clicks)


def _share_of_ids(spark: SparkSession, sf: str) -> DataFrame:
    turns, clicks, meta = interactions(spark, sf)
    return set_sketches.daily_sketches(
        chatbot_interactions=turns, clickstream_events=clicks, conversation_metadata=meta
    )


def _near(estimate: str, exact: str) -> Column:
    """Whether an estimate is within four standard errors, which are 0 where sketches hold all ids."""
    return F.abs(F.col(estimate) - F.col(exact)) <= 4 * F.col("standard_error") * F.col(exact)


@_query
def e4_shared_contacts_by_sketch(spark, sf):
    """The exact number of shared contacts, and whether the one from daily sketches is as near as stated."""
    turns, clicks, _ = interactions(spark, sf)
    shared = unify.shared_contacts(turns, clicks).agg(F.count("*").alias("shared_contacts"))
    found = set_sketches.overlap(_share_of_ids(spark, sf), "chatbot_interactions", "clickstream_events")
    rows = found.withColumn("shared_contacts", shared.scalar())
    return rows.select("shared_contacts", _near("both", "shared_contacts").alias("sketch_is_near"))


@_query
def e5_metadata_coverage_by_sketch(spark, sf):
    turns, _, meta = interactions(spark, sf)
    exact = unify.metadata_coverage(turns, meta).select("with_metadata")
    found = set_sketches.coverage(_share_of_ids(spark, sf))
    rows = found.withColumn("with_metadata", exact.scalar())
    return rows.select("with_metadata", _near("known", "with_metadata").alias("sketch_is_near"))


@_query
def e5_metadata_coverage(spark, sf):
    return unify.metadata_coverage(_turns(spark, sf), _meta(spark, sf))


# --- aggregates --------------------------------------------------------------------------------


@_query
def f1_click_sessions(spark, sf):
    summary = unify.click_sessions(clean.clean_clickstream(_clicks(spark, sf)))
    return _rounded(summary, "avg_scroll_depth_pct")


@_query
def f2_turn_kpis(spark, sf):
    return kpis.turn_kpis(_turns(spark, sf), "business_unit")


@_query
def f3_feedback(spark, sf):
    return kpis.feedback_kpis(_turns(spark, sf), "application_channel")


@_query
def f4_session_kpis(spark, sf):
    return kpis.session_kpis(_meta(spark, sf), "business_unit")


@_query
def f5_csat(spark, sf):
    return kpis.csat_kpis(_meta(spark, sf), "application_channel")


@_query
def f6_kpi_report(spark, sf):
    return kpis.kpi_report(_turns(spark, sf), _meta(spark, sf), RETAIL_WEB)


@_query
def f6_kpi_report_no_data(spark, sf):
    return kpis.kpi_report(_turns(spark, sf), _meta(spark, sf), Selection(business_unit="Mining"))


@_query
def f7_kpi_cube(spark, sf):
    return kpis.kpi_cube(_turns(spark, sf), _meta(spark, sf))


@_query
def f7_report_from_daily_cells(spark, sf):
    return kpis.report_from_cells(kpis.daily_cells(_turns(spark, sf), _meta(spark, sf)), DASHBOARD)


@_query
def f8_topic_measures(spark, sf):
    return topics.topic_measures(_turns(spark, sf))


@_query
def f8_topic_measures_by_unit_and_channel(spark, sf):
    return topics.topic_measures(_turns(spark, sf), "business_unit", "application_channel")


@_query
def f9_topic_session_quality(spark, sf):
    return topics.topic_session_quality(_meta(spark, sf))


@_query
def f10_topic_table(spark, sf):
    return topics.topic_table(_turns(spark, sf))


@_query
def f11_escalation_by_topic(spark, sf):
    return _rounded(topics.escalation_by_topic(_turns(spark, sf)), "escalation_rate")


def _topic_cells(spark: SparkSession, sf: str) -> DataFrame:
    return topic_cells.topic_cells(_turns(spark, sf), _meta(spark, sf))


@_query
def f8_topic_measures_from_cells(spark, sf):
    return topic_cells.topic_measures(_topic_cells(spark, sf), "business_unit", "application_channel")


@_query
def f9_topic_session_quality_from_cells(spark, sf):
    return topic_cells.topic_session_quality(_topic_cells(spark, sf))


@_query
def f10_topic_table_from_cells(spark, sf):
    return topic_cells.topic_table(_topic_cells(spark, sf))


@_query
def f11_escalation_from_cells(spark, sf):
    return _rounded(topic_cells.escalation_by_topic(_topic_cells(spark, sf)), "escalation_rate")


@_query
def g2_trending_topics_from_cells(spark, sf):
    return topic_cells.trending_topics(_topic_cells(spark, sf), n=5, include_trend=True)


@_query
def g3_weekly_trend_full_weeks_from_cells(spark, sf):
    return topic_cells.weekly_trend(_topic_cells(spark, sf), FULL_WEEKS)


@_query
def f12_daily_volume(spark, sf):
    return _day_as_text(series.daily_volume(_turns(spark, sf)), "date")


@_query
def f13_volume_by_channel(spark, sf):
    return series.volume_by_channel(_turns(spark, sf))


@_query
def f14_resolution_histogram(spark, sf):
    return series.resolution_histogram(_turns(spark, sf))


@_query
def f15_headline_kpis(spark, sf):
    figures = kpis.headline_kpis(
        filters.select_rows(_turns(spark, sf), DASHBOARD, _turn_time()),
        filters.select_rows(_meta(spark, sf), DASHBOARD, _session_time()),
    )
    return _rounded(figures, *figures.columns)


@_query
def f16_thumbs_split(spark, sf):
    return _rounded(kpis.thumbs_split(_turns(spark, sf)), "percent")


@_query
def f17_daily_escalation(spark, sf):
    daily = series.daily_escalation(_turns(spark, sf))
    return _day_as_text(_rounded(daily, "escalation_rate"), "date")


@_query
def f18_volume_by_unit(spark, sf):
    return series.volume_by_unit(_turns(spark, sf))


# --- rankings, trend, set operations -----------------------------------------------------------


def _top_by(sort_by: str) -> Query:
    def run(spark, sf):
        return topics.top_topics(topics.topic_measures(_turns(spark, sf)), 4, sort_by)

    return run


for _name in topics.SORT_COLUMNS:
    _QUERIES[f"g1_top_by_{_name}"] = _top_by(_name)


@_query
def g2_trending_topics(spark, sf):
    return topics.trending_topics(
        _turns(spark, sf), _meta(spark, sf), n=5, include_trend=True
    )


@_query
def g3_weekly_trend(spark, sf):
    return topics.weekly_trend(_turns(spark, sf))


@_query
def g3_weekly_trend_full_weeks(spark, sf):
    return topics.weekly_trend(
        filters.select_rows(_turns(spark, sf), FULL_WEEKS, _turn_time())
    )


@_query
def g4_distinct_rows(spark, sf):
    return _turns(spark, sf).distinct()


# --- data quality ------------------------------------------------------------------------------


def _chatbot_checks(checks: Callable, *names: str) -> Query:
    def run(spark, sf):
        report = checks(_turns(spark, sf), quality.CHATBOT_RULES)
        return report.filter(F.col("check").isin(*names))

    return run


@_query
def j1_schema_check(spark, sf):
    lacking = _turns(spark, sf).drop("response_type", "created_at")
    report = quality.row_checks(lacking, quality.CHATBOT_RULES)
    return report.filter(F.col("check").isin("schema", "not_empty"))


_QUERIES["j2_null_share"] = _chatbot_checks(quality.row_checks, "nulls", "not_empty")


@_query
def j3_confidence_range(spark, sf):
    report = quality.row_checks(_turns(spark, sf), quality.CHATBOT_RULES)
    return report.filter((F.col("check") == "range") & (F.col("column") == "confidence_score"))


@_query
def j4_mean_confidence(spark, sf):
    report = quality.row_checks(_meta(spark, sf), quality.METADATA_RULES)
    return report.filter(F.col("check") == "mean_confidence")


_QUERIES["j5_duplicate_rows"] = _chatbot_checks(quality.duplicate_checks, "duplicate_rows")


@_query
def j6_duplicate_keys(spark, sf):
    clicks, meta = _clicks(spark, sf), derived_table(spark, sf, "repeated_metadata")
    report = quality.duplicate_checks(clicks, quality.CLICKSTREAM_RULES).unionByName(
        quality.duplicate_checks(meta, quality.METADATA_RULES)
    )
    return report.filter(F.col("check") == "duplicate_keys")


_QUERIES["j7_unexpected_categories"] = _chatbot_checks(quality.row_checks, "category")


@_query
def j8_numeric_ranges(spark, sf):
    report = quality.row_checks(_turns(spark, sf), quality.CHATBOT_RULES).unionByName(
        quality.row_checks(_clicks(spark, sf), quality.CLICKSTREAM_RULES)
    )
    return report.filter(F.col("check") == "range")


@_query
def j9_quality_report(spark, sf):
    return quality.all_sources_report(*interactions(spark, sf))


@_query
def j9_quality_report_from_days(spark, sf):
    """Every source is added to its check state in two batches that share days; the report reads the state."""
    path = scratch_folder(spark, "gate")
    for df, rules in zip(interactions(spark, sf), gate.SOURCE_RULES, strict=True):
        rows = _numbered(df, F.pmod(F.xxhash64(*df.columns), F.lit(2)))
        for k in range(2):
            batch = _with_number(rows, F.col("__number") == k)
            gate.add_rows(spark, path, batch, rules, f"batch {k}")
    return gate.report(spark, path)


@_query
def j10_quality_gate(spark, sf):
    return quality.gate_summary(quality.all_sources_report(*interactions(spark, sf)))


@_query
def j11_recency(spark, sf):
    turns, clicks, meta = interactions(spark, sf)
    return (
        quality.recency_check(turns, "chatbot_interactions", AS_OF)
        .unionByName(quality.recency_check(clicks, "clickstream_events", AS_OF))
        .unionByName(quality.recency_check(meta, "conversation_metadata", AS_OF, 48))
    )


# --- text guard and masking --------------------------------------------------------------------


def _texts(name: str, key: list[str]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: given_table(spark, sf, name).select(*key, "text")


_documents = _texts("documents", ["doc_id"])
_conversations = _texts("conversations", ["conv_id", "turn"])


@_query
def k1_strip_control(spark, sf):
    return _documents(spark, sf).select("doc_id", text.strip_control(F.col("text")).alias("clean"))


@_query
def k2_normalize(spark, sf):
    return _documents(spark, sf).select("doc_id", text.normalize(F.col("text")).alias("clean"))


@_query
def k3_injection_documents(spark, sf):
    return guard.flag_injection(_documents(spark, sf), "text").drop("text")


@_query
def k3_injection_conversations(spark, sf):
    return guard.flag_injection(_conversations(spark, sf), "text").drop("text")


@_query
def k4_question_length(spark, sf):
    verdict = text.question_length_verdict(F.col("text")).alias("verdict")
    return _conversations(spark, sf).select("conv_id", "turn", verdict)


@_query
def k5_collapse_whitespace(spark, sf):
    clean_text = text.collapse_whitespace(F.col("text")).alias("clean")
    return _documents(spark, sf).select("doc_id", clean_text)


@_query
def k6_sanitize_documents(spark, sf):
    return guard.sanitize(_documents(spark, sf), "text").drop("text")


@_query
def k6_sanitize_conversations(spark, sf):
    return guard.sanitize(_conversations(spark, sf), "text").drop("text")


@_query
def k7_filter_values(spark, sf):
    values = _turns(spark, sf).select("topic_name").union(
        given_table(spark, sf, "pages").select("url")
    )
    counted = values.groupBy("topic_name").agg(F.count("*").alias("rows"))
    return guard.sanitize_filter_values(counted, "topic_name")


@_query
def k8_allowed_values(spark, sf):
    counted = (
        _turns(spark, sf)
        .groupBy("business_unit", "application_channel")
        .agg(F.count("*").alias("rows"))
    )
    return counted.withColumns(
        {
            "unit_verdict": text.business_unit_verdict(F.col("business_unit")),
            "channel_verdict": text.channel_verdict(F.col("application_channel")),
        }
    )


@_query
def k9_date_text(spark, sf):
    value = F.regexp_replace(F.substring("created_at", 1, 10), "-31$", "-99")
    counted = _turns(spark, sf).groupBy(value.alias("value")).agg(F.count("*").alias("rows"))
    return counted.withColumns(
        {
            "verdict": text.date_text_verdict(F.col("value")),
            "is_date": text.is_calendar_date(F.col("value")),
        }
    )


@_query
def k10_escape_html(spark, sf):
    pages = given_table(spark, sf, "pages")
    return pages.select("page_id", text.escape_html(F.col("html")).alias("escaped"))


@_query
def k11_mask_sensitive(spark, sf):
    return guard.mask(_documents(spark, sf), "text")


@_query
def k12_guard_summary(spark, sf):
    return guard.guard_summary(given_table(spark, sf, "documents"), "text", "source")


# --- text-model enrichment and cost ------------------------------------------------------------


@_query
def l1_transcripts(spark, sf):
    rows = annotate.with_transcript(_unified(spark, sf))
    return rows.select(*schemas.KEYS, "created_at", "transcript")


@_query
def l2_agent_score_prompts(spark, sf):
    turns = clean.clean_chatbot(_turns(spark, sf)).filter("escalated_to_agent = 1")
    texts = get_template("agent_scoring").render(
        transcript=annotate.transcript(turns),
        handle_seconds=F.col("handle_seconds_dur"),
        business_unit=F.col("business_unit"),
    )
    return turns.select(*schemas.KEYS, "created_at", texts["system"].alias("system"), texts["user"].alias("user"))


@_query
def l2_summary_prompts(spark, sf):
    chats = _conversations(spark, sf)
    first = get_template("summarization", 1).render(transcript=F.col("text"), max_words=40)
    latest = get_template("summarization").render(transcript=F.col("text"), max_words=60)
    return chats.select(
        "conv_id", "turn", first["user"].alias("user_v1"), latest["user"].alias("user_v2")
    )


@_query
def l2_all_templates(spark, sf):
    chats = given_table(spark, sf, "conversations")
    values = {
        "transcript": F.col("text"),
        "conversation": F.col("text"),
        "max_words": 40,
        "topic_list": annotate.TOPIC_LIST,
        "handle_seconds": F.col("turn"),
        "business_unit": F.col("role"),
        "time_period": "January",
        "metrics_json": F.col("text"),
    }

    def filled(template):
        texts = template.render(**{name: values[name] for name in template.variables()})
        return chats.select(
            "conv_id",
            "turn",
            F.lit(template.key).alias("task"),
            F.lit(template.version).alias("version"),
            texts["system"].alias("system"),
            texts["user"].alias("user"),
        )

    return reduce(DataFrame.union, map(filled, TEMPLATES))


@_query
def l3_messages(spark, sf):
    rows = annotate.with_messages(
        _conversations(spark, sf).withColumnRenamed("text", "transcript")
    )
    return rows.select(
        "conv_id",
        "turn",
        F.size("topic_messages").alias("messages"),
        F.col("topic_messages")[0]["role"].alias("first_role"),
        F.col("topic_messages")[0]["content"].alias("first_content"),
        F.col("topic_messages")[1]["role"].alias("second_role"),
        F.col("topic_messages")[1]["content"].alias("second_content"),
    )


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return annotate.parse_replies(
        derived_table(spark, sf, "replies"), "summary_reply", "sentiment_reply", "topic_reply"
    )


@_query
def l4_summary_replies(spark, sf):
    return _parsed(spark, sf).select(
        "event_id", "llm_summary", "llm_core_issue", "llm_outcome", "llm_processing_error"
    )


@_query
def l5_sentiment_replies(spark, sf):
    return _parsed(spark, sf).select(
        "event_id", "llm_sentiment", "llm_sentiment_score", "llm_frustration", "llm_churn_risk"
    )


@_query
def l6_topic_replies(spark, sf):
    return _parsed(spark, sf).select(
        "event_id", "llm_topic", "llm_topic_confidence", "topic_in_list"
    )


def _annotations(rows: DataFrame) -> DataFrame:
    names = [c for c in rows.columns if c.startswith("llm_") and c != "llm_usage"]
    return rows.select(*schemas.KEYS, "created_at", "topic_in_list", *names)


@_query
def l7_annotate(spark, sf):
    return _annotations(annotate.annotate(_unified(spark, sf)))


@_query
def l7_annotate_shared_replies(spark, sf):
    path = scratch_folder(spark, "unified")
    writers.write_unified(_unified(spark, sf), path)
    return _annotations(annotate.annotate(readers.read_unified(spark, path), share_replies=True))


@_query
def l7_resume(spark, sf):
    rows = _unified(spark, sf)
    keys = [*schemas.KEYS, "created_at"]
    done = rows.filter(F.col("resolution_tier") == "HIGH")
    return annotate.not_yet_annotated(rows, done, keys).select(*keys, "resolution_tier")


@_query
def l7_resume_retries_failures(spark, sf):
    """Of the rows done before, those with a failed call come back."""
    keys = [*schemas.KEYS, "created_at"]
    rows = _unified(spark, sf)
    failed = F.when(F.col("thumbs_up") == 1, "timeout").alias("llm_sentiment_call_error")
    done = rows.filter(F.col("resolution_tier") == "HIGH").select(*keys, failed)
    return annotate.not_yet_annotated(rows, done, keys).select(*keys, "resolution_tier", "thumbs_up")


@_query
def l8_call_cost(spark, sf):
    priced = cost.price_calls(derived_table(spark, sf, "model_calls"))
    return priced.select("call_id", "model", display(F.col("cost_usd"), 6).alias("cost_usd"))


@_query
def l9_usage_by_model(spark, sf):
    return cost.usage_summary(derived_table(spark, sf, "model_calls"))


@_query
def l9_usage_of_annotation(spark, sf):
    annotated = annotate.annotate(_unified(spark, sf))
    calls = annotate.usage_calls(annotated, "gpt-4o-mini", "application_channel")
    return cost.usage_summary(calls, "application_channel")


@_query
def l9_usage_by_session(spark, sf):
    return cost.usage_summary(derived_table(spark, sf, "model_calls"), "session_id")


@_query
def l10_insight_prompt(spark, sf):
    rows = reports.insight_messages(_turns(spark, sf), _meta(spark, sf), "January 2024")
    return rows.select(
        "document",
        F.col("messages")[0]["content"].alias("system"),
        F.col("messages")[1]["content"].alias("user"),
    )


# --- logs --------------------------------------------------------------------------------------


def _logs(spark: SparkSession, sf: str) -> DataFrame:
    records = derived_table(spark, sf, "log_records")
    fields = [c for c in records.columns if c != "event_id"]
    lines = records.select("event_id", F.to_json(F.struct(*fields)).alias("line"))
    return logs.parse_log_lines(lines, "line")


@_query
def n1_masked_log_lines(spark, sf):
    return _logs(spark, sf)


@_query
def n1_read_log_files(spark, sf):
    path = scratch_folder(spark, "logs")
    writers.write_json_lines(derived_table(spark, sf, "log_records").drop("event_id"), path)
    return logs.read_logs(spark, path)


@_query
def n2_step_run_times(spark, sf):
    return logs.step_run_times(_logs(spark, sf))


@_query
def n3_block_run_times(spark, sf):
    return logs.block_run_times(_logs(spark, sf))
