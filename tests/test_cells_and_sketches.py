"""Topic reports from daily cells against reports over rows; sketches against exact counts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from parley.functions.casts import as_timestamp
from parley.operators import set_sketches, topic_cells, topics, unify
from parley.operators.filters import Selection, select_rows
from tests.helpers import clicks, plan_of, sessions, turns

CHOSEN = [
    None,
    Selection(start_date="2024-01-02", end_date="2024-01-09"),
    Selection(business_unit="retail", end_date="2024-01-12"),
    Selection(application_channel="Kiosk", exact=True),
    Selection(start_date="2030-01-01"),
]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    t = [{
        "topic_name": rng.choice(["a", "b", "c", None]), "business_unit": rng.choice(["Retail", "Travel", None]),
        "application_channel": rng.choice(["Web", "Kiosk"]), "confidence_score": rng.choice([None, 0.1, 0.7]),
        "thumbs_up": rng.choice([0, 1, None]), "escalated_to_agent": rng.choice([0, 1]),
        "handle_seconds_dur": rng.choice([None, 5, 30]), "session_id": rng.choice([None, *"stuvw"]),
        "created_at": rng.choice(["bad", *[f"2024-01-{d:02}T{h:02}:00:00" for d in range(1, 15) for h in (0, 23)]]),
    } for _ in range(300)]
    m = [{
        "topic_name": rng.choice(["a", "b", "z", None]), "business_unit": rng.choice(["Retail", "Travel"]),
        "derived_resolution_score": rng.choice([None, 0.2, 0.9]),
        "session_start": rng.choice([None, *[f"2024-01-{d:02}T00:00:00" for d in range(1, 15)]]),
    } for _ in range(80)]
    return turns(spark, *t).cache(), sessions(spark, *m).cache()


@pytest.fixture(scope="module")
def cells(tables):
    return topic_cells.topic_cells(*tables).cache()


def same(got, want):
    assert got.columns == want.columns
    key = lambda r: [str(v) for v in r]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


@pytest.mark.parametrize("selection", CHOSEN)
def test_reports_from_cells_equal_reports_over_rows(tables, cells, selection):
    t = select_rows(tables[0], selection, as_timestamp(F.col("created_at")))
    m = select_rows(tables[1], selection, as_timestamp(F.col("session_start")))
    same(topic_cells.topic_measures(cells, selection=selection), topics.topic_measures(t))
    by = ("business_unit", "application_channel")
    same(topic_cells.topic_measures(cells, *by, selection=selection), topics.topic_measures(t, *by))
    same(topic_cells.topic_session_quality(cells, selection), topics.topic_session_quality(m))
    same(topic_cells.topic_table(cells, selection), topics.topic_table(t))
    same(topic_cells.escalation_by_topic(cells, 2, selection), topics.escalation_by_topic(t, 2))
    same(topic_cells.weekly_trend(cells, selection), topics.weekly_trend(t))
    for sort_by in topics.SORT_COLUMNS:
        same(
            topic_cells.trending_topics(cells, 3, sort_by, include_trend=True, selection=selection),
            topics.trending_topics(t, m, 3, sort_by, include_trend=True),
        )


def test_cells_of_days_kept_apart_add_up(tables, cells):
    """Cells made from each day's rows are those made from all rows."""
    t, m = tables
    early = F.coalesce(as_timestamp(F.col("created_at")) < "2024-01-08", F.lit(False))
    start = F.coalesce(as_timestamp(F.col("session_start")) < "2024-01-08", F.lit(False))
    parts = topic_cells.topic_cells(t.filter(early), m.filter(start)).unionByName(
        topic_cells.topic_cells(t.filter(~early), m.filter(~start))
    )
    same(topic_cells.trending_topics(parts, include_trend=True), topic_cells.trending_topics(cells, include_trend=True))
    same(topic_cells.topic_sessions(parts), topic_cells.topic_sessions(cells))


def test_cells_do_not_cut_days(cells):
    for chosen in (Selection(start_date="2024-01-02T05:00"), Selection(end_date="2024-01-02", end_mode="midnight")):
        with pytest.raises(ValueError):
            topic_cells.topic_table(cells, chosen)


def test_distinct_sessions_are_within_the_stated_error(spark):
    n = F.col("id")
    rows = spark.range(120_000).select(
        F.lit("c").alias("contact_id"), (n % 40_000).cast("string").alias("session_id"),
        F.concat(F.lit("t"), (n % 7 == 0).cast("int")).alias("topic_name"), F.lit("u").alias("business_unit"),
        F.lit("ch").alias("application_channel"), F.lit(1).alias("escalated_to_agent"), F.lit(0).alias("thumbs_up"),
        F.lit(0).alias("thumbs_down"), F.lit(0.5).alias("confidence_score"), F.lit(0.5).alias("derived_resolution_score"),
        F.lit(3).alias("handle_seconds_dur"), F.concat(F.lit("2024-01-0"), (1 + n % 9), F.lit("T00:00:00")).alias("created_at"),
    )
    cells = topic_cells.topic_cells(rows, sessions(spark))
    exact = {r.topic_name: r.n for r in rows.groupBy("topic_name").agg(F.count_distinct("session_id").alias("n")).collect()}
    got = {r.topic_name: r for r in topic_cells.topic_sessions(cells).collect()}
    assert set(got) == set(exact)
    for topic, n in exact.items():
        assert got[topic].low <= n <= got[topic].high
        assert abs(got[topic].sessions / n - 1) <= 3 * topic_cells.STANDARD_ERROR


def test_small_sketches_are_exact(spark):
    t = turns(spark, {}, {"session_id": "s2"}, {"contact_id": None}, {"contact_id": "c2", "created_at": "2024-01-11T00:00:00"})
    c = clicks(spark, {"contact_id": "c2"}, {"contact_id": "c9", "event_timestamp": "bad"})
    m = sessions(spark, {}, {"contact_id": "c9"})
    sketches = set_sketches.daily_sketches(chatbot_interactions=t, clickstream_events=c, conversation_metadata=m)
    row = set_sketches.overlap(sketches, "chatbot_interactions", "clickstream_events").first()
    assert tuple(row) == (2, 2, 1, 3, 0.0)
    assert row.both == unify.shared_contacts(t, c).count()
    share, want = set_sketches.coverage(sketches).first(), unify.metadata_coverage(t, m).first()
    assert tuple(share)[:2] == tuple(want)[:2] and round(share.coverage, 4) == want.coverage
    day = Selection(start_date="2024-01-11", end_date="2024-01-11")
    assert tuple(set_sketches.overlap(sketches, "chatbot_interactions", "clickstream_events", selection=day).first())[:4] == (1, 0, 0, 1)
    none = set_sketches.daily_sketches(chatbot_interactions=t.limit(0), conversation_metadata=m.limit(0))
    assert tuple(set_sketches.coverage(none).first())[:3] == (0, 0, None)
    with pytest.raises(ValueError):
        set_sketches.overlap(sketches, "a", "b", ids="rows")


def test_large_sketches_are_within_the_stated_error_and_shuffle_no_ids(spark):
    def ids(low, high, time):
        n = F.col("id")
        return spark.range(low, high, 1, 8).select(
            F.concat(F.lit("c"), n.cast("string")).alias("contact_id"), F.lit("s").alias("session_id"),
            F.concat(F.lit("2024-01-0"), (1 + n % 9), F.lit("T00:00:00")).alias(time),
        )

    t, m = ids(0, 60_000, "created_at"), ids(40_000, 90_000, "session_start")
    sketches = set_sketches.daily_sketches(chatbot_interactions=t, conversation_metadata=m)
    # map-side sketches are merged after the shuffle: rows are never shuffled
    assert "partial_theta" in plan_of(sketches)
    got = set_sketches.overlap(sketches, "chatbot_interactions", "conversation_metadata").first()
    one = 1 / 64
    for value, exact in ((got.in_left, 60_000), (got.in_right, 50_000), (got.any, 90_000)):
        assert abs(value / exact - 1) <= 4 * one
    assert 0 < got.standard_error < 0.05 and abs(got.both / 20_000 - 1) <= 4 * got.standard_error
