from __future__ import annotations

import json

import pytest

from parley.operators import reports, series, topics
from parley.operators.filters import Selection
from tests.helpers import plan_of, sessions, turns


def _volume(topic, day, n):
    return [{"topic_name": topic, "created_at": f"{day}T08:00:00"}] * n


def _labels(df):
    return {r.topic_name: r.wow_trend for r in df.collect()}


def test_trend_edges(spark):
    before, now = "2024-01-10", "2024-01-17"
    rows = turns(
        spark,
        *_volume("same up", before, 10), *_volume("same up", now, 11),
        *_volume("same down", before, 10), *_volume("same down", now, 9),
        *_volume("up", before, 10), *_volume("up", now, 12),
        *_volume("down", before, 10), *_volume("down", now, 8),
        *_volume("gone", before, 1), *_volume("new", now, 1), *_volume("old", "2024-01-03", 5),
        *_volume(None, now, 3),
    )
    assert _labels(topics.weekly_trend(rows)) == {
        "same up": "STABLE", "same down": "STABLE", "up": "TRENDING_UP", "down": "TRENDING_DOWN",
        "gone": "TRENDING_DOWN", "new": "NEW", "old": "NEW",
    }


def test_trend_across_new_year(spark):
    # 2024-12-30 lies in the first week of ISO year 2025
    rows = turns(spark, *_volume("a", "2024-12-23", 4), *_volume("a", "2024-12-30", 9))
    row = topics.weekly_trend(rows).first()
    assert (row.previous_volume, row.current_volume, row.wow_trend) == (4, 9, "TRENDING_UP")


def test_trend_shuffles_the_counts_once(spark):
    rows = turns(spark, *_volume("a", "2024-01-03", 4), *_volume("b", "2024-01-10", 9)).repartition(3)
    trend = topics.weekly_trend(rows)
    trend.collect()
    plan = plan_of(trend).split("Initial Plan")[0]
    assert "ReusedExchange" in plan


def test_one_week_is_unknown(spark):
    rows = turns(spark, *_volume("a", "2024-01-10", 4), *_volume("b", "never", 2))
    assert _labels(topics.weekly_trend(rows)) == {"a": "UNKNOWN", "b": "UNKNOWN"}


def test_ties_are_ordered_by_name(spark):
    rows = turns(spark, *_volume("b", "2024-01-10", 2), *_volume("a", "2024-01-10", 2), *_volume("c", "2024-01-10", 3))
    top = topics.top_topics(topics.topic_measures(rows), 2)
    assert [r.topic_name for r in top.collect()] == ["c", "a"]


@pytest.mark.parametrize("n", [0, 11])
def test_top_n_limits(spark, n):
    with pytest.raises(ValueError):
        topics.top_topics(topics.topic_measures(turns(spark, {})), n)


def test_unknown_ranking_uses_volume(spark):
    rows = turns(spark, *_volume("b", "2024-01-10", 1), *_volume("a", "2024-01-10", 2))
    assert topics.top_topics(topics.topic_measures(rows), 1, "mood").first().topic_name == "a"


def test_null_topic_is_no_group(spark):
    assert topics.topic_measures(turns(spark, {"topic_name": None}, {})).count() == 1


@pytest.mark.parametrize(("score", "label"), [(0.65, "HIGH"), (0.64, "MEDIUM"), (0.4, "MEDIUM"), (0.39, "LOW"), (None, "LOW")])
def test_quality_label_edges(spark, score, label):
    meta = sessions(spark, {"derived_resolution_score": score})
    assert topics.topic_session_quality(meta).first().resolution_quality == label


def test_topic_without_sessions(spark):
    out = topics.trending_topics(turns(spark, {"topic_name": "x"}), sessions(spark, {}))
    row = out.first()
    assert row.resolution_quality is None and row.session_count is None


def test_topics_document(spark):
    rows = turns(spark, *_volume("b", "2024-01-10", 1), *_volume("Billing Inquiry", "2024-01-10", 2))
    doc = json.loads(reports.topics_document(rows, sessions(spark, {}), n=2).first().document)
    assert [t["topic"] for t in doc["topics"]] == ["Billing Inquiry", "b"]
    assert doc["summary"]["total_records_in_result"] == 3
    assert doc["summary"]["top_topic_by_volume"] == "Billing Inquiry"
    assert doc["summary"]["filters"] == {"business_unit": "ALL", "application_channel": "ALL"}
    assert "resolution_quality_breakdown" in doc["topics"][0]
    assert "resolution_quality_breakdown" not in doc["topics"][1]


def test_topics_document_without_data(spark):
    doc = reports.topics_document(turns(spark, {}), sessions(spark, {}), selection=Selection(business_unit="x"))
    assert json.loads(doc.first().document) == {"error": "No data found for the specified filters."}


def test_null_mean_handle(spark):
    assert topics.topic_table(turns(spark, {"handle_seconds_dur": None})).first().avg_handle_secs is None


def test_gap_days(spark):
    rows = turns(
        spark, {"escalated_to_agent": 1}, {"session_id": None}, {"created_at": "2024-01-13T00:00:00"}, {"created_at": "?"},
    )
    days = [(str(r.date), r.interactions) for r in series.daily_volume(rows).collect()]
    assert days == [("2024-01-10", 1), ("2024-01-11", 0), ("2024-01-12", 0), ("2024-01-13", 1)]
    rates = [r.escalation_rate for r in series.daily_escalation(rows).collect()]
    assert rates == [50.0, None, None, 0.0]


def test_histogram_edges(spark):
    scores = [0.0, 0.049, 0.05, 0.15, 0.29, 0.3, 0.999, 0.99999, 1.0, None, 1.2, 1e300, -0.01, -1e300]
    bins = series.resolution_histogram(turns(spark, *[{"derived_resolution_score": s} for s in scores]))
    assert {r.bin: r.turns for r in bins.collect()} == {-1: 2, 0: 2, 1: 1, 3: 1, 5: 1, 6: 1, 19: 3, 20: 2}


def test_channel_without_value_is_left_out(spark):
    out = series.volume_by_channel(turns(spark, {}, {"application_channel": None})).collect()
    assert [(r.application_channel, r.volume) for r in out] == [("Web", 1)]
