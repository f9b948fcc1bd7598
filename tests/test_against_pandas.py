"""KPI and topic figures against pandas on random rows with gaps."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parley.operators import kpis, series, topics
from parley.sources.schemas import BUSINESS_UNITS, CHANNELS, CHATBOT, METADATA, TOPICS


def _holes(rng, values, share=0.1):
    return [None if rng.random() < share else v for v in values]


def _frames(seed: int, n: int = 700):
    rng = np.random.default_rng(seed)
    ints = lambda top: [int(v) for v in rng.integers(0, top, n)]
    decimals = lambda top, places: [round(float(v), places) for v in rng.random(n) * top]
    pick = lambda values: [values[i] for i in rng.integers(0, len(values), n)]
    days = pd.Timestamp("2024-12-02") + pd.to_timedelta(rng.integers(0, 60 * 86400, n), unit="s")
    up = ints(2)
    turns = pd.DataFrame(
        {
            "contact_id": [f"c{i}" for i in ints(50)],
            "session_id": [f"s{i}" for i in ints(50)],
            "topic_name": _holes(rng, pick(TOPICS)),
            "confidence_score": _holes(rng, decimals(1, 4)),
            "response_type": "FAQ",
            "thumbs_up": up,
            "thumbs_down": [0 if u else int(rng.random() < 0.3) for u in up],
            "escalated_to_agent": ints(2),
            "business_unit": pick(BUSINESS_UNITS),
            "application_channel": _holes(rng, pick(CHANNELS)),
            "handle_seconds_dur": ints(900),
            "derived_resolution_score": _holes(rng, decimals(1, 4)),
            "created_at": [d.isoformat() for d in days],
        }
    )
    meta = pd.DataFrame(
        {
            "contact_id": turns["contact_id"],
            "session_id": turns["session_id"],
            "topic_name": _holes(rng, pick(TOPICS)),
            "business_unit": pick(BUSINESS_UNITS),
            "application_channel": pick(CHANNELS),
            "language": "en",
            "num_turns": [v + 1 for v in ints(20)],
            "contained": ints(2),
            "escalated_to_agent": ints(2),
            "csat_score": _holes(rng, [1 + v for v in decimals(4, 1)], 0.5),
            "queue_name": None,
            "session_duration_seconds": ints(5000),
            "confidence_score": decimals(1, 4),
            "derived_resolution_score": decimals(1, 4),
            "session_start": [d.isoformat() for d in days],
        }
    )
    return turns, meta


def _spark(spark, frame, schema):
    rows = [
        tuple(None if v is None or v != v else v for v in row)
        for row in frame[schema.names].astype(object).itertuples(index=False)
    ]
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(params=range(4))
def data(request, spark):
    turns, meta = _frames(request.param)
    return turns, meta, _spark(spark, turns, CHATBOT), _spark(spark, meta, METADATA)


def test_kpi_report(data):
    turns, meta, spark_turns, spark_meta = data
    rated = turns[(turns.thumbs_up == 1) | (turns.thumbs_down == 1)]
    wanted = {
        "total_chatbot_turns": len(turns),
        "escalation_rate_chatbot": round(turns.escalated_to_agent.mean() * 100, 2),
        "avg_confidence_score": round(turns.confidence_score.astype(float).mean(), 4),
        "avg_handle_seconds": round(turns.handle_seconds_dur.mean(), 1),
        "avg_resolution_score": round(turns.derived_resolution_score.astype(float).mean(), 4),
        "thumbs_up_rate": round(rated.thumbs_up.sum() / len(rated) * 100, 2),
        "thumbs_down_rate": round(rated.thumbs_down.sum() / len(rated) * 100, 2),
        "feedback_volume": len(rated),
        "total_sessions": len(meta),
        "containment_rate": round(meta.contained.mean() * 100, 2),
        "escalation_rate_session": round(meta.escalated_to_agent.mean() * 100, 2),
        "avg_turns_per_session": round(meta.num_turns.mean(), 2),
        "avg_session_duration_seconds": round(meta.session_duration_seconds.mean(), 1),
        "avg_csat_score": round(meta.csat_score.dropna().astype(float).mean(), 2),
        "csat_response_rate": round(meta.csat_score.notna().sum() / len(meta) * 100, 2),
    }
    row = kpis.kpi_report(spark_turns, spark_meta).first()
    assert {name: row[name] for name in wanted} == wanted


def test_topics(data):
    turns, meta, spark_turns, spark_meta = data
    grouped = turns.astype({"confidence_score": float, "derived_resolution_score": float}).groupby("topic_name")
    wanted = pd.DataFrame(
        {
            "volume": grouped.size(),
            "escalation_rate_pct": (grouped.escalated_to_agent.sum() / grouped.size() * 100).round(2),
            "thumbs_up_rate_pct": (grouped.thumbs_up.sum() / grouped.size() * 100).round(2),
            "avg_confidence_score": grouped.confidence_score.mean().round(4),
            "avg_resolution_score": grouped.derived_resolution_score.mean().round(4),
            "avg_handle_seconds": grouped.handle_seconds_dur.mean().round(1),
        }
    )
    got = {r.topic_name: r for r in topics.topic_measures(spark_turns).collect()}
    assert set(got) == set(wanted.index)
    for topic, figures in wanted.iterrows():
        assert {n: got[topic][n] for n in wanted.columns} == figures.to_dict(), topic

    means = meta.groupby("topic_name").derived_resolution_score.mean()
    quality = {r.topic_name: r.avg_resolution for r in topics.topic_session_quality(spark_meta).collect()}
    assert quality == means.round(4).to_dict()


def test_weekly_trend(data):
    turns, _, spark_turns, _ = data
    stamps = pd.to_datetime(turns.created_at).dt.isocalendar()
    week = stamps.year * 100 + stamps.week
    before, now = sorted(week.unique())[-2:]
    wanted = {}
    for topic in turns.topic_name.dropna().unique():
        mine = turns.topic_name == topic
        prev, curr = int((mine & (week == before)).sum()), int((mine & (week == now)).sum())
        wanted[topic] = (
            "NEW" if prev == 0 else "TRENDING_UP" if curr > prev * 1.10
            else "TRENDING_DOWN" if curr < prev * 0.90 else "STABLE"
        )
    assert {r.topic_name: r.wow_trend for r in topics.weekly_trend(spark_turns).collect()} == wanted


def test_daily_volume(data):
    turns, _, spark_turns, _ = data
    sparse = turns[pd.to_datetime(turns.created_at).dt.day % 3 == 1]
    counted = sparse.assign(at=pd.to_datetime(sparse.created_at)).set_index("at").resample("D").session_id.count()
    got = series.daily_volume(spark_turns.filter(F.dayofmonth(F.col("created_at").cast("timestamp_ntz")) % 3 == 1))
    assert {str(r.date): r.interactions for r in got.collect()} == {str(d.date()): int(n) for d, n in counted.items()}


def test_headline(data):
    turns, meta, spark_turns, spark_meta = data
    row = kpis.headline_kpis(spark_turns, spark_meta).first()
    wanted = {
        "containment_rate": meta.contained.mean() * 100,
        "escalation_rate": turns.escalated_to_agent.mean() * 100,
        "avg_confidence": turns.confidence_score.astype(float).mean(),
        "avg_resolution": turns.derived_resolution_score.astype(float).mean(),
        "csat_score": meta.csat_score.astype(float).mean(),
    }
    for name, value in wanted.items():
        assert math.isclose(row[name], value, rel_tol=1e-12), name
