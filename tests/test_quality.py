from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parley.operators import quality
from parley.operators.filters import Selection
from parley.plans.dashboard import dashboard_job
from parley.plans.jobs import annotate_job, daily_job, quality_job, unify_job
from parley.sources import writers
from tests.helpers import clicks, plan_of, sessions, turns


def _results(report):
    return {(r.check, r.column): r for r in report.collect()}


def test_clean_table_passes(spark):
    found = _results(quality.quality_report(turns(spark, {}), quality.CHATBOT_RULES))
    assert {r.status for r in found.values()} == {"OK"}
    assert len(found) == 14


def test_fused_equals_one_check_at_a_time(spark):
    rows = turns(
        spark, {}, {}, {"contact_id": None}, {"confidence_score": 1.5}, {"confidence_score": None},
        {"business_unit": " Retail"}, {"application_channel": "Fax"}, {"application_channel": None},
        {"handle_seconds_dur": -1}, {"derived_resolution_score": 1.01},
    )
    found = _results(quality.quality_report(rows, quality.CHATBOT_RULES))
    total = rows.count()
    assert found["nulls", "contact_id"].observed == 0.1
    assert found["nulls", "contact_id"].status == "FAIL"
    assert found["nulls", "session_id"].status == "OK"
    singles = {
        ("range", "confidence_score"): rows.filter("confidence_score < 0 OR confidence_score > 1"),
        ("range", "handle_seconds_dur"): rows.filter("handle_seconds_dur < 0"),
        ("range", "derived_resolution_score"): rows.filter("derived_resolution_score > 1"),
        ("category", "business_unit"): rows.filter(~F.col("business_unit").isin(quality.BUSINESS_UNITS)),
        ("category", "application_channel"): rows.filter(~F.col("application_channel").isin(quality.CHANNELS)),
        ("duplicate_keys", "contact_id, session_id"): rows.groupBy("contact_id", "session_id").count().filter("count > 1"),
    }
    for key, single in singles.items():
        assert found[key].observed == single.count() == 1, key
    assert found["duplicate_rows", None].observed == total - rows.distinct().count() == 1


def test_null_limit_is_exclusive(spark):
    rows = turns(spark, *[{}] * 19, {"confidence_score": None})
    assert _results(quality.row_checks(rows, quality.CHATBOT_RULES))["nulls", "confidence_score"].status == "OK"


def test_empty_table_fails(spark):
    found = _results(quality.quality_report(turns(spark, {}).limit(0), quality.CHATBOT_RULES))
    assert found["not_empty", None].status == "FAIL"
    assert not any(check == "nulls" for check, _ in found)
    assert found["duplicate_rows", None].status == "OK"


def test_missing_columns(spark):
    found = _results(quality.quality_report(turns(spark, {}).drop("business_unit", "created_at"), quality.CHATBOT_RULES))
    assert found["schema", None].message == "missing columns: business_unit, created_at"
    assert ("category", "business_unit") not in found


def test_low_and_unknown_mean(spark):
    low = _results(quality.row_checks(sessions(spark, {"confidence_score": 0.3}), quality.METADATA_RULES))
    assert low["mean_confidence", "confidence_score"].status == "WARN"
    none = _results(quality.row_checks(sessions(spark, {"confidence_score": None}), quality.METADATA_RULES))
    assert none["mean_confidence", "confidence_score"].status == "OK"
    assert none["mean_confidence", "confidence_score"].observed is None


def test_range_without_bounds_is_no_check(spark):
    rules = quality.RuleSet("t", [], [], [], ranges=[quality.Range("handle_seconds_dur")])
    assert ("range", "handle_seconds_dur") not in _results(quality.quality_report(turns(spark, {}), rules))


def test_click_key_holds_event_type(spark):
    rows = clicks(spark, {}, {"event_type": "search"}, {"page_name": "/faq"})
    found = _results(quality.duplicate_checks(rows, quality.CLICKSTREAM_RULES))
    assert found["duplicate_keys", "contact_id, session_id, event_type"].observed == 1


def test_recency(spark):
    rows = turns(spark, {}, {"created_at": "nope"})
    fresh = quality.recency_check(rows, "chatbot_interactions", "2024-01-10 20:00:00").first()
    assert (fresh.status, fresh.observed) == ("OK", 10.0)
    stale = quality.recency_check(rows, "chatbot_interactions", "2024-01-12 20:00:00").first()
    assert stale.status == "WARN"
    unknown = quality.recency_check(rows.filter("created_at = 'nope'"), "chatbot_interactions", "2024-01-12").first()
    assert unknown.status == "WARN" and unknown.observed is None


def _write(spark, base, turn_rows):
    writers.write_csv(turns(spark, *turn_rows), f"{base}/chatbot_interactions.csv")
    writers.write_csv(clicks(spark, {}), f"{base}/clickstream_events.csv")
    writers.write_csv(sessions(spark, {}), f"{base}/conversation_metadata.csv")


def test_gate_lets_warnings_pass(spark, tmp_path):
    _write(spark, tmp_path, [{}, {"application_channel": "Fax"}])
    report = quality_job(spark, str(tmp_path), str(tmp_path / "report"))
    summary = {r.source: r for r in quality.gate_summary(report).collect()}
    assert summary["chatbot_interactions"].passed and summary["chatbot_interactions"].warnings == 2


def test_gate_stops_on_failure(spark, tmp_path):
    _write(spark, tmp_path, [{"confidence_score": 2.0}])
    with pytest.raises(quality.QualityGateError, match="confidence_score"):
        quality_job(spark, str(tmp_path), str(tmp_path / "report"))
    assert spark.read.parquet(str(tmp_path / "report")).filter("status = 'FAIL'").count() == 1


def test_daily_job(spark, tmp_path):
    _write(spark, tmp_path, [{}, {"session_id": "s2", "escalated_to_agent": 1}])
    rows = daily_job(spark, str(tmp_path), str(tmp_path / "out"), "2024-02-01T00:00:00", share_replies=True)
    assert rows["unified_interactions"] == 2
    done = spark.read.json(str(tmp_path / "out" / "annotated")).collect()
    assert {(r.session_id, r.llm_outcome) for r in done} == {("s1", "RESOLVED"), ("s2", "ESCALATED")}


def test_daily_job_stops_at_the_gate(spark, tmp_path):
    _write(spark, tmp_path, [{"handle_seconds_dur": -5}])
    with pytest.raises(quality.QualityGateError):
        daily_job(spark, str(tmp_path), str(tmp_path / "out"), "2024-02-01T00:00:00")
    assert not (tmp_path / "out" / "unified").exists()


def test_unify_and_annotate_jobs(spark, tmp_path):
    bad = {"contact_id": None}
    _write(spark, tmp_path, [{}, {}, {"session_id": "s2"}, {"session_id": "s3", "thumbs_down": 1}, bad])
    unified, rows = unify_job(spark, str(tmp_path), str(tmp_path / "unified"), "2024-02-01T00:00:00")
    assert unified.count() == 4 and unified.first().month == "01"
    assert rows == {
        "chatbot_interactions": 5, "clickstream_events": 1, "conversation_metadata": 1,
        "unified_interactions": 4,
    }
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    annotate_job(spark, str(tmp_path / "unified"), first, limit=2)
    annotate_job(spark, str(tmp_path / "unified"), second, done_paths=[first], concurrency=2)
    assert sorted(r.session_id for r in spark.read.json(first).collect()) == ["s1", "s1", "s2"]
    rest = spark.read.json(second).collect()
    assert [(r.session_id, r.llm_sentiment) for r in rest] == [("s3", "NEGATIVE")]
    third = str(tmp_path / "third")
    annotate_job(spark, str(tmp_path / "unified"), third, done_paths=[first, second])
    assert spark.read.text(third).count() == 0
    with pytest.raises(ValueError):
        annotate_job(spark, str(tmp_path / "unified"), first, done_paths=[first])
    # null fields are written
    assert '"llm_processing_error":null' in spark.read.text(second).first().value


@pytest.mark.parametrize("keep", [True, False])
def test_dashboard_job(spark, tmp_path, keep):
    _write(spark, tmp_path, [{"thumbs_up": 1}, {"created_at": "2024-01-12T09:00:00"}, {"business_unit": "Travel"}])
    chosen = Selection(business_unit="Retail", exact=True, end_date="2024-01-12")
    names = dashboard_job(spark, str(tmp_path), str(tmp_path / "out"), chosen, keep)
    tables = {name: spark.read.parquet(str(tmp_path / "out" / name)).collect() for name in names}
    assert len(names) == 10
    assert [r.interactions for r in sorted(tables["daily_volume"])] == [1, 0, 1]
    assert [r.volume for r in tables["topic_table"]] == [2]
    assert tables["headline"][0].avg_confidence == 0.8
    assert {r.value for r in tables["filter_options"] if r.option == "business_unit"} == {"Retail", "Travel"}


@pytest.mark.parametrize("digest", ["own", "two values", "one value"])
def test_duplicates_are_exact_whatever_the_digest(spark, monkeypatch, digest):
    """Also if the digests of different rows are equal; the second digest tells, and whole rows are compared."""
    forced = {
        "two values": lambda columns: {"__d1": F.col("thumbs_up").cast("long"), "__d2": F.lit(2).cast("long")},
        "one value": lambda columns: {"__d1": F.lit(1).cast("long"), "__d2": F.lit(2).cast("long")},
    }
    if digest in forced:
        monkeypatch.setattr(quality, "digest", forced[digest])
    rows = [{"session_id": str(i % 7), "topic_name": None if i % 3 else "x", "thumbs_up": i % 2} for i in range(60)]
    rows += [{"contact_id": None, "session_id": None}] * 3 + [{"topic_name": None, "business_unit": "Web"}, {"topic_name": "Web", "business_unit": None}]
    df = turns(spark, *rows)
    for check in (quality.duplicate_checks, quality.quality_report):
        found = _results(check(df, quality.CHATBOT_RULES))
        assert found["duplicate_rows", None].observed == df.count() - df.distinct().count()
        keys = df.groupBy("contact_id", "session_id").count().filter("count > 1").count()
        assert found["duplicate_keys", "contact_id, session_id"].observed == keys


def test_a_source_is_read_once_and_whole_rows_are_not_shuffled(spark, monkeypatch, tmp_path):
    turns(spark, {}, {}, {"session_id": "s2"}).write.parquet(str(tmp_path / "turns"))
    df = spark.read.parquet(str(tmp_path / "turns"))
    set_up, stored = [], quality._stored
    monkeypatch.setattr(quality, "_stored", lambda groups: set_up.append(plan_of(groups)) or stored(groups))
    report = quality.quality_report(df, quality.CHATBOT_RULES)
    assert len(set_up) == 1 and set_up[0].count("FileScan") == 1
    exchanges = "".join(x for x in set_up[0].split("\n") if "Exchange" in x)
    assert exchanges and "handle_seconds_dur" not in exchanges
    assert str(tmp_path) not in plan_of(report)
    assert _results(report)["duplicate_rows", None].observed == 1


def test_more_conditions_than_bits(spark, monkeypatch):
    monkeypatch.setattr(quality.Measures, "BITS", 3)
    rows = turns(spark, {"contact_id": None, "handle_seconds_dur": -1}, {"application_channel": "Fax"}, {"application_channel": "Fax"})
    got, want = quality.quality_report(rows, quality.CHATBOT_RULES), quality.row_checks(rows, quality.CHATBOT_RULES)
    assert set(want.collect()) <= set(got.collect())


def test_duplicates_without_keys_or_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    found = _results(quality.duplicate_checks(df, quality.CHATBOT_RULES))
    assert found["duplicate_rows", None].observed == 1
    assert _results(quality.duplicate_checks(df.limit(0), quality.CHATBOT_RULES))["duplicate_rows", None].observed == 0
