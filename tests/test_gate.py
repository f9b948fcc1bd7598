"""Check state added up day by day against reports over all rows."""

from __future__ import annotations

import random

import pytest

from parley.operators import quality, quality_state
from parley.plans import gate
from parley.sources import published
from tests.helpers import clicks, plan_of, sessions, turns


def _results(report):
    return {(r.source, r.check, r.column): r for r in report.collect()}


def made(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        rows.append({
            "session_id": rng.choice(["s1", "s2", "s3", None]), "topic_name": rng.choice(["x", None]),
            "created_at": rng.choice(["bad", None, *[f"2024-01-0{d}T00:00:00" for d in range(1, 5)]]),
            "confidence_score": rng.choice([None, 0.25, 0.5, 1.5]), "application_channel": rng.choice(["Web", "Fax", None]),
            "handle_seconds_dur": rng.choice([1, -1]),
        })
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_added_state_equals_a_full_report(spark, tmp_path, seed):
    rows, rng, path = made(seed), random.Random(seed), str(tmp_path)
    part = [rng.randrange(3) for _ in rows]
    for k in range(3):
        batch = turns(spark, *[r for r, p in zip(rows, part) if p == k])
        if k == 1:  # columns may come in another order
            batch = batch.select(*reversed(batch.columns))
        gate.add_rows(spark, path, batch, quality.CHATBOT_RULES, str(k))
    whole = turns(spark, *rows)
    got = _results(gate.report(spark, path, [quality.CHATBOT_RULES]))
    assert got == _results(quality.quality_report(whole, quality.CHATBOT_RULES))
    # of some days only, and how recent it is
    day = whole.filter("created_at LIKE '2024-01-02%'")
    got = _results(gate.report(spark, path, [quality.CHATBOT_RULES], ["year=2024/month=01/day=02"]))
    assert got == _results(quality.quality_report(day, quality.CHATBOT_RULES))
    stored = gate.stored_state(spark, path, quality.CHATBOT_RULES)
    fresh = quality_state.recency(stored, quality.CHATBOT_RULES, "2024-01-05 00:00:00").collect()
    assert fresh == quality.recency_check(whole, "chatbot_interactions", "2024-01-05 00:00:00").collect()


def test_other_days_are_left_alone_and_a_batch_counts_once(spark, tmp_path):
    path, rules = str(tmp_path), quality.CHATBOT_RULES
    gate.add_rows(spark, path, turns(spark, {"created_at": "2024-01-01T00:00:00"}, {"created_at": "2024-01-02T00:00:00"}), rules, "a")
    before = published.current(spark, f"{path}/{rules.source}")
    late = turns(spark, {"created_at": "2024-01-02T00:00:00"})
    assert gate.add_rows(spark, path, late, rules, "b") == ["year=2024/month=01/day=02"]
    assert gate.add_rows(spark, path, late, rules, "b") == []
    after = published.current(spark, f"{path}/{rules.source}")
    assert {d for d in after.days if after.days[d] != before.days[d]} == {"year=2024/month=01/day=02"}
    found = _results(gate.report(spark, path, [rules]))
    assert found[rules.source, "duplicate_rows", None].observed == 1  # the late row is a copy of a stored one
    assert found[rules.source, "duplicate_keys", "contact_id, session_id"].observed == 1
    assert found[rules.source, "not_empty", None].observed == 3


def test_reports_read_neither_the_source_nor_row_state(spark, tmp_path):
    path, rules = str(tmp_path), quality.CHATBOT_RULES
    gate.add_rows(spark, path, turns(spark, {}), rules)
    for line in plan_of(gate.report(spark, path, [rules])).split("\n"):
        if "FileScan" in line:
            filters = line.split("PartitionFilters")[1]
            assert "kind" in filters and ("= cell" in filters or "= key" in filters)


def test_columns_that_a_batch_lacks(spark, tmp_path):
    rules = quality.CHATBOT_RULES
    gate.add_rows(spark, str(tmp_path), turns(spark, {}), rules)
    lacking = turns(spark, {"session_id": "s2"}).drop("response_type", "confidence_score")
    gate.add_rows(spark, str(tmp_path), lacking, rules)
    found = _results(gate.report(spark, str(tmp_path), [rules]))
    assert found[rules.source, "schema", None].message == "missing columns: confidence_score, response_type"
    assert found[rules.source, "nulls", "confidence_score"].observed == 0.5


def test_gate_stops_on_failed_days_only(spark, tmp_path):
    good = turns(spark, {}), clicks(spark, {}), sessions(spark, {})
    gate.check_batch(spark, str(tmp_path), *good, batch="1")
    bad = turns(spark, {"created_at": "2024-01-11T00:00:00", "handle_seconds_dur": -1})
    with pytest.raises(quality.QualityGateError, match="handle_seconds_dur"):
        gate.check_batch(spark, str(tmp_path), bad, clicks(spark), sessions(spark), batch="2")
    other = turns(spark, {"created_at": "2024-01-12T00:00:00"})
    report = gate.check_batch(spark, str(tmp_path), other, clicks(spark), sessions(spark), batch="3")
    assert {r.source for r in report.collect()} == {"chatbot_interactions"}
    with pytest.raises(quality.QualityGateError):
        gate.check_batch(spark, str(tmp_path), other, clicks(spark), sessions(spark), batch="4", whole=True)
    assert gate.check_batch(spark, str(tmp_path), other, clicks(spark), sessions(spark), batch="4").count() == 0


def test_empty_state_reports_as_an_empty_table(spark, tmp_path):
    gate.add_rows(spark, str(tmp_path), turns(spark), quality.CHATBOT_RULES)
    got = _results(gate.report(spark, str(tmp_path), [quality.CHATBOT_RULES]))
    assert got == _results(quality.quality_report(turns(spark), quality.CHATBOT_RULES))


def test_rows_are_added_up_without_sorting_them(spark):
    """An aggregate over an array sorts all rows; and of equal rows of two batches either may have lacked a column."""
    rules = quality.CHATBOT_RULES
    whole, lacking = turns(spark, {"topic_name": None}), turns(spark, {}).drop("topic_name")
    new = quality_state.row_state(whole, rules).unionByName(quality_state.row_state(lacking, rules))
    added = quality_state.added_rows(new, rules)
    for df in (added, quality_state.day_state(new, rules)):
        assert "SortAggregate" not in plan_of(df) and "ObjectHashAggregate" not in plan_of(df)
    assert [(r.rows, r.missing) for r in added.collect()] == [(2, ["topic_name"])]


def test_the_first_rows_of_a_day_are_not_grouped_again(spark, tmp_path, monkeypatch):
    added, path, rules = [], str(tmp_path), quality.CHATBOT_RULES
    plain = quality_state.added_rows
    monkeypatch.setattr(quality_state, "added_rows", lambda *a: added.append(a) or plain(*a))
    for day in ("01", "02", "02"):
        gate.add_rows(spark, path, turns(spark, {"created_at": f"2024-01-{day}T00:00:00"}), rules)
    assert len(added) == 1
    assert _results(gate.report(spark, path, [rules]))[rules.source, "duplicate_rows", None].observed == 1


def test_batches_of_the_query_are_not_derived_anew(spark, tmp_path, monkeypatch):
    from catalog import queries

    plans, plain = [], gate.add_rows
    monkeypatch.setattr(gate, "add_rows", lambda s, p, df, *a: plans.append(plan_of(df)) or plain(s, p, df, *a))
    queries.j9_quality_report_from_days(spark, "/root/testdata/sf0.001")
    assert len(plans) == 6 and not any("regexp_extract" in p or "Aggregate" in p for p in plans)
