from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parley.functions.casts import as_timestamp
from parley.operators import kpis, series
from parley.operators.filters import Selection, by_dimensions, by_time, filter_options, select_rows
from parley.operators.reports import metrics_document
from tests.helpers import sessions, turns

def _ts():
    return as_timestamp(F.col("created_at"))


def test_end_day_modes(spark):
    rows = turns(
        spark, {"created_at": "2024-01-10T00:00:00"}, {"created_at": "2024-01-10T18:00:00"},
        {"created_at": "2024-01-11T00:00:00"}, {"created_at": "never"},
    )
    whole = Selection(start_date="2024-01-10", end_date="2024-01-10")
    cut = Selection(start_date="2024-01-10", end_date="2024-01-10", end_mode="midnight")
    assert by_time(rows, _ts(), whole).count() == 2
    assert by_time(rows, _ts(), cut).count() == 1
    assert by_time(rows, _ts(), Selection()).count() == 4


def test_unknown_end_mode():
    with pytest.raises(ValueError):
        Selection(end_mode="noon")


def test_dimension_filter_case(spark):
    rows = turns(spark, {}, {"business_unit": "RETAIL"}, {"business_unit": None})
    assert by_dimensions(rows, Selection(business_unit="retail")).count() == 2
    assert by_dimensions(rows, Selection(business_unit="Retail", exact=True)).count() == 1
    assert by_dimensions(rows, Selection(business_unit="All", application_channel="All", exact=True)).count() == 3
    assert by_dimensions(rows, Selection(business_unit="All")).count() == 0


def test_filter_options(spark):
    rows = turns(spark, {}, {"business_unit": None, "created_at": "2024-02-01T00:00:00"}, {"application_channel": "IVR"})
    assert [tuple(r) for r in filter_options(rows, _ts()).collect()] == [
        ("application_channel", "IVR"), ("application_channel", "Web"), ("business_unit", "Retail"),
        ("max_date", "2024-02-01"), ("min_date", "2024-01-10"),
    ]


def test_rates_without_any_feedback(spark):
    row = kpis.feedback_kpis(turns(spark, {}, {})).first()
    assert (row.thumbs_up_rate, row.thumbs_down_rate, row.feedback_volume) == (None, None, 0)
    assert kpis.thumbs_split(turns(spark, {})).count() == 0


def test_feedback_is_share_of_rated(spark):
    rows = turns(spark, {"thumbs_up": 1}, {"thumbs_up": 1}, {"thumbs_down": 1}, {}, {})
    row = kpis.feedback_kpis(rows).first()
    assert (row.thumbs_up_rate, row.thumbs_down_rate, row.feedback_volume) == (66.67, 33.33, 3)


def test_missing_thumbs_count_as_zero(spark):
    rows = turns(spark, {"thumbs_up": None, "thumbs_down": 1}, {"thumbs_up": None, "thumbs_down": None})
    row = kpis.feedback_kpis(rows).first()
    assert (row.thumbs_up_rate, row.thumbs_down_rate, row.feedback_volume) == (0.0, 100.0, 1)
    assert {r.feedback: r.percent for r in kpis.thumbs_split(rows).collect()} == {"Thumbs Up": 0.0, "Thumbs Down": 100.0}


def test_unanswered_surveys(spark):
    row = kpis.csat_kpis(sessions(spark, {"csat_score": None})).first()
    assert (row.avg_csat_score, row.csat_response_rate) == (None, 0.0)


def test_report_without_data(spark):
    row = kpis.kpi_report(turns(spark, {}), sessions(spark, {}), Selection(business_unit="x")).first()
    assert row.status == "NO_DATA" and row.total_chatbot_turns == 0 and row.total_sessions == 0
    assert row.escalation_rate_chatbot is None and row.csat_response_rate is None
    doc = metrics_document(turns(spark, {}), sessions(spark, {}), Selection(business_unit="x"))
    assert doc.first().document == '{"error":"No data found for the specified filters."}'


def test_ties_round_half_to_even(spark):
    rows = sessions(spark, *[{"csat_score": 2.0}] * 3, {"csat_score": 2.5})
    assert kpis.csat_kpis(rows).first().avg_csat_score == 2.12


def test_headline_without_sessions(spark):
    row = kpis.headline_kpis(turns(spark, {}), sessions(spark, {}).limit(0)).first()
    assert row.containment_rate == 0.0 and row.csat_score is None and row.avg_confidence == 0.8


def test_cube_cells_equal_reports(spark):
    rows = turns(
        spark, {"thumbs_up": 1}, {"business_unit": "retail", "confidence_score": 0.5},
        {"application_channel": "IVR", "escalated_to_agent": 1}, {"business_unit": "Travel", "thumbs_down": 1},
    )
    meta = sessions(spark, {}, {"business_unit": "Travel", "csat_score": None}, {"application_channel": "Kiosk"})
    cells = kpis.kpi_cube(rows, meta).collect()
    assert len(cells) == 10
    for cell in cells:
        chosen = Selection(
            business_unit=None if cell.business_unit == "ALL" else cell.business_unit,
            application_channel=None if cell.application_channel == "ALL" else cell.application_channel,
        )
        report = kpis.kpi_report(rows, meta, chosen).first()
        for name in kpis.ALL_KPIS:
            assert cell[name] == report[name], (cell, name)


@pytest.mark.parametrize(
    "chosen",
    [
        None,
        Selection(business_unit="RETAIL"),
        Selection(start_date="2024-01-10", end_date="2024-01-10"),
        Selection(application_channel="IVR", end_date="2024-01-11"),
        Selection(business_unit="none"),
    ],
)
def test_report_from_cells(spark, chosen):
    rows = turns(
        spark, {"thumbs_up": 1}, {"created_at": "2024-01-10T23:59:59", "confidence_score": None},
        {"application_channel": "IVR", "created_at": "2024-01-11T00:00:00"}, {"created_at": "?"},
        {"business_unit": "retail", "thumbs_down": 1}, {"business_unit": None},
    )
    meta = sessions(spark, {}, {"session_start": "2024-01-12T00:00:00"}, {"csat_score": None})
    cells = kpis.daily_cells(rows, meta)
    assert kpis.report_from_cells(cells, chosen).first() == kpis.kpi_report(rows, meta, chosen).first()


def test_cells_cannot_cut_a_day(spark):
    cells = kpis.daily_cells(turns(spark, {}), sessions(spark, {}))
    with pytest.raises(ValueError):
        kpis.report_from_cells(cells, Selection(end_date="2024-01-10", end_mode="midnight"))
    with pytest.raises(ValueError):
        kpis.report_from_cells(cells, Selection(start_date="2024-01-10T09:00:00"))


def test_histogram_edges(spark):
    scores = [0.0, 0.04999, 0.05, 0.14999, 0.15, 0.1500001, 0.3, 0.349999999, 0.35, 0.95, 1.0, 1.00001, -0.1]
    rows = turns(spark, *[{"derived_resolution_score": s} for s in scores])
    got = {r.bin: r.turns for r in series.resolution_histogram(rows).collect()}
    assert got == {-1: 1, 0: 2, 1: 1, 2: 1, 3: 2, 6: 2, 7: 1, 19: 2, 20: 1}


def test_stray_date_does_not_fill_centuries(spark):
    days = ["2024-01-01T00:00:00", "2024-01-04T00:00:00", "9999-12-31T00:00:00"]
    got = [(str(r.date), r.interactions) for r in series.daily_volume(turns(spark, *[{"created_at": d} for d in days]), max_gap_days=3660).collect()]
    assert got == [("2024-01-01", 1), ("2024-01-02", 0), ("2024-01-03", 0), ("2024-01-04", 1), ("9999-12-31", 1)]


def test_caller_sets_the_largest_gap(spark):
    rows = turns(spark, *[{"created_at": d} for d in ["2000-01-01T00:00:00", "2024-01-01T00:00:00", "2024-01-04T00:00:00"]])
    volume = [r.interactions for r in series.daily_volume(rows).collect()]
    assert (len(volume), sum(volume)) == (8770, 3)
    rates = [r.escalation_rate for r in series.daily_escalation(rows).collect()]
    assert (len(rates), sum(r is not None for r in rates)) == (8770, 3)
    assert series.daily_volume(rows, max_gap_days=2).count() == 3
    assert series.daily_volume(rows, max_gap_days=3660).count() == 5


def test_selection_applies_to_both_tables(spark):
    chosen = Selection(start_date="2024-01-10", end_date="2024-01-10")
    meta = sessions(spark, {}, {"session_start": "2024-01-11T00:00:00"})
    row = kpis.kpi_report(turns(spark, {}), meta, chosen).first()
    assert (row.total_sessions, row.filter_start_date) == (1, "2024-01-10")
    assert select_rows(meta, None, F.lit(None)).count() == 2
