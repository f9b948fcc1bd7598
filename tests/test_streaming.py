from __future__ import annotations

from pyspark.sql import functions as F

from parley.operators import kpis
from parley.sources import writers
from parley.sources.readers import with_event_time
from parley.streaming import live
from tests.helpers import turns


def test_stream_equals_batch(spark, tmp_path):
    rows = turns(
        spark,
        {"thumbs_up": 1}, {"escalated_to_agent": 1}, {"business_unit": " Travel "},
        {"created_at": "2024-01-11T10:00:00"}, {"contact_id": None}, {"created_at": "?"},
        {"created_at": "2024-02-20T00:00:00"},
    )
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    writers.write_csv(rows, folder)
    stream = live.windowed_kpis(live.read_turns(spark, folder), "1 day", "1 hour", "business_unit")
    query = live.write_windows(stream, out, str(tmp_path / "checkpoint"))
    assert query.awaitTermination(120)
    got = {(str(r.window_start)[:10], r.business_unit): r for r in spark.read.parquet(out).collect()}
    # the last window stays open
    assert set(got) == {("2024-01-10", "Retail"), ("2024-01-10", "Travel"), ("2024-01-11", "Retail")}

    batch = with_event_time(rows, "chatbot_interactions").filter(
        (F.col("event_time").cast("date") == "2024-01-10") & (F.col("business_unit") == "Retail") & F.col("contact_id").isNotNull()
    )
    wanted = kpis.turn_sums(batch).select(*kpis.figures(kpis.TURN_KPIS + kpis.FEEDBACK_KPIS)).first()
    same = got["2024-01-10", "Retail"]
    assert {n: same[n] for n in wanted.asDict()} == wanted.asDict()
