"""Batches merged one after the other against one pass over all rows, and publishing at once."""

from __future__ import annotations

import pathlib
import random

import pytest
from pyspark.sql import functions as F

from parley.operators import unify
from parley.plans import increments
from parley.plans.jobs import daily_job, unify_job
from parley.sources import published, readers, writers
from parley.sources.schemas import SOURCES
from tests.helpers import clicks, plan_of, sessions, turns

RUN = "2024-02-01T00:00:00"


def rows_of(df):
    """All cells but the time of derivation, averages cut."""
    names = sorted(set(df.columns) - {"pipeline_run_at"})
    cut = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted([tuple(str(cut(r[c])) for c in names) for r in df.collect()])


def made(seed):
    """Rows of the three tables; sessions span days, some are known to one table only."""
    rng = random.Random(seed)
    key = lambda: {"contact_id": f"c{rng.randint(0, 2)}", "session_id": rng.choice(["s1", "s2", "s3", "s4", None])}
    time = lambda: rng.choice(["bad", None, *[f"2024-01-{d:02}T0{h}:00:00" for d in range(1, 6) for h in range(3)]])
    t = [{**key(), "created_at": time(), "thumbs_up": i, "business_unit": rng.choice([" Web ", "x"])} for i in range(40)]
    c = [{**key(), "page_name": rng.choice(["/a", "/b", None]), "event_type": rng.choice("xyz"),
          "scroll_depth_pct": rng.choice([None, 1.5, 70.0]), "is_bounce": rng.choice([0, 1, None])} for _ in range(40)]
    m = [{**key(), "session_start": time(), "csat_score": rng.choice([None, 1.0, 5.0]), "num_turns": i} for i in range(20)]
    return t, c, m


@pytest.mark.parametrize("seed", range(2))
def test_merged_batches_equal_one_pass(spark, tmp_path, seed):
    rng = random.Random(seed)
    tables = made(seed)
    build = (turns, clicks, sessions)
    whole = unify.unify(*[f(spark, *rows) for f, rows in zip(build, tables)], RUN)
    path = str(tmp_path / "t")
    parts = [[[] for _ in range(3)] for _ in tables]
    for rows, part in zip(tables, parts):
        for row in rows:
            part[rng.randrange(3)].append(row)
    for k in range(3):
        batch = [f(spark, *part[k]) for f, part in zip(build, parts)]
        increments.merge_batch(spark, path, *batch, RUN, batch=str(k), repeated="keep")
        if k == 1:
            increments.compact(spark, path)
    assert rows_of(readers.read_unified(spark, path)) == rows_of(whole)
    # a batch that comes again changes nothing, and what is superseded can go
    before = published.current(spark, path)
    assert increments.merge_batch(spark, path, *batch, RUN, batch="2") == before
    published.remove_superseded(spark, path, keep=1)
    assert rows_of(readers.read_unified(spark, path)) == rows_of(whole)
    assert len(list((tmp_path / "t" / "_published").glob("*.json"))) == 1


@pytest.mark.parametrize("order", [(0, 1, 2), (1, 2, 0), (2, 0, 1)])
def test_late_tables_in_any_order(spark, tmp_path, order):
    """Turns, clicks and metadata of a session each come alone."""
    alone = [
        (turns(spark, {}, {"created_at": "2024-01-11T00:00:00"}), clicks(spark), sessions(spark)),
        (turns(spark), clicks(spark, {}, {"page_name": "/b"}), sessions(spark)),
        (turns(spark), clicks(spark), sessions(spark, {"csat_score": 5.0, "language": "en"})),
    ]
    path = str(tmp_path / "t")
    for k in order:
        increments.merge_batch(spark, path, *alone[k], RUN)
    whole = unify.unify(*[b[k] for k, b in enumerate(alone)], RUN)
    assert rows_of(readers.read_unified(spark, path)) == rows_of(whole)
    row = readers.read_unified(spark, path).first()
    assert (row.csat_score, row.language, row.click_event_count, row.unique_pages_visited) == (5.0, "en", 2, 2)


def test_only_days_with_a_change_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    first = turns(spark, {"created_at": "2024-01-05T01:00:00", "session_id": "s5"}, {"created_at": "2024-01-06T01:00:00"})
    increments.merge_batch(spark, path, first, clicks(spark), sessions(spark), RUN)
    before = published.current(spark, path)
    increments.merge_batch(spark, path, turns(spark), clicks(spark, {}), sessions(spark), RUN)
    after = published.current(spark, path)
    changed = {d for d in after.days if after.days[d] != before.days.get(d)}
    assert changed == {"year=2024/month=01/day=06"}
    rows = {r.session_id: r.click_event_count for r in readers.read_unified(spark, path).collect()}
    assert rows == {"s5": None, "s1": 1}


def test_a_turn_sent_again_replaces_or_stays(spark, tmp_path):
    for repeated, want in (("replace", [1]), ("keep", [0, 1])):
        path = str(tmp_path / repeated)
        for thumbs in (0, 1):
            batch = turns(spark, {"thumbs_up": thumbs}), clicks(spark), sessions(spark, {"num_turns": 7})
            increments.merge_batch(spark, path, *batch, RUN, repeated=repeated)
        rows = readers.read_unified(spark, path).collect()
        assert sorted(r.thumbs_up for r in rows) == want and {r.num_turns for r in rows} == {7}
    with pytest.raises(ValueError):
        increments.merge_batch(spark, path, *batch, RUN, repeated="some")


def test_extra_columns_stay_and_missing_ones_are_null(spark, tmp_path):
    path = str(tmp_path / "t")
    increments.merge_batch(spark, path, turns(spark, {}).withColumn("agent", F.lit("bo")), clicks(spark, {}), sessions(spark), RUN)
    more = turns(spark, {"created_at": "2024-01-10T11:00:00"})
    increments.merge_batch(spark, path, more, clicks(spark).drop("page_name"), sessions(spark, {}).drop("language"), RUN)
    rows = {r.created_at[11:13]: r for r in readers.read_unified(spark, path).collect()}
    assert (rows["10"].agent, rows["11"].agent) == ("bo", None)
    assert (rows["10"].num_turns, rows["10"].language, rows["11"].click_event_count) == (3, None, 1)


def test_a_plain_table_is_not_merged_into(spark, tmp_path):
    rows = turns(spark, {}), clicks(spark, {}), sessions(spark, {})
    plain, bare = str(tmp_path / "plain"), str(tmp_path / "bare")
    writers.write_unified(unify.unify(*rows, RUN), plain, plain=True)
    assert list(pathlib.Path(plain).glob("year=2024/month=01/day=10/*.parquet"))
    assert readers.read_unified(spark, plain).first().day == "10"
    writers.write_unified(unify.unify(*rows, RUN), bare)
    for path in (plain, bare):
        with pytest.raises(ValueError):
            increments.merge_batch(spark, path, *rows, RUN)
    with pytest.raises(ValueError):
        writers.write_unified(unify.unify(*rows, RUN), plain, mode="days")


def test_a_job_that_stops_leaves_the_old_answer(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [{"created_at": f"2024-01-{d:02}T00:00:00"} for d in range(1, 8)]
    first = unify.unify(turns(spark, *rows), clicks(spark), sessions(spark), RUN)
    writers.write_unified(first, path)
    want = rows_of(readers.read_unified(spark, path))
    later = first.withColumn("thumbs_up", F.lit(9))
    breaks = F.when(F.col("day") == "05", F.raise_error(F.lit("stop"))).otherwise(F.lit(9)).cast("int")
    for mode in ("full", "days"):
        with pytest.raises(Exception, match="stop"):
            writers.write_unified(first.withColumn("thumbs_up", breaks), path, mode)
        assert rows_of(readers.read_unified(spark, path)) == want
    open_reader = readers.read_unified(spark, path)
    writers.write_unified(later.filter("day < '03'"), path, "days")
    assert rows_of(open_reader) == want  # who has begun to read goes on with what they began with
    got = sorted((r.day, r.thumbs_up) for r in readers.read_unified(spark, path).collect())
    assert got == [(f"0{d}", 9 if d < 3 else 0) for d in range(1, 8)]


def test_two_jobs_that_publish_at_once(spark, tmp_path):
    path = str(tmp_path / "t")
    first = published.publish(spark, path, None, published.Pointer(schema="{}"))
    published.publish(spark, path, first, published.Pointer(schema="{}", days={"x": "a"}))
    with pytest.raises(published.PublishedMeanwhile):
        published.publish(spark, path, first, published.Pointer(schema="{}", days={"x": "b"}))
    assert published.current(spark, path).days == {"x": "a"}
    # a pointer that was not written to its end does not count
    (tmp_path / "t" / "_published" / "00000003.json").write_text('{"number": 3, "sch')
    assert published.current(spark, path).days == {"x": "a"}


def _raw(spark, base, t, c, m):
    for name, df in zip(SOURCES, (turns(spark, *t), clicks(spark, *c), sessions(spark, *m))):
        writers.write_csv(df, f"{base}/{name}.csv")


def test_unify_job_merges_raw_batches(spark, tmp_path):
    out = str(tmp_path / "out")
    _raw(spark, tmp_path / "b1", [], [{}], [{"csat_score": 5.0}])
    _raw(spark, tmp_path / "b2", [{}], [], [])
    _, rows = unify_job(spark, str(tmp_path / "b1"), out, RUN, "merge", "one")
    assert rows == {"chatbot_interactions": 0, "clickstream_events": 1, "conversation_metadata": 1, "unified_interactions": 0}
    for want in (1, 0):
        table, rows = unify_job(spark, str(tmp_path / "b2"), out, RUN, "merge", "two")
        assert rows["chatbot_interactions"] == want and rows["unified_interactions"] == 1
    assert [(r.csat_score, r.language, r.click_event_count) for r in table.collect()] == [(5.0, "en", 1)]


@pytest.mark.parametrize("empty", range(3))
def test_sources_without_rows(spark, tmp_path, empty):
    """Header-only files: rows loaded are counted as none."""
    base = tmp_path / "in"
    _raw(spark, base, [{}], [{}], [{}])
    name, schema = list(SOURCES.items())[empty]
    path = base / f"{name}.csv"
    for file in path.glob("part-*"):
        file.write_text(",".join(schema.names) + "\n")
    for crc in path.glob(".part-*"):
        crc.unlink()
    table, rows = unify_job(spark, str(base), str(tmp_path / "out"), RUN)
    assert rows == {**dict.fromkeys(SOURCES, 1), name: 0, "unified_interactions": int(empty != 0)}
    assert table.count() == int(empty != 0)
    if empty == 0:
        with pytest.raises(Exception, match="not_empty"):
            daily_job(spark, str(base), str(tmp_path / "day"), RUN)


def test_stored_rows_are_read_once_when_they_are_derived_again(spark, tmp_path, monkeypatch):
    """Those of sessions with news and the others take part in one join."""
    path, plans, plain = str(tmp_path / "t"), [], published.write_days
    monkeypatch.setattr(published, "write_days", lambda df, *a: plans.append(plan_of(df)) or plain(df, *a))
    two = turns(spark, {}, {"session_id": "s2"})
    increments.merge_batch(spark, path, two, clicks(spark), sessions(spark), RUN)
    late = turns(spark, {"created_at": "2024-01-10T11:00:00"}), clicks(spark, {}), sessions(spark)
    increments.merge_batch(spark, path, *late, "later")
    assert plans[-1].count("FileScan") == 4  # stored rows, keys of fresh ones that replace some, fresh rows, facts
    rows = {(r.session_id, r.created_at[11:13]): r for r in readers.read_unified(spark, path).collect()}
    got = {k: (r.click_event_count, r.pipeline_run_at) for k, r in rows.items()}
    assert got == {("s1", "10"): (1, "later"), ("s1", "11"): (1, "later"), ("s2", "10"): (None, RUN)}


@pytest.mark.parametrize("query, place, name", [
    ("a3_merged_batch", writers, "merge_unified"), ("e3_unified_by_increments", increments, "merge_batch"),
])
def test_batches_of_the_queries_are_not_derived_anew(spark, monkeypatch, query, place, name):
    from catalog import queries

    found, plain = [], getattr(place, name)
    keep = lambda *a, **b: found.extend(plan_of(x) for x in a if hasattr(x, "_jdf")) or plain(*a, **b)
    monkeypatch.setattr(place, name, keep)
    getattr(queries, query)(spark, "/root/testdata/sf0.001")
    plans = [p for p in found if "FileScan" in p]
    assert plans and not any("Join" in p or "regexp_extract" in p or "Aggregate" in p for p in plans)


def test_a_merged_batch_is_written_where_it_stays(spark, tmp_path, monkeypatch):
    path, written, plain = str(tmp_path / "t"), [], writers.write_days
    first = unify.unify(turns(spark, {}, {"session_id": "s2"}), clicks(spark), sessions(spark), RUN)
    writers.write_unified(first, path)
    monkeypatch.setattr(writers, "write_days", lambda df, *a: written.append(df.count()) or plain(df, *a))
    writers.merge_unified(first.filter("session_id = 's2'").withColumn("thumbs_up", F.lit(5)), path)
    assert written == [1, 1]  # the batch, and the stored row that remains
    got = {r.session_id: r.thumbs_up for r in readers.read_unified(spark, path).collect()}
    assert got == {"s1": 0, "s2": 5}
    writers.merge_unified(first.limit(0), path)
    assert readers.read_unified(spark, path).count() == 2
