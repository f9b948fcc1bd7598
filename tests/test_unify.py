from __future__ import annotations

import pathlib

import pytest
from pyspark.sql import functions as F

from parley.operators import unify
from parley.operators.annotate import not_yet_annotated
from parley.operators.clean import clean_chatbot, clean_clickstream, clean_metadata
from parley.operators.filters import Selection, by_time
from parley.sources import readers, writers
from tests.helpers import clicks, plan_of, sessions, turns

RUN = "2024-02-01T00:00:00"


def test_turns_are_kept_once(spark):
    meta = sessions(spark, {}, {"session_start": "2024-01-11T00:00:00", "num_turns": 9})
    out = unify.unify(turns(spark, {}, {"session_id": "s2"}), clicks(spark, {}, {}), meta, RUN)
    rows = {r.session_id: r for r in out.collect()}
    assert len(rows) == 2
    assert rows["s1"].num_turns == 9 and rows["s1"].click_event_count == 2
    assert rows["s2"].num_turns is None and rows["s2"].click_event_count is None
    assert rows["s2"].is_self_served == 1


def test_all_metadata_copies_multiply(spark):
    meta = sessions(spark, {}, {"num_turns": 9})
    out = unify.unify(turns(spark, {}), clicks(spark, {}), meta, RUN, dedupe_metadata=False)
    assert sorted(r.num_turns for r in out.collect()) == [3, 9]
    assert {r.click_event_count for r in out.collect()} == {1}


def test_rows_without_keys_are_dropped(spark):
    out = clean_chatbot(turns(spark, {"contact_id": None}, {"session_id": None}, {}))
    assert out.count() == 1


def test_bad_text_becomes_null(spark):
    raw = spark.createDataFrame(
        [("c", "s", "high", "1.0", "x", " Retail\t")],
        "contact_id string, session_id string, confidence_score string, thumbs_up string, "
        "handle_seconds_dur string, business_unit string",
    ).withColumn("application_channel", F.lit(" Web "))
    row = clean_chatbot(raw).first()
    assert (row.confidence_score, row.thumbs_up, row.handle_seconds_dur) == (None, 1, None)
    # only spaces are trimmed
    assert row.business_unit == "Retail\t" and row.application_channel == "Web"


@pytest.mark.parametrize(
    ("score", "tier"), [(0.7, "HIGH"), (0.69, "MEDIUM"), (0.4, "MEDIUM"), (0.39, "LOW"), (None, "LOW")]
)
def test_resolution_tier_edges(spark, score, tier):
    out = unify.unify(
        turns(spark, {"derived_resolution_score": score}), clicks(spark, {}), sessions(spark, {}), RUN
    )
    assert out.first().resolution_tier == tier


def test_null_scores_count_as_zero(spark):
    missing = {"confidence_score": None, "derived_resolution_score": None, "thumbs_up": None}
    out = unify.unify(turns(spark, {**missing, "session_id": "x"}), clicks(spark, {}), sessions(spark, {}), RUN)
    assert out.first().session_quality_score == 0.15


def test_confidence_falls_back_to_metadata(spark):
    out = unify.unify(turns(spark, {"confidence_score": None}), clicks(spark, {}), sessions(spark, {}), RUN)
    assert out.first().effective_confidence_score == 0.7


def test_bad_date_has_no_parts(spark):
    out = unify.unify(turns(spark, {"created_at": "soon"}), clicks(spark, {}), sessions(spark, {}), RUN)
    row = out.first()
    assert (row.created_at_ts, row.year, row.month, row.day) == (None, None, None, None)


def test_csv_columns_match_by_name(spark, tmp_path):
    from parley.sources.schemas import CLICKSTREAM

    path = str(tmp_path / "clicks")
    shuffled = clicks(spark, {"time_on_page_seconds": 7}).select(*reversed(CLICKSTREAM.names))
    writers.write_csv(shuffled.withColumn("extra", F.lit("kept")), path)
    row = readers.read_csv(spark, path, CLICKSTREAM).first()
    assert row.time_on_page_seconds == 7 and row.page_name == "/home" and row.extra == "kept"


def test_csv_written_elsewhere(spark, tmp_path):
    from parley.sources.schemas import CHATBOT

    values = turns(spark, {"topic_name": 'say "hi", \\ ok', "confidence_score": None, "thumbs_up": 1}).toPandas()
    values["thumbs_up"] = values["thumbs_up"].astype(float)
    values.to_csv(tmp_path / "turns.csv", index=False)
    row = readers.read_csv(spark, str(tmp_path / "turns.csv"), CHATBOT).first()
    assert row.topic_name == 'say "hi", \\ ok'
    assert (row.confidence_score, row.thumbs_up) == (None, 1)


def test_csv_round_trip_keeps_quotes_and_padding(spark, tmp_path):
    from parley.sources.schemas import CHATBOT

    rows = turns(spark, {"topic_name": ' "a", \\"b" ', "business_unit": " Retail "})
    writers.write_csv(rows, str(tmp_path / "t"))
    assert readers.read_csv(spark, str(tmp_path / "t"), CHATBOT).collect() == rows.collect()


def _three_days(spark):
    rows = turns(
        spark,
        {"created_at": "2024-01-05T01:00:00"},
        {"created_at": "2024-01-06T01:00:00"},
        {"created_at": "2024-11-07T01:00:00"},
    )
    return unify.unify(rows, clicks(spark, {}), sessions(spark, {}), RUN)


def test_partition_values_stay_text_and_other_days_survive(spark, tmp_path):
    path = str(tmp_path / "unified")
    writers.write_unified(_three_days(spark), path)
    again = turns(spark, {"created_at": "2024-01-06T05:00:00"}, {"created_at": "2024-01-06T06:00:00"})
    fresh = unify.unify(again, clicks(spark, {}), sessions(spark, {}), RUN)
    writers.write_unified(fresh, path, mode="days")
    back = readers.read_unified(spark, path)
    days = {(r.year, r.month, r.day): r["count"] for r in back.groupBy("year", "month", "day").count().collect()}
    assert days == {("2024", "01", "05"): 1, ("2024", "01", "06"): 2, ("2024", "11", "07"): 1}


def _unified(spark, *rows):
    return unify.unify(turns(spark, *rows), clicks(spark, {}), sessions(spark, {}), RUN)


def test_full_write_is_the_whole_table(spark, tmp_path):
    path = str(tmp_path / "unified")
    writers.write_unified(_three_days(spark), path)
    writers.write_unified(_unified(spark, {"created_at": "2024-01-06T05:00:00"}), path)
    assert [r.created_at for r in readers.read_unified(spark, path).collect()] == ["2024-01-06T05:00:00"]
    with pytest.raises(ValueError):
        writers.write_unified(_three_days(spark), path, mode="some")


def test_merge_keeps_stored_rows(spark, tmp_path):
    path = str(tmp_path / "unified")
    stored = [
        {"created_at": "2024-01-05T01:00:00"},
        {"created_at": "2024-01-06T01:00:00", "thumbs_up": 0},
        {"created_at": "bad date", "contact_id": "c2"},
    ]
    writers.write_unified(_unified(spark, *stored), path)
    batch = _unified(
        spark,
        {"created_at": "2024-01-06T09:00:00"},  # a late turn
        {"created_at": "2024-01-06T01:00:00", "thumbs_up": 1},  # a turn sent again, with a new value
        {"created_at": "other bad date", "contact_id": "c3"},
        {"created_at": "2024-01-09T01:00:00"},
    )
    expected = [
        ("2024-01-05T01:00:00", "c1", 0), ("2024-01-06T01:00:00", "c1", 1), ("2024-01-06T09:00:00", "c1", 0),
        ("2024-01-09T01:00:00", "c1", 0), ("bad date", "c2", 0), ("other bad date", "c3", 0),
    ]
    for _ in range(2):  # a batch merged twice leaves no duplicates
        writers.merge_unified(batch, path)
        back = readers.read_unified(spark, path)
        assert sorted((r.created_at, r.contact_id, r.thumbs_up) for r in back.collect()) == expected


def test_files_with_differing_headers_are_united_by_name(spark, tmp_path):
    from parley.sources.schemas import CHATBOT

    folder = tmp_path / "t [1]"
    folder.mkdir()
    (folder / "a.csv").write_text("contact_id,session_id,thumbs_up\nc1,s1,1\n" + "c1,s1,1\n" * 50)
    (folder / "b.csv").write_text("session_id,contact_id\ns2,c2\n")
    (folder / "c d.csv").write_text("agent,contact_id,session_id,thumbs_up\nbo,c3,s3,x\n")
    (folder / "e.csv").write_text("contact_id,session_id,thumbs_up\nc4,s4,\n")
    (folder / "empty.csv").write_text("")
    (folder / "_log").write_text("nothing,of,that\n1,2,3\n")
    got = readers.read_csv(spark, str(folder).replace("[", "\\["), CHATBOT)
    assert got.columns == ["contact_id", "session_id", "thumbs_up", "agent"]
    rows = sorted(tuple(r) for r in got.distinct().collect())
    assert rows == [
        ("c1", "s1", 1, None), ("c2", "s2", None, None), ("c3", "s3", None, "bo"), ("c4", "s4", None, None),
    ]
    assert got.count() == 54
    none = readers.read_csv(spark, str(tmp_path / "nowhere"), CHATBOT)
    assert none.schema == CHATBOT and none.count() == 0


def test_compressed_files_have_headers_too(spark, tmp_path):
    import gzip

    from parley.sources.schemas import CHATBOT

    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(b"session_id,contact_id\ns1,c1\n"))
    (tmp_path / "b.csv").write_text("contact_id,session_id\nc2,s2\n")
    rows = readers.read_csv(spark, str(tmp_path), CHATBOT).collect()
    assert sorted((r.contact_id, r.session_id) for r in rows) == [("c1", "s1"), ("c2", "s2")]


def test_line_breaks_in_quoted_cells(spark, tmp_path):
    from parley.sources.schemas import CHATBOT

    path = tmp_path / "t x.csv"
    path.write_text('contact_id,session_id,topic_name\nc1,s1,"two\nlines"\nc2,s2,"a ""b"""\n')
    assert readers.read_csv(spark, str(path), CHATBOT, multi_line=False).count() == 3
    for multi_line in (None, True):
        rows = readers.read_csv(spark, str(path), CHATBOT, multi_line).collect()
        assert [(r.contact_id, r.topic_name) for r in rows] == [("c1", "two\nlines"), ("c2", 'a "b"')]
    back = readers.read_csv_sample(spark, str(path), CHATBOT, 1, ["contact_id"])
    assert back.first().topic_name == "two\nlines"


def test_only_files_with_line_breaks_are_read_whole(spark, tmp_path):
    from parley.sources.schemas import CHATBOT

    (tmp_path / "a.csv").write_text('contact_id,session_id,topic_name\nc1,s1,"two\n\nlines, and"\n')
    (tmp_path / "b.csv").write_text("contact_id,session_id,topic_name\n" + "c2,s2,x\n" * 1000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = readers.read_csv(spark, str(tmp_path), CHATBOT)
        assert got.count() == 1001
        assert got.filter("contact_id = 'c1'").first().topic_name == "two\n\nlines, and"
        tasks = got.select("contact_id", F.spark_partition_id().alias("p")).distinct().groupBy("contact_id").count()
        assert {r.contact_id: r["count"] > 1 for r in tasks.collect()} == {"c1": False, "c2": True}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_loaders_take_line_breaks_as_they_come(spark, tmp_path):
    from parley.sources.schemas import SOURCES

    for name, schema in SOURCES.items():
        cells = ['"a\nb"' if c == "topic_name" else "1" for c in schema.names]
        (tmp_path / f"{name}.csv").write_text(",".join(schema.names) + "\n" + ",".join(cells) + "\n")
    timed, meta = readers.load_timed(spark, str(tmp_path))
    assert timed.count() == meta.count() == 1 and meta.first().topic_name == "a\nb"
    assert [df.count() for df in readers.load_sources(spark, str(tmp_path))] == [1, 1, 1]


def test_any_rows_read_no_more_than_needed(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    some = readers.read_parquet_sample(spark, str(tmp_path / "t"), 5, [])
    assert some.count() == 5
    assert "TakeOrdered" not in plan_of(some)


def test_unreadable_session_start_is_no_latest(spark):
    meta = sessions(spark, {"session_start": "not-a-date", "num_turns": 9}, {"session_start": "2024-01-10T09:00:00", "num_turns": 2})
    assert unify.latest_metadata(meta).first().num_turns == 2
    only = sessions(spark, {"session_start": "not-a-date", "num_turns": 9})
    assert unify.latest_metadata(only).collect() == only.collect()


SPELLINGS = [
    ({"start_date": "2024-1-6"}, 2),
    ({"start_date": "2024-1-6", "end_date": "2024-1-31"}, 1),
    ({"end_date": "2024-01"}, 0),
    ({"end_date": "2024"}, 0),
    ({"start_date": "2024-11"}, 1),
    ({"start_date": "2024"}, 3),
    ({"start_date": " 2024-01-06T00:30:00 "}, 2),
    ({"start_date": "2024-01-06 01:00:01"}, 1),
    ({"end_date": "2024-1-6T01:00:00", "end_mode": "midnight"}, 2),
    ({"end_date": "2024-1-6", "end_mode": "midnight"}, 1),
]


@pytest.mark.parametrize("fields, rows", SPELLINGS)
def test_spelling_of_dates_does_not_matter(spark, tmp_path, fields, rows):
    path = str(tmp_path / "unified")
    writers.write_unified(_three_days(spark), path)
    chosen, stored = Selection(**fields), readers.read_unified(spark, path)
    raw = by_time(_three_days(spark).drop("year"), F.col("created_at_ts"), chosen)
    kept = by_time(stored, F.col("created_at_ts"), chosen)
    assert (raw.count(), kept.count()) == (rows, rows)
    scan = [line for line in plan_of(kept).split("\n") if "FileScan" in line][0]
    assert "concat_ws" in scan.split("PartitionFilters")[1]


@pytest.mark.parametrize("text", ["soon", "2024-13-01", "2024-02-30", "01/02/2024", "2024-01-01T25:00", "2024-01-01T10:00Z", "20240101"])
def test_unreadable_dates_are_refused(text):
    with pytest.raises(ValueError):
        Selection(start_date=text)
    with pytest.raises(ValueError):
        Selection(end_date=text)


def test_date_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "unified")
    writers.write_unified(_three_days(spark), path)
    chosen = by_time(
        readers.read_unified(spark, path), F.col("created_at_ts"),
        Selection(start_date="2024-01-06", end_date="2024-01-06"),
    )
    assert [r.created_at for r in chosen.collect()] == ["2024-01-06T01:00:00"]
    scan = [line for line in plan_of(chosen).split("\n") if "FileScan" in line][0]
    assert "PushedFilters: [IsNotNull(created_at_ts)" in scan
    assert "concat_ws" in scan.split("PartitionFilters")[1]


def _skewed(spark, rows=60000):
    """A third of all turns belong to one session."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), (n % 5000).cast("string")))
    base = spark.range(rows).select(
        F.lit("c").alias("contact_id"), key.alias("session_id"), n.cast("string").alias("created_at"),
        F.lit(1).alias("thumbs_up"), F.repeat(F.sha2(n.cast("string"), 256), 4).alias("filler"),
    )
    return base.repartition(16)


@pytest.fixture
def skew_conf(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("dedupe", [True, False])
def test_hot_session_is_split_in_the_join(spark, skew_conf, dedupe):
    big = _skewed(spark)
    meta = clean_metadata(sessions(spark, *[{"contact_id": "c", "session_id": f"s{i}"} for i in range(5000)],
                                   {"contact_id": "c", "session_id": "hot"}))
    summary = unify.click_sessions(clean_clickstream(clicks(spark, {"contact_id": "c", "session_id": "hot"})))
    joined = unify.join_sources(big, summary, meta, dedupe)
    got = joined.agg(
        F.count("*"), F.count("num_turns"), F.count("click_event_count"), F.sum(F.length("filler"))
    )
    assert tuple(got.collect()[0]) == (60000, 60000, 20000, 60000 * 256)
    assert "SortMergeJoin(skew=true)" in plan_of(got)


def test_hot_day_is_written_by_several_tasks(spark, skew_conf, tmp_path):
    day = F.when(F.col("session_id") == "hot", "05").otherwise("06")
    rows = _skewed(spark).select(
        "*", F.lit("2024").alias("year"), F.lit("01").alias("month"), day.alias("day")
    )
    writers.write_unified(rows, str(tmp_path / "out"))
    files = list((tmp_path / "out").glob("version=*/year=2024/month=01/day=05/*.parquet"))
    assert len(files) > 1
    back = readers.read_unified(spark, str(tmp_path / "out"))
    assert back.filter("day = '05'").count() == 20000 and back.count() == 60000


def test_hot_key_is_split_when_resuming(spark, skew_conf):
    big = _skewed(spark).withColumn("created_at", F.lit("x"))
    done = big.filter(F.col("session_id").isin("s1", "s2"))
    left = not_yet_annotated(big, done, ["contact_id", "session_id", "created_at"])
    got = left.agg(
        F.count("*"), F.count_if(F.col("session_id") == "hot"), F.max(F.length("filler"))
    )
    total, hot, _ = got.collect()[0]
    assert hot == 20000 and total == 60000 - done.count()
    assert "SortMergeJoin(skew=true)" in plan_of(got)


def test_hot_metadata_is_split_when_copies_are_kept(spark, skew_conf):
    meta = _skewed(spark)
    summary = unify.click_sessions(
        clean_clickstream(
            clicks(spark, {"contact_id": "c", "session_id": "hot"}, {"contact_id": "c", "session_id": "new"})
        )
    )
    facts = unify.session_facts(meta, summary, unique_metadata=False)
    got = facts.agg(F.count("*"), F.count("click_event_count"), F.max(F.length("filler")))
    assert tuple(got.collect()[0])[:2] == (60001, 20001)
    assert "SortMergeJoin(skew=true)" in plan_of(got)


def test_resume_knows_rows_with_a_null_key(spark):
    rows = turns(spark, {"created_at": None}, {})
    keys = ["contact_id", "session_id", "created_at"]
    left = not_yet_annotated(rows, rows.filter("created_at IS NULL"), keys)
    assert [r.created_at for r in left.collect()] == ["2024-01-10T10:00:00"]


def test_shared_contacts_and_coverage(spark):
    t = turns(spark, {}, {"contact_id": "c2"}, {"contact_id": None}, {"contact_id": "c2"})
    assert [r.contact_id for r in unify.shared_contacts(t, clicks(spark, {}, {"contact_id": "c9"})).collect()] == ["c1"]
    row = unify.metadata_coverage(t, sessions(spark, {}, {"contact_id": "c9"})).first()
    assert (row.chatbot_sessions, row.with_metadata, row.without_metadata, row.coverage) == (2, 1, 1, 0.5)


def test_scratch_folders_leave_the_session_alone_and_can_be_cleared(spark):
    from parley.session import clear_scratch, scratch_folder

    before = spark.conf.get("spark.checkpoint.dir", None)
    folder = scratch_folder(spark, "x")
    spark.range(3).write.parquet(folder)
    assert spark.conf.get("spark.checkpoint.dir", None) == before
    assert folder != scratch_folder(spark, "x")
    clear_scratch(spark)
    assert not pathlib.Path(folder).exists()
