from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from parley.functions.prompts import TEMPLATES, PromptTemplate, get_template
from parley.operators import annotate, cost, logs
from parley.operators.reports import insight_messages
from tests.helpers import sessions, texts, turns


def _transcript(spark, **fields):
    return turns(spark, fields).select(annotate.transcript(turns(spark, fields))).first()[0]


@pytest.mark.parametrize("value", [0.125, 0.145, 0.155, 0.375, 0.8749, 1.0, 12.5])
def test_confidence_formats_like_python(spark, value):
    assert f"Bot confidence: {value:.2f}\n" in _transcript(spark, confidence_score=value)


def test_transcript_defaults(spark):
    missing = dict.fromkeys(
        ["application_channel", "response_type", "confidence_score", "escalated_to_agent", "thumbs_up", "thumbs_down"]
    )
    got = _transcript(spark, **missing)
    assert got.startswith("Channel: Web\nResponse type: FAQ\nBot confidence: 0.70\n")
    assert "[... 1 additional exchange(s) ...]" in got
    assert got.endswith("Outcome: Session resolved by the bot.\nNo explicit feedback given.")


def test_transcript_leaves_topic_out(spark):
    assert "Billing" not in _transcript(spark, escalated_to_agent=1, thumbs_down=1)


def test_short_sessions_have_no_extra_exchange(spark):
    rows = turns(spark, {}).withColumn("num_turns", F.lit(1))
    assert "[... 0 additional" in rows.select(annotate.transcript(rows)).first()[0]


def test_quoted_and_odd_reply_values(spark):
    replies_ = spark.createDataFrame(
        [
            (1, "{}", '{"sentiment_score": "-0.5", "frustration_signal": "true"}', '{"confidence": "0.9"}'),
            (2, "{}", '{"sentiment_score": "high", "frustration_signal": 3.5}', '{"confidence": NaN}'),
            (3, "{}", '{"sentiment_score": 1, "frustration_signal": false}', '{"confidence": null}'),
        ],
        "id int, s string, e string, t string",
    )
    got = annotate.parse_replies(replies_, "s", "e", "t").orderBy("id").collect()
    assert [(r.llm_sentiment_score, r.llm_frustration, r.llm_topic_confidence) for r in got] == [
        (-0.5, True, 0.9), (None, None, None), (1.0, False, None),
    ]


def test_latest_version():
    assert get_template("summarization").version == 2
    assert get_template("summarization", 1).output_format == "text"
    assert {t.key for t in TEMPLATES} >= {"summarization", "topic_classification", "agent_scoring", "sentiment", "insight"}


def test_unknown_version():
    with pytest.raises(ValueError):
        get_template("summarization", 99)


def test_missing_variable_fails_at_once():
    with pytest.raises(KeyError):
        get_template("summarization", 1).render_text(transcript="x")
    with pytest.raises(KeyError):
        get_template("sentiment").messages()


def test_columns_render_like_text(spark):
    values = texts(spark, "costs $5 and ${max_words}", "plain")
    for template in TEMPLATES:
        names = template.variables()
        columns = template.render(**{n: F.col("text") for n in names})
        for row in values.select("text", columns["system"].alias("s"), columns["user"].alias("u")).collect():
            wanted = template.render_text(**{n: row.text for n in names})
            assert (row.s, row.u) == (wanted["system"], wanted["user"])


def test_messages_shape(spark):
    out = texts(spark, "this waiting is bad").select(get_template("sentiment").messages(conversation=F.col("text")).alias("m"))
    roles = [(m.role, "waiting" in m.content) for m in out.first().m]
    assert roles == [("system", False), ("user", True)]


REPLIES = [
    ('{"summary": "s", "core_issue": "c", "outcome": "RESOLVED"}', "s", None),
    ('  {"summary": "s"}  ', "s", None),
    ("{'summary': 's'}", None, "error"),
    ('```json\n{"summary": "s"}\n```', None, "error"),
    ('{"summary": "s"} extra', None, "error"),
    ('{"summary": "s"}, {"summary": "t"}', None, "error"),
    ('{"summary": "s"', None, "error"),
    ('["s"]', None, "error"),
    ("null", None, "error"),
    ("12", None, "error"),
    ("{}", None, None),
    ('{"summary": null}', None, None),
    ("", None, None),
    (None, None, None),
]


@pytest.mark.parametrize(("reply", "summary", "error"), REPLIES)
def test_summary_replies(spark, reply, summary, error):
    row = annotate.parse_replies(texts(spark, reply, "x"), "text", "text", "text").orderBy("id").first()
    assert row.llm_summary == summary
    assert (row.llm_processing_error is not None) == (error is not None)


def test_scorer_failures_keep_the_row(spark):
    def factory():
        def score(key, messages, max_tokens, temperature):
            if key == "summarization":
                raise RuntimeError("no quota")
            if key == "sentiment":
                return None
            return '{"topic": "Nonsense", "confidence": 0.4}'

        return score

    row = annotate.annotate(turns(spark, {}), factory).first()
    assert row.llm_processing_error == "no quota" and row.llm_summary is None
    assert row.llm_sentiment is None
    assert (row.llm_topic, row.llm_topic_confidence, row.topic_in_list) == ("Nonsense", 0.4, False)
    assert row.contact_id == "c1"


def test_one_scorer_per_task_and_one_call_per_request(spark):
    calls = spark.sparkContext.accumulator(0)
    made = spark.sparkContext.accumulator(0)

    def factory():
        made.add(1)

        def score(key, messages, max_tokens, temperature):
            calls.add(1)
            return "{}"

        return score

    rows = turns(spark, *[{"session_id": str(i)} for i in range(20)]).repartition(2)
    out = annotate.annotate(rows, factory, concurrency=1)
    out.filter(F.col("llm_topic").isNull()).collect()
    assert calls.value == 60 and made.value == 2


def test_calls_run_side_by_side_in_order(spark):
    def factory():
        def score(key, messages, max_tokens, temperature):
            time.sleep(0.05)
            return f'{{"summary": "{messages[-1]["content"].count("Kiosk")}", "topic": "x"}}'

        return score

    rows = turns(spark, *[{"session_id": str(i), "application_channel": "Kiosk" if i % 3 else "Web"} for i in range(80)])
    stored = rows.repartition(4).cache()
    stored.count()
    annotate.annotate(stored.limit(1), factory).collect()
    start = time.time()
    out = annotate.annotate(stored, factory, concurrency=4).collect()
    assert time.time() - start < 4  # one after the other the calls of a task take 3 s, of all 12 s
    assert len(out) == 80
    assert all(r.llm_summary == ("1" if int(r.session_id) % 3 else "0") for r in out)


def test_failed_calls_are_retried_on_resume(spark):
    def failing(only):
        def factory():
            def score(key, messages, max_tokens, temperature):
                if key in only:
                    raise RuntimeError(f"no {key}")
                return "{}"

            return score

        return factory

    rows = turns(spark, {"session_id": "a"}, {"session_id": "b"})
    keys = ["contact_id", "session_id", "created_at"]
    for only, left in ((["summarization", "sentiment", "topic_classification"], 2), (["sentiment"], 2), ([], 0)):
        done = annotate.annotate(rows, failing(only)).cache()
        assert annotate.not_yet_annotated(rows, done, keys).count() == left
    row = annotate.annotate(rows, failing(["sentiment"])).first()
    assert (row.llm_summary_call_error, row.llm_sentiment_call_error, row.llm_topic_call_error) == (None, "no sentiment", None)
    assert row.llm_usage == []


def test_reported_tokens_can_be_priced(spark):
    def factory():
        return lambda key, messages, max_tokens, temperature: ("{}", 1000, 500 if key == "sentiment" else 0)

    calls = annotate.usage_calls(annotate.annotate(turns(spark, {}), factory), "gpt-4o", "session_id")
    assert sorted((r.task, r.prompt_tokens, r.completion_tokens) for r in calls.collect()) == [
        ("sentiment", 1000, 500), ("summary", 1000, 0), ("topic", 1000, 0),
    ]
    total = cost.usage_summary(calls).filter("model = 'ALL'").first()
    assert (total.calls, total.total_tokens, total.cost_usd) == (3, 3500, 0.0225)


def test_own_template(spark):
    def factory():
        return lambda key, messages, max_tokens, temperature: '{"summary": "%s %d"}' % (
            messages[1]["content"][:4], max_tokens
        )

    own = PromptTemplate("summarization", 3, "sys", "MINE ${transcript}", "json", 7, 0.0)
    row = annotate.annotate(turns(spark, {}), factory, templates={"summary": own}).first()
    assert row.llm_summary == "MINE 7"


def test_shared_replies_ask_once_per_transcript(spark):
    calls = spark.sparkContext.accumulator(0)

    def factory():
        def score(key, messages, max_tokens, temperature):
            calls.add(1)
            return '{"summary": "up"}' if "thumbs up" in messages[-1]["content"] else "{}"

        return score

    rows = turns(spark, *[{"session_id": str(i), "thumbs_up": i % 2} for i in range(20)])
    out = annotate.annotate(rows, factory, concurrency=1, share_replies=True).collect()
    assert calls.value == 6
    assert {(int(r.session_id) % 2, r.llm_summary) for r in out} == {(0, None), (1, "up")}
    assert len(out) == 20 and set(out[0].asDict()) >= set(rows.columns)


def _calls(spark, *rows):
    return spark.createDataFrame(rows, "session_id string, model string, prompt_tokens int, completion_tokens int")


def test_cost(spark):
    rows = _calls(spark, ("r", "gpt-4o-mini", 1_000_000, 0), ("r", "GPT-4O-MINI", 0, 1_000_000), ("r", "other", 1_000_000, 1_000_000), ("r", None, 2_000_000, 0))
    got = sorted(r.cost_usd for r in cost.price_calls(rows).collect())
    assert got == [0.15, 0.6, 1.0, 2.0]


def test_given_prices(spark):
    prices = spark.createDataFrame([("other", 1.0, 2.0)], "model string, input_usd double, output_usd double")
    row = cost.price_calls(_calls(spark, ("r", "Other", 1_000_000, 1_000_000)), prices).first()
    assert row.cost_usd == 3.0


def test_usage_groups_by_model_as_written(spark):
    rows = _calls(spark, ("r", "gpt-4o-mini", 100, 50), ("r", "GPT-4o-mini", 100, 50), ("q", "gpt-4o", 1, 1))
    got = {(r.session_id, r.model): (r.calls, r.total_tokens) for r in cost.usage_summary(rows, "session_id").collect()}
    assert got == {
        ("r", "gpt-4o-mini"): (1, 150), ("r", "GPT-4o-mini"): (1, 150), ("r", "ALL"): (2, 300),
        ("q", "gpt-4o"): (1, 2), ("q", "ALL"): (1, 2), ("ALL", "ALL"): (3, 302),
    }


def test_insight_prompt_holds_the_figures(spark):
    row = insight_messages(turns(spark, {}), sessions(spark, {}), "May").first()
    assert row.document in row.messages[1].content and "May" in row.messages[1].content


def test_run_times(spark):
    lines = texts(
        spark,
        '{"message": "Step completed", "step": "load", "elapsed_seconds": 2.0}',
        '{"message": "Step failed", "step": "load", "elapsed_seconds": 1.0, "error": "x"}',
        '{"message": "Step started", "step": "load"}',
        '{"message": "Block completed", "block": "b", "elapsed_seconds": 0.5}',
        '{"message": "mail a@b.org"}',
        "not json",
    )
    parsed = logs.parse_log_lines(lines, "text")
    assert parsed.filter("message = 'mail [EMAIL_REDACTED]'").count() == 1
    assert [tuple(r) for r in logs.step_run_times(parsed).collect()] == [("load", 2, 1, 1.5, 2.0)]
    assert [tuple(r) for r in logs.block_run_times(parsed).collect()] == [("b", 1, 0, 0.5, 0.5)]
