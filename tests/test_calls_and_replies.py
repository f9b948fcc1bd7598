"""Trying calls again within a run, the budget of a task, and replies kept from run to run."""

from __future__ import annotations

import threading
import time

import pytest
from pyspark.sql import functions as F

from parley.functions.prompts import PromptTemplate
from parley.operators import annotate, cost, reply_store
from parley.operators.calls import Budget, Caller, PassingError, Retry, is_passing
from parley.plans.jobs import annotate_job
from parley.sources import writers
from parley.operators import unify
from tests.helpers import clicks, sessions, turns

QUICK = Retry(first_wait=0.01)


def failing(times, problem):
    """A scorer that fails so many times per prompt, then answers."""
    seen: dict[str, int] = {}
    lock = threading.Lock()

    def score(key, messages, max_tokens, temperature):
        with lock:
            seen[key] = seen.get(key, 0) + 1
            n = seen[key]
        if n <= times:
            raise problem
        return f"{key} {n}", 5, 7

    return score


@pytest.mark.parametrize("problem", [PassingError("later"), TimeoutError("slow"), ConnectionResetError("gone")])
def test_passing_errors_are_tried_again(problem):
    assert Caller(failing(2, problem), 1, QUICK).ask("k", [], 1, 0.0) == ("k 3", None, 5, 7)
    failed = Caller(failing(3, problem), 1, QUICK).ask("k", [], 1, 0.0)
    assert failed[0] is None and str(problem) in failed[1]


def test_final_errors_are_not():
    caller = Caller(failing(1, ValueError("bad")), 1, QUICK)
    assert caller.ask("k", [], 1, 0.0) == (None, "bad", None, None)
    assert caller.ask("k", [], 1, 0.0)[0] == "k 2"
    own = Retry(first_wait=0.01, passing=lambda problem: "bad" in str(problem))
    assert Caller(failing(1, ValueError("bad")), 1, own).ask("k", [], 1, 0.0)[0] == "k 2"
    assert not is_passing(ValueError()) and is_passing(PassingError())


def test_waits_double_up_to_the_longest_or_as_asked():
    retry = Retry(first_wait=2, longest_wait=5)
    for attempt, low in ((1, 2), (2, 4), (3, 5), (9, 5)):
        assert low <= retry.wait(attempt, PassingError()) <= low * 1.1
    assert retry.wait(4, PassingError("x", wait=0.25)) == 0.25
    start = time.monotonic()
    Caller(failing(2, PassingError("x", wait=0.1)), 1, Retry()).ask("k", [], 1, 0.0)
    assert 0.2 <= time.monotonic() - start < 1


def test_threads_of_a_task_stay_under_the_budget():
    stamps, lock = [], threading.Lock()

    def score(*_):
        with lock:
            stamps.append(time.monotonic())
        return "x"

    caller = Caller(score, 8, Retry(calls_per_second=50))
    (answers,) = caller.batches(iter([[("k", [], 1, 0.0)] * 60]))
    assert len(answers) == 60
    stamps.sort()
    assert stamps[-1] - stamps[0] >= 59 / 50 * 0.95
    assert all(b - a >= 0.15 for a, b in zip(stamps, stamps[10:]))  # ten gaps of 0.02 s
    Budget(None).take()


def test_a_run_ends_without_errors(spark):
    def factory():
        return failing(2, PassingError("rate limit"))

    rows = turns(spark, {"session_id": "a"}, {"session_id": "b"}).repartition(1)
    got = annotate.annotate(rows, factory, retry=QUICK).collect()
    assert all(r[c] is None for r in got for c in annotate.CALL_ERRORS)
    once = annotate.annotate(rows, factory, concurrency=1, retry=Retry(attempts=1)).collect()
    assert sum(r.llm_summary_call_error is not None for r in once) == 2


def counting(spark, reply='{"summary": "s", "topic": "x"}', fails=()):
    calls = spark.sparkContext.accumulator(0)

    def factory():
        def score(key, messages, max_tokens, temperature):
            calls.add(1)
            if key in fails:
                raise RuntimeError("no")
            return reply, 100, 10

        return score

    return factory, calls


def test_a_second_run_makes_no_call(spark, tmp_path):
    store, rows = str(tmp_path / "store"), turns(spark, *[{"session_id": str(i), "thumbs_up": i % 2} for i in range(20)])
    factory, calls = counting(spark)
    first = reply_store.annotate_from_store(rows, store, "one", factory).collect()
    assert calls.value == 6 and len(first) == 20  # three tasks, two transcripts
    second = reply_store.annotate_from_store(rows, store, "two", factory).collect()
    assert calls.value == 6 and sorted(second) == sorted(first)
    plain = annotate.annotate(rows, counting(spark)[0]).drop("llm_usage").collect()
    drop = lambda r: tuple(v for k, v in r.asDict().items() if k != "llm_usage")
    assert sorted(map(drop, first), key=str) == sorted(map(tuple, plain), key=str)
    # one more transcript, and another template for one task
    more = rows.union(turns(spark, {"session_id": "z", "thumbs_down": 1}))
    reply_store.annotate_from_store(more, store, "three", factory).collect()
    assert calls.value == 9
    own = PromptTemplate("summarization", 3, "sys", "MINE ${transcript}", "json", 7, 0.0)
    reply_store.annotate_from_store(rows, store, "four", factory, templates={"summary": own}).collect()
    assert calls.value == 11
    usage = reply_store.usage_of_runs(reply_store.read_store(spark, store), "gpt-4o")
    total = cost.usage_summary(usage).filter("model = 'ALL'").first()
    assert (total.calls, total.total_tokens) == (11, 1210)
    by_run = {r.run: r["count"] for r in usage.groupBy("run").count().collect()}
    assert by_run == {"one": 6, "three": 3, "four": 2}


def test_failed_calls_are_not_kept(spark, tmp_path):
    store, rows = str(tmp_path / "store"), turns(spark, {}, {"session_id": "b"})
    factory, calls = counting(spark, fails=("sentiment",))
    got = reply_store.annotate_from_store(rows, store, "one", factory).collect()
    assert calls.value == 3
    assert {(r.llm_sentiment_call_error, r.llm_summary_call_error, r.llm_summary) for r in got} == {("no", None, "s")}
    factory, calls = counting(spark)
    got = reply_store.annotate_from_store(rows, store, "two", factory).collect()
    assert calls.value == 1 and all(r.llm_sentiment_call_error is None for r in got)
    # a reply that two runs both asked for is one reply
    both = reply_store.read_store(spark, store)
    both.withColumn("run", F.lit("x")).withColumn("reply", F.lit("{}")).write.mode("append").parquet(store)
    assert len(reply_store.annotate_from_store(rows, store, "three", factory).collect()) == 2 and calls.value == 1


def test_no_rows_and_the_job(spark, tmp_path):
    store = str(tmp_path / "store")
    assert reply_store.annotate_from_store(turns(spark), store, "none").count() == 0
    path = str(tmp_path / "unified")
    rows = turns(spark, {}, {"session_id": "s2"})
    writers.write_unified(unify.unify(rows, clicks(spark, {}), sessions(spark, {"num_turns": 9}), "2024-02-01T00:00:00"), path)
    factory, calls = counting(spark)
    for k in range(2):
        annotate_job(spark, path, str(tmp_path / f"out{k}"), factory, store=store, run=str(k))
        assert spark.read.json(str(tmp_path / f"out{k}")).count() == 2
        assert calls.value == 6  # the two transcripts differ in their number of turns
