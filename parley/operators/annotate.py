"""Annotation of interaction rows by a text model."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions import replies
from parley.functions.casts import as_double
from parley.functions.prompts import PromptTemplate, fill_template, get_template
from parley.operators.calls import Caller, Retry, Scorer, ScorerFactory
from parley.operators.joins import spread_join
from parley.sources.schemas import TOPICS

# Stand-ins for missing fields of a row.
DEFAULTS = {
    "application_channel": "Web",
    "num_turns": 3,
    "response_type": "FAQ",
    "confidence_score": 0.7,
    "escalated_to_agent": 0,
    "thumbs_up": 0,
    "thumbs_down": 0,
}

# The transcript text. The topic is left out so that the model has to find it.
TRANSCRIPT = (
    "Channel: ${channel}\n"
    "Response type: ${response}\n"
    "Bot confidence: ${confidence}\n"
    "User: Hi, I need some help with an issue on my account.\n"
    "Bot:  Of course, I can assist you with that. Could you provide more details?\n"
    "[... ${exchanges} additional exchange(s) ...]\n"
    "Outcome: Session ${outcome}.\n"
    "${feedback}"
)
ESCALATED = "escalated to a human agent"
RESOLVED = "resolved by the bot"
THUMBS_UP = "Customer gave a thumbs up at the end."
THUMBS_DOWN = "Customer gave a thumbs down."
NO_FEEDBACK = "No explicit feedback given."

MAX_SUMMARY_WORDS = 60
TOPIC_LIST = "\n".join(f"  - {topic}" for topic in TOPICS)


def transcript(df: DataFrame) -> Column:
    """Transcript of a row, written from its fields; missing ones take the defaults."""

    def value(name: str) -> Column:
        default = F.lit(DEFAULTS[name])
        if name not in df.columns:
            return default
        present = as_double(F.col(name)) if isinstance(DEFAULTS[name], float) else F.col(name)
        return F.coalesce(present, default)

    return fill_template(
        TRANSCRIPT,
        {
            "channel": value("application_channel"),
            "response": value("response_type"),
            # given a pattern, the formatter rounds the exact binary value, half to even
            "confidence": F.call_function(
                "format_number", value("confidence_score"), F.lit("0.00")
            ),
            "exchanges": F.greatest(F.lit(0), value("num_turns").cast("int") - 2),
            "outcome": F.when(value("escalated_to_agent") != 0, ESCALATED).otherwise(RESOLVED),
            "feedback": F.when(value("thumbs_up") != 0, THUMBS_UP)
            .when(value("thumbs_down") != 0, THUMBS_DOWN)
            .otherwise(NO_FEEDBACK),
        },
    )


def with_transcript(df: DataFrame) -> DataFrame:
    return df.withColumn("transcript", transcript(df))


Templates = dict[str, PromptTemplate]


def _requests(own: Templates | None) -> dict[str, tuple[PromptTemplate, dict, str]]:
    """Per task: template, constant variables, and the variable that takes the transcript.

    ``own`` replaces templates by task: summary, sentiment or topic.
    """
    templates = {
        "summary": get_template("summarization", 2),
        "sentiment": get_template("sentiment", 1),
        "topic": get_template("topic_classification", 1),
        **(own or {}),
    }
    return {
        "summary": (templates["summary"], {"max_words": MAX_SUMMARY_WORDS}, "transcript"),
        "sentiment": (templates["sentiment"], {}, "conversation"),
        "topic": (templates["topic"], {"topic_list": TOPIC_LIST}, "conversation"),
    }


def with_messages(df: DataFrame, templates: Templates | None = None) -> DataFrame:
    """Add the chat messages of every task, rendered from ``transcript``."""
    return df.withColumns(
        {
            f"{task}_messages": template.messages(**constants, **{slot: F.col("transcript")})
            for task, (template, constants, slot) in _requests(templates).items()
        }
    )


TASKS = ["summary", "sentiment", "topic"]
REPLY_SCHEMA = T.StructType(
    [
        T.StructField(f"{task}{part}", kind)
        for task in TASKS
        for part, kind in (
            ("", T.StringType()),
            ("_error", T.StringType()),
            ("_prompt_tokens", T.LongType()),
            ("_completion_tokens", T.LongType()),
        )
    ]
)
# Columns of an annotated row that tell which calls failed; a row without any is finished.
CALL_ERRORS = [f"llm_{task}_call_error" for task in TASKS]


def prepared(templates: Templates | None = None) -> dict[str, tuple]:
    """Per task, what its calls have in common: template key, prompt text by role with the transcript left
    open, most tokens and temperature."""
    return {
        task: (
            template.key,
            template.render_text(**constants, **{slot: "${transcript}"}),
            template.max_tokens,
            template.temperature,
        )
        for task, (template, constants, slot) in _requests(templates).items()
    }


def call_of(request: tuple, text: str) -> tuple:
    """The arguments of a scorer for a prepared request and a transcript."""
    key, prompt, max_tokens, temperature = request
    messages = [
        {"role": role, "content": prompt[role].replace("${transcript}", text)}
        for role in ("system", "user")
    ]
    return key, messages, max_tokens, temperature


def ask_model(
    scorer_factory: ScorerFactory,
    templates: Templates | None = None,
    in_flight: int = 10,
    retry: Retry | None = None,
) -> Callable[[Column], Column]:
    """Column function from transcript to the raw reply of every task, its error and its tokens.

    Only the transcript travels to Python; the fixed prompt text is filled in there. A task process
    keeps up to ``in_flight`` calls under way in threads, so a scorer has to be safe to call from
    several at once. A call that fails for a passing reason is made again, see ``calls.Retry``; one that
    fails for good leaves a null reply and an error text, on a row that is kept. The function is marked
    non-deterministic, so that the optimizer never calls the model twice for one row; a retried task
    does, so a scorer must be safe to repeat.
    """
    requests, names = list(prepared(templates).values()), REPLY_SCHEMA.names
    retry = retry or Retry()

    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        caller = Caller(scorer_factory(), in_flight, retry)
        calls = ([call_of(r, text) for text in texts for r in requests] for texts in batches)
        for answers in caller.batches(calls):
            cells = [cell for answer in answers for cell in answer]
            yield pd.DataFrame({name: cells[k :: len(names)] for k, name in enumerate(names)}, dtype=object)

    # annotations are resolved by name in this module, which workers may not have
    ask.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(ask, REPLY_SCHEMA).asNondeterministic()


def parse_replies(
    df: DataFrame, summary: str, sentiment: str, topic: str, call_error: str | None = None
) -> DataFrame:
    """Add the annotation columns read from three reply columns.

    The parsed objects are columns of their own at first, so that each reply is parsed once.
    """
    parsed = df.withColumns(
        {
            "__summary_object": replies.as_object(F.col(summary), replies.SUMMARY),
            "__sentiment_object": replies.as_object(F.col(sentiment), replies.SENTIMENT),
            "__topic_object": replies.as_object(F.col(topic), replies.TOPIC),
        }
    )
    fields = {
        **replies.summary_fields(F.col(summary), F.col("__summary_object")),
        **replies.sentiment_fields(F.col("__sentiment_object")),
        **replies.topic_fields(F.col("__topic_object")),
    }
    if call_error:
        fields["llm_processing_error"] = F.coalesce(
            F.col(call_error), fields["llm_processing_error"]
        )
    return parsed.withColumns(fields).drop(
        "__summary_object", "__sentiment_object", "__topic_object"
    )


def annotate(
    df: DataFrame,
    scorer_factory: ScorerFactory | None = None,
    concurrency: int = 10,
    share_replies: bool = False,
    templates: Templates | None = None,
    retry: Retry | None = None,
) -> DataFrame:
    """Every input row with its ``llm_*`` columns.

    ``concurrency`` is the number of calls each task keeps under way; rows stay in the partitions they
    are in. ``share_replies`` asks once per distinct transcript and gives rows with the same transcript
    the same reply. Transcripts name a channel, a response type, a score of two decimals, a number of
    turns and two outcomes, so there are far fewer of them than rows; ``df`` is then read twice and
    should be a stored table. ``templates`` replaces the prompts of the summary, sentiment or topic
    task.

    ``llm_summary_call_error`` and its like say why a call failed, and ``llm_usage`` lists the tokens
    of the calls whose scorer reports them. Under ``share_replies`` the tokens stand on every row that
    shares a reply, though they were used once. ``retry`` says when a call is made again. Replies are kept
    from run to run by ``reply_store.annotate_from_store``.
    """
    told = df.withColumn("__transcript", transcript(df))
    requests = told.select("__transcript").distinct() if share_replies else told
    ask = ask_model(scorer_factory or offline_scorer(), templates, concurrency, retry)
    asked = requests.withColumn("__reply", ask(F.col("__transcript")))
    if share_replies:
        asked = spread_join(told, asked, ["__transcript"], "left")
    return with_replies(asked)


def with_replies(asked: DataFrame) -> DataFrame:
    """Rows with ``__transcript`` and ``__reply``, the struct that ``ask_model`` gives, as annotated rows."""
    flat = asked.withColumns(
        {f"__{name}": F.col(f"__reply.{name}") for name in REPLY_SCHEMA.names}
    )
    parsed = parse_replies(flat, "__summary", "__sentiment", "__topic", "__summary_error")
    usage = F.array(
        *[
            F.struct(
                F.lit(task).alias("task"),
                F.col(f"__{task}_prompt_tokens").alias("prompt_tokens"),
                F.col(f"__{task}_completion_tokens").alias("completion_tokens"),
            )
            for task in TASKS
        ]
    )
    known = F.filter(usage, lambda call: call["prompt_tokens"].isNotNull())
    errors = {f"llm_{task}_call_error": F.col(f"__{task}_error") for task in TASKS}
    return parsed.withColumns({**errors, "llm_usage": known}).drop(
        "__transcript", "__reply", *[f"__{name}" for name in REPLY_SCHEMA.names]
    )


def usage_calls(annotated: DataFrame, model: str, *keep: str) -> DataFrame:
    """One row per call whose tokens are known, as the cost operators take them: ``keep``, task, model
    and tokens."""
    calls = annotated.select(*keep, F.explode("llm_usage").alias("__call"))
    # not a constant, which would make the lookup of its price a join without a key
    named = F.when(F.col("__call.prompt_tokens").isNotNull(), model).alias("model")
    return calls.select(
        *keep, "__call.task", named, "__call.prompt_tokens", "__call.completion_tokens"
    )


def not_yet_annotated(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not among the finished ones, to resume an interrupted run.

    A row of ``done`` is finished if none of its calls failed, as far as it tells.
    """
    told = [F.col(c).isNull() for c in CALL_ERRORS if c in done.columns]
    finished = done.filter(reduce(lambda a, b: a & b, told)) if told else done
    return spread_join(df, finished.select(*keys).distinct(), keys, "left_anti")


def offline_scorer() -> ScorerFactory:
    """A scorer without a network: fixed rules over the transcript, for dry runs and tests.

    It reports a token for every four characters of the prompt, and three quarters of the tokens a
    reply may have at most.
    """

    def make() -> Scorer:
        def answer(key: str, messages: list[dict], max_tokens: int, temperature: float) -> str:
            user = messages[-1]["content"]
            escalated, unhappy = ESCALATED in user, THUMBS_DOWN in user
            if key == "summarization":
                return json.dumps(
                    {
                        "summary": "Customer asked for account help.",
                        "core_issue": "account issue",
                        "outcome": "ESCALATED" if escalated else "RESOLVED",
                    }
                )
            if key == "sentiment":
                negative = escalated or unhappy
                return json.dumps(
                    {
                        "overall_sentiment": "NEGATIVE" if negative else "NEUTRAL",
                        "sentiment_score": -0.5 if negative else 0.0,
                        "frustration_signal": unhappy,
                        "urgency_signal": False,
                        "churn_risk": "HIGH" if escalated and unhappy else "LOW",
                    }
                )
            return json.dumps({"topic": "Account Management", "confidence": 0.5})

        def score(key: str, messages: list[dict], max_tokens: int, temperature: float) -> tuple:
            size = sum(len(message["content"]) for message in messages)
            return answer(key, messages, max_tokens, temperature), size // 4, max_tokens * 3 // 4

        return score

    return make
