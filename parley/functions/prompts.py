"""Versioned prompt templates, rendered as column expressions.

The wording is this library's own. What other code relies on is fixed: the task names and versions,
their ``${variables}``, and the fields a reply has to carry.
"""

from __future__ import annotations

from dataclasses import dataclass
from string import Template

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PromptTemplate:
    key: str
    version: int
    system: str
    user: str
    output_format: str
    max_tokens: int
    temperature: float

    def variables(self) -> list[str]:
        """Names the two texts refer to, in order of first use."""
        names = Template(self.system).get_identifiers() + Template(self.user).get_identifiers()
        return list(dict.fromkeys(names))

    def _require(self, values: dict) -> None:
        missing = [name for name in self.variables() if name not in values]
        if missing:
            raise KeyError(f"{self.key} v{self.version} needs {', '.join(missing)}")

    def render_text(self, **values) -> dict[str, str]:
        """Both texts with plain values filled in."""
        self._require(values)
        return {
            "system": Template(self.system).substitute(values),
            "user": Template(self.user).substitute(values),
        }

    def render(self, **values) -> dict[str, Column]:
        """Both texts as columns; values are columns or constants. A missing one is an error now."""
        self._require(values)
        return {
            "system": fill_template(self.system, values),
            "user": fill_template(self.user, values),
        }

    def messages(self, **values) -> Column:
        """Chat messages as ``array<struct<role, content>>``."""
        texts = self.render(**values)
        return F.array(
            *[
                F.struct(F.lit(role).alias("role"), texts[role].alias("content"))
                for role in ("system", "user")
            ]
        )


def fill_template(text: str, values: dict) -> Column:
    """Template text as a concatenation of constants and columns; a null value reads 'unknown'."""
    parts: list[Column] = []
    constant = ""
    position = 0
    for found in Template.pattern.finditer(text):
        constant += text[position : found.start()]
        position = found.end()
        name = found["named"] or found["braced"]
        if name is None:
            constant += "$"
        elif isinstance(values[name], Column):
            filled = F.coalesce(values[name].cast("string"), F.lit("unknown"))
            parts += [F.lit(constant), filled]
            constant = ""
        else:
            constant += str(values[name])
    parts.append(F.lit(constant + text[position:]))
    return F.concat(*parts)


_JSON_ONLY = "Reply with one JSON object and nothing around it."

# Keys, versions, variables, output formats, token limits and temperatures.
TEMPLATES = [
    PromptTemplate(
        key="summarization",
        version=1,
        system="You write short, neutral summaries of support chats for business reporting.",
        user=(
            "Sum up this chat between a customer and a bot in no more than ${max_words} words. "
            "Say what the customer needed, what the bot did about it and how it ended.\n\n"
            "${transcript}\n\nSummary:"
        ),
        output_format="text",
        max_tokens=200,
        temperature=0.1,
    ),
    PromptTemplate(
        key="summarization",
        version=2,
        system=f"You analyse support chats. {_JSON_ONLY}",
        user=(
            "Read this support chat and fill these fields:\n"
            "summary: neutral text of at most ${max_words} words\n"
            "core_issue: the main problem in at most ten words\n"
            "outcome: RESOLVED, ESCALATED, UNRESOLVED or PARTIAL\n"
            "sentiment: POSITIVE, NEUTRAL, NEGATIVE or MIXED\n"
            "key_entities: list of at most five names that matter\n\n"
            "${transcript}\n\nJSON:"
        ),
        output_format="json",
        max_tokens=300,
        temperature=0.0,
    ),
    PromptTemplate(
        key="topic_classification",
        version=1,
        system=f"You sort support chats into given topics. {_JSON_ONLY}",
        user=(
            "Choose the one topic that fits this chat best. The topics are:\n${topic_list}\n\n"
            "Fill these fields:\n"
            "topic: a topic exactly as written above\n"
            "confidence: how sure you are, from 0 to 1\n"
            "reasoning: one sentence\n\n"
            "${conversation}\n\nJSON:"
        ),
        output_format="json",
        max_tokens=150,
        temperature=0.0,
    ),
    PromptTemplate(
        key="agent_scoring",
        version=1,
        system=f"You review how human agents handled escalated chats. {_JSON_ONLY}",
        user=(
            "Rate the agent in this escalated chat from 1 (poor) to 5 (excellent). Fields:\n"
            "empathy_score, resolution_score, efficiency_score, professionalism_score: integers\n"
            "overall_score: mean of the four\n"
            "coaching_notes: one thing to do better\n\n"
            "${transcript}\n\n"
            "The agent took ${handle_seconds} seconds; the unit is ${business_unit}.\n\nJSON:"
        ),
        output_format="json",
        max_tokens=250,
        temperature=0.1,
    ),
    PromptTemplate(
        key="sentiment",
        version=1,
        system=f"You judge customer mood in support chats and flag only clear signs. {_JSON_ONLY}",
        user=(
            "Judge the customer's mood in this chat. Fields:\n"
            "overall_sentiment: POSITIVE, NEUTRAL, NEGATIVE or MIXED\n"
            "sentiment_score: from -1 (very negative) to 1 (very positive)\n"
            "frustration_signal: true or false\n"
            "urgency_signal: true or false\n"
            "churn_risk: LOW, MEDIUM or HIGH\n\n"
            "${conversation}\n\nJSON:"
        ),
        output_format="json",
        max_tokens=150,
        temperature=0.0,
    ),
    PromptTemplate(
        key="insight",
        version=1,
        system="You explain customer service figures to business leaders, with evidence.",
        user=(
            "These are the customer service figures for ${time_period}:\n\n${metrics_json}\n\n"
            "List three to five insights. For each give the observation, what it means for the "
            "business and one action.\n\nInsights:"
        ),
        output_format="text",
        max_tokens=600,
        temperature=0.3,
    ),
]


def get_template(key: str, version: int | None = None) -> PromptTemplate:
    """A template by task; without a version, the latest."""
    versions = {t.version: t for t in TEMPLATES if t.key == key}
    wanted = max(versions, default=None) if version is None else version
    if wanted not in versions:
        raise ValueError(f"no template {key!r} v{version}; versions: {sorted(versions)}")
    return versions[wanted]
