"""The registered queries as SQL for DuckDB, written independently of the operators.

Constants of the reports (prompt wording, allowed values, thresholds) are shared; logic is not.
"""

from __future__ import annotations

import re

from catalog.inputs import with_clause
from catalog.queries import RUN_TS
from parley.functions.prompts import TEMPLATES, get_template
from parley.functions.replies import INVALID_REPLY
from parley.functions.text import MASKS
from parley.operators import annotate, quality
from parley.operators.topics import TOPIC_TABLE_HEADINGS
from parley.sources.schemas import BUSINESS_UNITS, CHANNELS, TOPICS

CHAT, CLICKS, META = "chatbot_interactions", "clickstream_events", "conversation_metadata"


def _lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _expand_display(sql: str) -> str:
    """Spell ``display(x, n)`` out: half to even, after cutting six digits further down."""
    while "display(" in sql:
        start = sql.rindex("display(")
        depth, at = 1, start + len("display(")
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[at], 0)
            at += 1
        value, places = sql[start + len("display(") : at - 1].rsplit(",", 1)
        n = int(places)
        exact = f"CAST(round_even(CAST({value} AS DECIMAL(38, {n + 6})), {n}) AS DOUBLE)"
        sql = sql[:start] + exact + sql[at:]
    return sql


def _with(*tables: str, **more: str) -> str:
    extra = "".join(f",\n{name} AS ({body})" for name, body in more.items())
    return with_clause(*tables) + extra + "\n"


def _from(table: str, select: str, tail: str = "") -> str:
    return f"{_with(table)}SELECT {select} FROM {table} {tail}"


# --- shared pieces -----------------------------------------------------------------------------

TURN_TS = "TRY_CAST(created_at AS TIMESTAMP)"
SESSION_TS = "TRY_CAST(session_start AS TIMESTAMP)"
HAS_KEYS = "contact_id IS NOT NULL AND session_id IS NOT NULL"

CLEAN_CHAT = f"""
SELECT * REPLACE (trim(business_unit, ' ') AS business_unit,
                  trim(application_channel, ' ') AS application_channel)
FROM {CHAT} WHERE {HAS_KEYS}"""

CLICK_SESSIONS = f"""
SELECT contact_id, session_id, count(*) AS click_event_count,
       CAST(sum(is_bounce) AS BIGINT) AS bounce_events,
       display(avg(scroll_depth_pct), 4) AS avg_scroll_depth_pct,
       CAST(sum(time_on_page_seconds) AS BIGINT) AS total_time_on_page_seconds,
       count(DISTINCT page_name) AS unique_pages_visited,
       count(DISTINCT event_type) AS unique_event_types
FROM {CLICKS} WHERE {HAS_KEYS} GROUP BY contact_id, session_id"""


def _clean_meta(table: str) -> str:
    return f"""
SELECT contact_id, session_id, topic_name AS meta_topic_name, business_unit AS meta_business_unit,
       application_channel AS meta_channel, language, num_turns, contained,
       escalated_to_agent AS meta_escalated, csat_score, queue_name, session_duration_seconds,
       confidence_score AS meta_confidence_score,
       derived_resolution_score AS meta_resolution_score, session_start
FROM {table} WHERE {HAS_KEYS}"""


LATEST_META = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY contact_id, session_id
                               ORDER BY TRY_CAST(session_start AS TIMESTAMP) DESC NULLS LAST) AS rn
  FROM repeated_metadata) WHERE rn = 1"""

UNIFIED = f"""
SELECT j.*,
  coalesce(confidence_score, meta_confidence_score) AS effective_confidence_score,
  CASE WHEN derived_resolution_score >= 0.7 THEN 'HIGH'
       WHEN derived_resolution_score >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS resolution_tier,
  CASE WHEN coalesce(escalated_to_agent, 0) = 0 AND coalesce(meta_escalated, 0) = 0
            AND coalesce(contained, 1) = 1 THEN 1 ELSE 0 END AS is_self_served,
  round(coalesce(confidence_score, meta_confidence_score, 0.0) * CAST(0.35 AS DOUBLE)
        + coalesce(derived_resolution_score, 0.0) * CAST(0.35 AS DOUBLE)
        + (1 - CAST(coalesce(escalated_to_agent, 0) AS DOUBLE)) * CAST(0.15 AS DOUBLE)
        + CAST(coalesce(thumbs_up, 0) AS DOUBLE) * CAST(0.15 AS DOUBLE), 4)
    AS session_quality_score,
  {TURN_TS} AS created_at_ts,
  CAST(year({TURN_TS}) AS VARCHAR) AS "year",
  lpad(CAST(month({TURN_TS}) AS VARCHAR), 2, '0') AS "month",
  lpad(CAST(day({TURN_TS}) AS VARCHAR), 2, '0') AS "day",
  '{RUN_TS}' AS pipeline_run_at
FROM (SELECT * FROM clean_chat LEFT JOIN clean_meta USING (contact_id, session_id)
      LEFT JOIN click_sessions USING (contact_id, session_id)) j"""

WITH_UNIFIED = _with(
    CHAT, CLICKS, META,
    clean_chat=CLEAN_CHAT,
    clean_meta=_clean_meta(META),
    click_sessions=CLICK_SESSIONS,
    unified=UNIFIED,
)


def _unified(*names: str) -> str:
    return f"{WITH_UNIFIED}SELECT contact_id, session_id, created_at, {', '.join(names)} FROM unified"


def _joined_metadata(meta: str) -> str:
    ctes = _with(
        CHAT, "repeated_metadata", clean_chat=CLEAN_CHAT, latest=LATEST_META,
        clean_meta=_clean_meta(meta),
    )
    return f"""{ctes}SELECT contact_id, session_id, created_at, topic_name, num_turns,
       meta_topic_name FROM clean_chat LEFT JOIN clean_meta USING (contact_id, session_id)"""


RATED = "(thumbs_up = 1 OR thumbs_down = 1)"
TURN_KPIS = """count(*) AS total_chatbot_turns,
  display(avg(escalated_to_agent) * 100, 2) AS escalation_rate_chatbot,
  display(avg(confidence_score), 4) AS avg_confidence_score,
  display(avg(handle_seconds_dur), 1) AS avg_handle_seconds,
  display(avg(derived_resolution_score), 4) AS avg_resolution_score"""
FEEDBACK_KPIS = f"""
  display(sum(thumbs_up) FILTER ({RATED}) / nullif(count(*) FILTER ({RATED}), 0) * 100, 2)
    AS thumbs_up_rate,
  display(sum(thumbs_down) FILTER ({RATED}) / nullif(count(*) FILTER ({RATED}), 0) * 100, 2)
    AS thumbs_down_rate,
  count(*) FILTER ({RATED}) AS feedback_volume"""
SESSION_KPIS = """count(*) AS total_sessions,
  display(avg(contained) * 100, 2) AS containment_rate,
  display(avg(escalated_to_agent) * 100, 2) AS escalation_rate_session,
  display(avg(num_turns), 2) AS avg_turns_per_session,
  display(avg(session_duration_seconds), 1) AS avg_session_duration_seconds"""
CSAT_KPIS = """display(avg(csat_score), 2) AS avg_csat_score,
  display(count(csat_score) / nullif(count(*), 0) * 100, 2) AS csat_response_rate"""

RETAIL_WEB_ECHO = {
    "business_unit": "retail",
    "application_channel": "WEB",
    "start_date": "2024-01-05",
    "end_date": "2024-01-20",
}
RETAIL_WEB_WHERE = (
    "lower(business_unit) = 'retail' AND lower(application_channel) = 'web' "
    "AND {ts} >= TIMESTAMP '2024-01-05' AND {ts} <= TIMESTAMP '2024-01-20'"
)
DASHBOARD_WHERE = (
    "business_unit = 'Healthcare' AND CAST({ts} AS DATE) BETWEEN DATE '2024-01-03' "
    "AND DATE '2024-01-17'"
)
FULL_WEEKS_WHERE = "CAST({ts} AS DATE) <= DATE '2024-01-28'"


def _kpi_report(where: str, echo: dict[str, str]) -> str:
    turns = where.format(ts=TURN_TS)
    sessions = where.format(ts=SESSION_TS)
    ctes = _with(
        CHAT, META,
        t=f"SELECT {TURN_KPIS}, {FEEDBACK_KPIS} FROM {CHAT} WHERE {turns}",
        m=f"SELECT {SESSION_KPIS}, {CSAT_KPIS} FROM {META} WHERE {sessions}",
    )
    shown = ", ".join(f"{_lit(v)} AS filter_{k}" for k, v in echo.items())
    return f"""{ctes}SELECT CASE WHEN total_chatbot_turns + total_sessions = 0 THEN 'NO_DATA'
       ELSE 'OK' END AS status, t.*, m.*, {shown} FROM t, m"""


_ALL = {"business_unit": "ALL", "application_channel": "ALL", "start_date": "ALL", "end_date": "ALL"}

KPI_KEYS = [
    "total_chatbot_turns", "escalation_rate_chatbot", "avg_confidence_score", "avg_handle_seconds",
    "avg_resolution_score", "thumbs_up_rate", "thumbs_down_rate", "feedback_volume",
    "total_sessions", "containment_rate", "escalation_rate_session", "avg_turns_per_session",
    "avg_session_duration_seconds", "avg_csat_score", "csat_response_rate",
]


def _metrics_json(echo: dict[str, str]) -> str:
    keys = ", ".join(f"'{k}', {k}" for k in KPI_KEYS)
    shown = ", ".join(f"'{k}', {_lit(v)}" for k, v in echo.items())
    return f"CAST(json_object({keys}, 'filters_applied', json_object({shown})) AS VARCHAR)"


def _cube() -> str:
    keys = """lower(business_unit) AS bk, lower(application_channel) AS ck,
       grouping(lower(business_unit), lower(application_channel)) AS g,
       min(business_unit) AS bu, min(application_channel) AS ch"""
    by = "GROUP BY CUBE (lower(business_unit), lower(application_channel))"
    ctes = _with(
        CHAT, META,
        t=f"SELECT {keys}, {TURN_KPIS}, {FEEDBACK_KPIS} FROM {CHAT} {by}",
        m=f"SELECT {keys}, {SESSION_KPIS}, {CSAT_KPIS} FROM {META} {by}",
    )
    zero = ("total_chatbot_turns", "feedback_volume", "total_sessions")
    shown = ", ".join(f"coalesce({k}, 0) AS {k}" if k in zero else k for k in KPI_KEYS)
    return f"""{ctes}SELECT
  CASE WHEN coalesce(t.g, m.g) >= 2 THEN 'ALL' ELSE least(t.bu, m.bu) END AS business_unit,
  CASE WHEN coalesce(t.g, m.g) % 2 = 1 THEN 'ALL' ELSE least(t.ch, m.ch) END AS application_channel,
  CAST(coalesce(t.g, m.g) AS INTEGER) AS grouping_level, {shown}
FROM t FULL JOIN m ON t.g = m.g AND t.bk IS NOT DISTINCT FROM m.bk
  AND t.ck IS NOT DISTINCT FROM m.ck"""


TOPIC_MEASURES = """topic_name, count(*) AS volume,
  CAST(sum(escalated_to_agent) AS BIGINT) AS escalation_count,
  CAST(sum(thumbs_up) AS BIGINT) AS thumbs_up_count,
  CAST(sum(thumbs_down) AS BIGINT) AS thumbs_down_count,
  display(avg(confidence_score), 4) AS avg_confidence_score,
  display(avg(derived_resolution_score), 4) AS avg_resolution_score,
  display(avg(handle_seconds_dur), 1) AS avg_handle_seconds,
  display(sum(escalated_to_agent) / count(*) * 100, 2) AS escalation_rate_pct,
  display(sum(thumbs_up) / count(*) * 100, 2) AS thumbs_up_rate_pct,
  display(sum(thumbs_down) / count(*) * 100, 2) AS thumbs_down_rate_pct"""
BY_TOPIC = "topic_name IS NOT NULL GROUP BY topic_name"

SESSION_QUALITY = """topic_name,
  CASE WHEN avg(derived_resolution_score) >= 0.65 THEN 'HIGH'
       WHEN avg(derived_resolution_score) >= 0.40 THEN 'MEDIUM' ELSE 'LOW' END
    AS resolution_quality,
  display(avg(derived_resolution_score), 4) AS avg_resolution,
  count(*) AS session_count"""


def _trend(where: str = "TRUE") -> dict[str, str]:
    """CTEs ending in ``trend``."""
    return {
        "weekly": f"""SELECT topic_name, isoyear({TURN_TS}) * 100 + week({TURN_TS}) AS wk
                      FROM {CHAT} WHERE {where}""",
        "weeks": """SELECT wk, row_number() OVER (ORDER BY wk DESC) AS age
                    FROM (SELECT DISTINCT wk FROM weekly WHERE wk IS NOT NULL)""",
        "volumes": """SELECT topic_name, count(*) FILTER (age = 2) AS prev,
                             count(*) FILTER (age = 1) AS cur
                      FROM weekly LEFT JOIN weeks USING (wk)
                      WHERE topic_name IS NOT NULL GROUP BY topic_name""",
        "trend": """SELECT topic_name, prev AS previous_volume, cur AS current_volume,
                      CASE WHEN (SELECT count(*) FROM weeks) < 2 THEN 'UNKNOWN'
                           WHEN prev = 0 THEN 'NEW'
                           WHEN cur > prev * CAST(1.10 AS DOUBLE) THEN 'TRENDING_UP'
                           WHEN cur < prev * CAST(0.90 AS DOUBLE) THEN 'TRENDING_DOWN'
                           ELSE 'STABLE' END AS wow_trend
                    FROM volumes""",
    }


def _trending(n: int, order: str, where: str = "TRUE") -> str:
    turns, sessions = where.format(ts=TURN_TS), where.format(ts=SESSION_TS)
    return _with(
        CHAT, META,
        lead_topics=f"""SELECT {TOPIC_MEASURES} FROM {CHAT} WHERE ({turns}) AND {BY_TOPIC}
                    ORDER BY {order} DESC, topic_name LIMIT {n}""",
        sq=f"SELECT {SESSION_QUALITY} FROM {META} WHERE ({sessions}) AND {BY_TOPIC}",
        **_trend(turns),
    )


def _topics_json() -> str:
    """All ten topics by escalation rate, with quality and trend; one has no confidence score."""
    figures = """json_object('topic', topic_name, 'volume', volume,
      'escalation_rate_pct', escalation_rate_pct, 'thumbs_up_rate_pct', thumbs_up_rate_pct,
      'thumbs_down_rate_pct', thumbs_down_rate_pct, 'avg_confidence_score', avg_confidence_score,
      'avg_resolution_score', avg_resolution_score, 'avg_handle_seconds', avg_handle_seconds"""
    quality = """'resolution_quality_breakdown', json_object('resolution_quality', resolution_quality,
        'avg_resolution', avg_resolution, 'session_count', session_count)"""
    trend = "'wow_trend', coalesce(wow_trend, 'UNKNOWN'))"
    entry = f"""CASE WHEN resolution_quality IS NULL THEN {figures}, {trend}
      ELSE {figures}, {quality}, {trend} END"""
    order = "ORDER BY escalation_rate_pct DESC, topic_name"
    return f"""{_trending(10, 'escalation_rate_pct')}SELECT CAST(json_object(
      'summary', json_object(
        'top_topic_by_volume', first(topic_name {order}),
        'total_records_in_result', CAST(sum(volume) AS BIGINT),
        'sort_by', 'escalation_rate',
        'filters', json_object('business_unit', 'ALL', 'application_channel', 'ALL')),
      'topics', list({entry} {order})) AS VARCHAR) AS document
    FROM lead_topics LEFT JOIN sq USING (topic_name) LEFT JOIN trend USING (topic_name)"""


def _daily(where: str, value: str, missing: str, name: str) -> str:
    ctes = _with(
        CHAT,
        daily=f"""SELECT CAST({TURN_TS} AS DATE) AS d, {value} AS v FROM {CHAT}
                  WHERE {where} AND {TURN_TS} IS NOT NULL GROUP BY 1""",
        span="SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM daily",
    )
    return f"""{ctes}SELECT CAST(d AS VARCHAR) AS "date", CASE WHEN daily.d IS NULL THEN {missing} ELSE v END AS {name}
    FROM span LEFT JOIN daily USING (d)"""


# --- data quality ------------------------------------------------------------------------------


def _row(source, check, column, status, observed, threshold, message, table) -> str:
    shown = "CAST(NULL AS VARCHAR)" if column is None else _lit(column)
    return f"""SELECT '{source}' AS source, '{check}' AS "check", {shown} AS "column",
      {status} AS status, CAST({observed} AS DOUBLE) AS observed, {_lit(threshold)} AS threshold,
      {message} AS message FROM {table}"""


def _quality_rows(rules: quality.RuleSet, table: str | None = None) -> list[str]:
    table = table or rules.source
    source = rules.source
    total = "count(*)"
    rows = [
        _row(source, "schema", None, "'OK'", "0", f"{len(rules.required)} columns",
             "'all required columns present'", f"(SELECT {total} FROM {table})"),
        _row(source, "not_empty", None, f"CASE WHEN {total} = 0 THEN 'FAIL' ELSE 'OK' END", total,
             "> 0 rows", f"concat({total}, ' rows')", table),
    ]
    for c in rules.critical:
        share = f"(count(*) FILTER ({c} IS NULL) / count(*))"
        rows.append(
            _row(source, "nulls", c, f"CASE WHEN {share} > CAST(0.05 AS DOUBLE) THEN 'FAIL' ELSE 'OK' END",
                 f"display({share}, 6)", "<= 5%",
                 f"concat(printf('%.1f', {share} * 100), '% of values are null')", table)
        )
    bounds = [(r.column, r.low, r.high) for r in rules.ranges]
    if rules.check_confidence:
        bounds.append(("confidence_score", 0.0, 1.0))
        mean = "avg(confidence_score)"
        rows.append(
            _row(source, "mean_confidence", "confidence_score",
                 f"CASE WHEN {mean} < CAST(0.4 AS DOUBLE) THEN 'WARN' ELSE 'OK' END",
                 f"display({mean}, 4)", ">= 0.4",
                 f"concat('mean confidence ', printf('%.4f', {mean}))", table)
        )
    for c, values in rules.allowed.items():
        listed = ", ".join(_lit(v) for v in values)
        bad = f"count(*) FILTER ({c} NOT IN ({listed}))"
        rows.append(
            _row(source, "category", c, f"CASE WHEN {bad} > 0 THEN 'WARN' ELSE 'OK' END", bad,
                 ", ".join(sorted(values)), f"concat({bad}, ' rows with unexpected values')", table)
        )
    for c, low, high in bounds:
        tests = [f"{c} < {low}"] * (low is not None) + [f"{c} > {high}"] * (high is not None)
        bad = f"count(*) FILTER ({' OR '.join(tests)})"
        limits = f"[{'-inf' if low is None else low}, {'inf' if high is None else high}]"
        rows.append(
            _row(source, "range", c, f"CASE WHEN {bad} > 0 THEN 'FAIL' ELSE 'OK' END", bad, limits,
                 f"concat({bad}, ' values outside {limits}')", table)
        )
    return rows + _duplicate_rows(rules, table)


def _duplicate_rows(rules: quality.RuleSet, table: str) -> list[str]:
    keys = ", ".join(rules.keys)
    copies = f"""(SELECT (SELECT count(*) FROM {table}) AS n,
                         (SELECT count(*) FROM (SELECT DISTINCT * FROM {table})) AS d)"""
    groups = f"""(SELECT count(*) AS g FROM (SELECT {keys} FROM {table} GROUP BY {keys}
                                             HAVING count(*) > 1))"""
    return [
        _row(rules.source, "duplicate_rows", None, "CASE WHEN n - d > 0 THEN 'WARN' ELSE 'OK' END",
             "n - d", "0 copies",
             "concat(n - d, ' surplus copies (', printf('%.2f', (n - d) / n * 100), '%)')", copies),
        _row(rules.source, "duplicate_keys", keys, "CASE WHEN g > 0 THEN 'WARN' ELSE 'OK' END", "g",
             "0 keys", "concat(g, ' keys held by several rows')", groups),
    ]


CHAT_REPORT = " UNION ALL ".join(_quality_rows(quality.CHATBOT_RULES))
CLICK_REPORT = " UNION ALL ".join(_quality_rows(quality.CLICKSTREAM_RULES))
META_REPORT = " UNION ALL ".join(_quality_rows(quality.METADATA_RULES))
ALL_REPORT = " UNION ALL ".join((CHAT_REPORT, CLICK_REPORT, META_REPORT))


def _report(body: str, where: str, *tables: str) -> str:
    return f"{_with(*tables, report=body)}SELECT * FROM report WHERE {where}"


def _recency(source: str, column: str, hours: int) -> str:
    newest = f"max(TRY_CAST({column} AS TIMESTAMP))"
    age = f"round(date_diff('second', {newest}, TIMESTAMP '2024-02-01 00:00:00') / 3600, 2)"
    # sub-second parts are absent, so whole seconds are exact
    return _row(source, "recency", column, f"CASE WHEN {age} > {hours} THEN 'WARN' ELSE 'OK' END",
                age, f"<= {hours} h", f"concat('newest event at ', CAST({newest} AS VARCHAR))", source)


# --- text --------------------------------------------------------------------------------------

SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
S = f"[{SPACE}]"
INVISIBLE = "\u200b\u200c\u200d\u200e\u200f\ufeff"
START, END = r"(?:^|[^\pL\pN_])", r"(?:$|[^\pL\pN_])"

PROMPT_RE = "|".join([
    rf"ignore{S}+(all{S}+)?previous{S}+instructions",
    rf"disregard{S}+(all{S}+)?prior{S}+instructions",
    rf"forget{S}+(all{S}+)?(previous|prior){S}+(instructions|rules|context)",
    rf"new{S}+(system{S}+)?prompt",
    rf"{START}DAN{END}",
    "jailbreak",
    rf"<{S}*system{S}*>",
    r"\[INST\]",
    rf"###{S}*instruction",
])
SQL_RE = "|".join([
    rf";{S}*(drop|delete|truncate|alter|create|insert|update){S}+",
    rf"{START}union{S}+select{END}",
    rf"{START}or{S}+1{S}*={S}*1{END}",
    rf"--{S}+",
    r"/\*.*?\*/",
])
SHELL_RE = "|".join([r"[|;&`$]", r"\$\(", r"\.\./", rf"(?:rm|del|format|shutdown|reboot){S}"])


def _hit(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, {_lit('(?is)' + pattern)})"


def _prompt_hit(text: str) -> str:
    """RE2 has no lookahead: take the allowed phrase out first, then look for the rest of it."""
    without = f"regexp_replace({text}, {_lit(f'(?is)you{S}+are{S}+now{S}an?{S}+AEP')}, '#', 'g')"
    return f"({_hit(text, PROMPT_RE)} OR {_hit(without, f'you{S}+are{S}+now{S}')})"


def _injection(text: str) -> str:
    return f"({_prompt_hit(text)} OR {_hit(text, SQL_RE)} OR {_hit(text, SHELL_RE)})"


def _strip(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '^{S}+', ''), '{S}+$', '')"


def _control(text: str) -> str:
    return rf"regexp_replace({text}, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g')"


def _normalize(text: str) -> str:
    return f"translate(nfc_normalize({text}), '{INVISIBLE}', '')"


def _collapse(text: str) -> str:
    return rf"regexp_replace(regexp_replace({text}, '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')"


def _mask(text: str) -> str:
    for pattern, replacement in MASKS:
        pattern = pattern.replace(r"[\w", r"[\pL\pN_").replace(r"\d", r"\p{Nd}")
        text = f"regexp_replace({text}, {_lit(pattern)}, {_lit(replacement)}, 'g')"
    return text


def _flags(table: str, keys: str) -> str:
    return f"""SELECT {keys}, {_prompt_hit('text')} AS prompt_hit, {_hit('text', SQL_RE)} AS sql_hit,
      {_hit('text', SHELL_RE)} AS shell_hit, {_injection('text')} AS injection FROM {table}"""


def _prepared(table: str, keys: str) -> str:
    return f"WITH prepared AS (SELECT {keys}, text, {_normalize(_control(_strip('text')))} AS p FROM {table})"


def _sanitized(table: str, keys: str) -> str:
    return f"""{_prepared(table, keys)}, judged AS (SELECT *, {_injection('p')} AS hit FROM prepared)
    SELECT {keys}, CASE WHEN hit THEN 'INJECTION' END AS reason,
      CASE WHEN hit THEN 'REJECTED' ELSE 'OK' END AS verdict,
      CASE WHEN NOT hit THEN {_collapse('p')} END AS clean FROM judged"""


LENGTH_VERDICT = f"""CASE WHEN text IS NULL THEN 'NOT_TEXT'
  WHEN length({_strip('text')}) < 2 THEN 'TOO_SHORT'
  WHEN length({_strip('text')}) > 500 THEN 'TOO_LONG' ELSE 'OK' END"""


def _filter_verdict(value: str) -> str:
    return f"""CASE WHEN {value} IS NULL THEN 'NOT_TEXT'
      WHEN length({_strip(value)}) > 100 THEN 'TOO_LONG'
      WHEN {_injection(_strip(value))} THEN 'INJECTION' ELSE 'OK' END"""


def _allowed_verdict(value: str, allowed: list[str]) -> str:
    listed = ", ".join(_lit(v.lower()) for v in allowed)
    return f"""CASE WHEN {_filter_verdict(value)} <> 'OK' THEN {_filter_verdict(value)}
      WHEN lower({_strip(value)}) IN ({listed}) THEN 'OK' ELSE 'UNKNOWN_VALUE' END"""


def _fill(template: str, **values: str) -> str:
    """Template text as a concatenation; values are SQL expressions."""
    pieces = re.split(r"\$\{(\w+)\}", template)
    parts = [
        values[p] if i % 2 else _lit(p) for i, p in enumerate(pieces) if i % 2 or p
    ]
    return " || ".join(parts) or "''"


TRANSCRIPT = _fill(
    annotate.TRANSCRIPT,
    channel="coalesce(application_channel, 'Web')",
    response="coalesce(response_type, 'FAQ')",
    confidence="printf('%.2f', coalesce(confidence_score, CAST(0.7 AS DOUBLE)))",
    exchanges="CAST(greatest(0, coalesce({turns}, 3) - 2) AS VARCHAR)",
    outcome=f"CASE WHEN coalesce(escalated_to_agent, 0) <> 0 THEN {_lit(annotate.ESCALATED)} ELSE {_lit(annotate.RESOLVED)} END",
    feedback=f"""CASE WHEN coalesce(thumbs_up, 0) <> 0 THEN {_lit(annotate.THUMBS_UP)}
                      WHEN coalesce(thumbs_down, 0) <> 0 THEN {_lit(annotate.THUMBS_DOWN)}
                      ELSE {_lit(annotate.NO_FEEDBACK)} END""",
)


def _json_object(reply: str) -> str:
    valid = f"CASE WHEN json_valid({reply}) THEN {reply} END"
    return f"CASE WHEN json_type({valid}) = 'OBJECT' THEN {reply} END"


PRICE_CASES = {
    "gpt-4o": (5.0, 15.0),
    "gpt-4o-mini": (0.15, 0.6),
    "gpt-4-turbo": (10.0, 30.0),
    "gpt-3.5-turbo": (0.5, 1.5),
}


def _price(side: int) -> str:
    cases = " ".join(f"WHEN '{m}' THEN CAST({p[side]} AS DOUBLE)" for m, p in PRICE_CASES.items())
    other = (0.5, 1.5)[side]
    return f"(CASE lower(model) {cases} ELSE CAST({other} AS DOUBLE) END)"


COST = (
    f"(prompt_tokens / CAST(1000000 AS DOUBLE) * {_price(0)} "
    f"+ completion_tokens / CAST(1000000 AS DOUBLE) * {_price(1)})"
)


def _usage(*groups: str) -> str:
    shown = ", ".join(f"CASE WHEN grouping({g}) = 1 THEN 'ALL' ELSE {g} END AS {g}" for g in groups)
    return f"""{_with('model_calls')}SELECT {shown}, count(*) AS calls,
      CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens,
      CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens,
      CAST(sum(prompt_tokens + completion_tokens) AS BIGINT) AS total_tokens,
      display(sum({COST}), 6) AS cost_usd
    FROM model_calls GROUP BY ROLLUP ({', '.join(groups)})"""


def _annotation_usage() -> str:
    """Tokens of the offline scorer: a quarter of the prompt's characters, and a constant per task."""
    told = "(" + TRANSCRIPT.replace("{turns}", "num_turns") + ")"
    tasks = [
        (get_template("summarization", 2), {"transcript": told, "max_words": f"'{annotate.MAX_SUMMARY_WORDS}'"}),
        (get_template("sentiment", 1), {"conversation": told}),
        (get_template("topic_classification", 1), {"conversation": told, "topic_list": _lit(annotate.TOPIC_LIST)}),
    ]
    calls = " UNION ALL ".join(
        f"""SELECT application_channel, 'gpt-4o-mini' AS model,
            (length({_lit(t.system)}) + length({_fill(t.user, **values)})) // 4 AS prompt_tokens,
            {t.max_tokens * 3 // 4} AS completion_tokens FROM unified"""
        for t, values in tasks
    )
    return _usage("application_channel", "model").replace(
        with_clause("model_calls"), f"{WITH_UNIFIED.rstrip()},\nmodel_calls AS ({calls})"
    )


def _run_times(kind: str) -> str:
    label = kind.capitalize()
    return f"""{_with('log_records')}SELECT {kind}, count(*) AS runs,
      count(*) FILTER (message = '{label} failed') AS failures,
      display(avg(elapsed_seconds), 3) AS mean_seconds, max(elapsed_seconds) AS max_seconds
    FROM log_records WHERE message IN ('{label} completed', '{label} failed') GROUP BY {kind}"""


TOPICS_SQL = ", ".join(_lit(t) for t in TOPICS)
LOG_FIELDS = '"timestamp", level, logger, service, step, block, elapsed_seconds, error'


TEMPLATE_VALUES = {
    "transcript": "text",
    "conversation": "text",
    "max_words": "'40'",
    "topic_list": _lit(annotate.TOPIC_LIST),
    "handle_seconds": "CAST(turn AS VARCHAR)",
    "business_unit": "role",
    "time_period": "'January'",
    "metrics_json": "text",
}


def oracles() -> dict[str, str]:
    rules = quality.CHATBOT_RULES
    sql = {
        # scans and sinks
        "a1_csv_scan": _from(CHAT, "*"),
        "a2_load_sources": f"""{_with(CHAT, CLICKS, META)}
            SELECT '{CHAT}' AS source, * FROM {CHAT}
            UNION ALL BY NAME SELECT '{CLICKS}' AS source, * FROM {CLICKS}
            UNION ALL BY NAME SELECT '{META}' AS source, * FROM {META}""",
        "a3_partitioned_parquet": f"{WITH_UNIFIED}SELECT * FROM unified",
        "a3_merged_batch": f"{WITH_UNIFIED}SELECT * FROM unified",
        "a4_parquet_sample": _from(CLICKS, "*", "ORDER BY ALL LIMIT 500"),
        "a5_csv_sample": _from(META, "*", "ORDER BY contact_id, session_id LIMIT 100"),
        "a6_json_lines": _from(
            META, "*, csat_score IS NULL AS null_csat_kept, queue_name IS NULL AS null_queue_kept"
        ),
        "a7_parsed_timestamps": f"""{_with(CHAT, META)}
            SELECT 'turn' AS kind, *, {TURN_TS} AS event_time FROM {CHAT}
            UNION ALL BY NAME SELECT 'session' AS kind, *, {SESSION_TS} AS event_time FROM {META}""",
        "a8_metrics_document": f"""SELECT {_metrics_json(RETAIL_WEB_ECHO)} AS document
            FROM ({_kpi_report(RETAIL_WEB_WHERE, RETAIL_WEB_ECHO)})""",
        "a8_topics_document": _topics_json(),
        "a9_row_counts": f"""{_with(CHAT, CLICKS, META)}
            SELECT '{CHAT}' AS source, count(*) AS "rows" FROM {CHAT}
            UNION ALL SELECT '{CLICKS}', count(*) FROM {CLICKS}
            UNION ALL SELECT '{META}', count(*) FROM {META}""",
        # cleaning
        "b1_clean_chatbot": f"{_with(CHAT)}{CLEAN_CHAT}",
        "b2_clean_clickstream": _from(CLICKS, "*", f"WHERE {HAS_KEYS}"),
        "b3_clean_metadata": f"{_with(META)}{_clean_meta(META)}",
        "b4_rated_turns": _from(CHAT, "*", f"WHERE {RATED}"),
        # derived columns
        "c1_effective_confidence": _unified(
            "confidence_score", "meta_confidence_score", "effective_confidence_score"
        ),
        "c2_resolution_tier": _unified("derived_resolution_score", "resolution_tier"),
        "c3_is_self_served": _unified("is_self_served"),
        "c4_session_quality_score": _unified("session_quality_score"),
        "c5_date_parts": _unified("created_at_ts", '"year"', '"month"', '"day"'),
        "c6_run_stamp": _unified("pipeline_run_at"),
        "c7_topic_quality_label": f"""{_with(META)}SELECT topic_name, resolution_quality
            FROM (SELECT {SESSION_QUALITY} FROM {META} WHERE {BY_TOPIC})""",
        "c8_turn_resolution_score": _from(
            CHAT,
            """contact_id, session_id, CASE WHEN confidence_score IS NOT NULL THEN
               display(greatest(0.0, least(1.0, confidence_score * CAST(0.5 AS DOUBLE)
                 + thumbs_up * CAST(0.3 AS DOUBLE) - thumbs_down * CAST(0.2 AS DOUBLE)
                 - escalated_to_agent * CAST(0.15 AS DOUBLE))), 4) END AS resolution_score""",
        ),
        "c9_session_resolution_score": _from(
            META,
            """contact_id, session_id, display(confidence_score * CAST(0.4 AS DOUBLE)
               + contained * CAST(0.3 AS DOUBLE)
               + coalesce(csat_score / 5, confidence_score) * CAST(0.3 AS DOUBLE), 4)
               AS resolution_score""",
        ),
        "c10_bounce_flag": _from(
            CLICKS,
            """contact_id, session_id, event_timestamp,
               CASE WHEN time_on_page_seconds < 5 AND event_type = 'page_view' THEN 1 ELSE 0 END
               AS bounce""",
        ),
        # filters
        "d1_dimension_filter": _from(
            CHAT, "*",
            "WHERE business_unit ILIKE 'financial services' AND application_channel ILIKE 'mobile app'",
        ),
        "d2_midnight_range": _from(
            CHAT, "*",
            f"WHERE {TURN_TS} BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12'",
        ),
        "d3_whole_day_range": _from(CHAT, "*", "WHERE " + DASHBOARD_WHERE.format(ts=TURN_TS)),
        "d3_whole_day_range_on_unified": f"""{_with(CHAT, clean_chat=CLEAN_CHAT)}
            SELECT application_channel, {TURN_KPIS} FROM clean_chat
            WHERE {DASHBOARD_WHERE.format(ts=TURN_TS)} GROUP BY application_channel""",
        "d3_unpadded_range_on_unified": f"""{WITH_UNIFIED}SELECT * FROM unified
            WHERE created_at_ts >= TIMESTAMP '2024-01-05' AND created_at_ts < TIMESTAMP '2024-01-10'""",
        "d4_filter_options": f"""{_with(CHAT)}
            SELECT DISTINCT 'business_unit' AS option, business_unit AS value FROM {CHAT}
            UNION ALL SELECT DISTINCT 'application_channel', application_channel FROM {CHAT}
            UNION ALL SELECT 'min_date', CAST(min(CAST({TURN_TS} AS DATE)) AS VARCHAR) FROM {CHAT}
            UNION ALL SELECT 'max_date', CAST(max(CAST({TURN_TS} AS DATE)) AS VARCHAR) FROM {CHAT}""",
        # joins
        "e1_latest_metadata": f"{_with('repeated_metadata', latest=LATEST_META)}SELECT * FROM latest",
        "e1_join_metadata": _joined_metadata("latest"),
        "e1_join_metadata_all_copies": _joined_metadata("repeated_metadata"),
        "e2_join_clicks": _unified(
            "click_event_count", "bounce_events", "avg_scroll_depth_pct",
            "total_time_on_page_seconds", "unique_pages_visited", "unique_event_types",
        ),
        "e3_unified_interactions": f"{WITH_UNIFIED}SELECT * FROM unified",
        "e3_unified_by_increments": f"{WITH_UNIFIED}SELECT * FROM unified",
        "e4_shared_contacts": f"""{_with(CHAT, CLICKS)}
            SELECT contact_id FROM {CHAT} WHERE contact_id IS NOT NULL
            INTERSECT SELECT contact_id FROM {CLICKS}""",
        "e5_metadata_coverage": f"""{_with(CHAT, META)}
            SELECT count(*) AS chatbot_sessions, count(known) AS with_metadata,
              count(*) - count(known) AS without_metadata,
              display(count(known) / count(*), 4) AS coverage
            FROM (SELECT DISTINCT contact_id, session_id FROM {CHAT} WHERE {HAS_KEYS})
            LEFT JOIN (SELECT DISTINCT contact_id, session_id, 1 AS known FROM {META})
              USING (contact_id, session_id)""",
        # aggregates
        "f1_click_sessions": f"{_with(CLICKS)}{CLICK_SESSIONS}",
        "f2_turn_kpis": _from(CHAT, f"business_unit, {TURN_KPIS}", "GROUP BY business_unit"),
        "f3_feedback": _from(
            CHAT, f"application_channel, {FEEDBACK_KPIS}", "GROUP BY application_channel"
        ),
        "f4_session_kpis": _from(META, f"business_unit, {SESSION_KPIS}", "GROUP BY business_unit"),
        "f5_csat": _from(META, f"application_channel, {CSAT_KPIS}", "GROUP BY application_channel"),
        "f6_kpi_report": _kpi_report(RETAIL_WEB_WHERE, RETAIL_WEB_ECHO),
        "f6_kpi_report_no_data": _kpi_report(
            "business_unit = 'mining'", {**_ALL, "business_unit": "Mining"}
        ),
        "f7_kpi_cube": _cube(),
        "f7_report_from_daily_cells": _kpi_report(
            DASHBOARD_WHERE,
            {
                "business_unit": "Healthcare",
                "application_channel": "ALL",
                "start_date": "2024-01-03",
                "end_date": "2024-01-17",
            },
        ),
        "f8_topic_measures": _from(CHAT, TOPIC_MEASURES, f"WHERE {BY_TOPIC}"),
        "f8_topic_measures_by_unit_and_channel": _from(
            CHAT,
            f"business_unit, application_channel, {TOPIC_MEASURES}",
            f"WHERE {BY_TOPIC}, business_unit, application_channel",
        ),
        "f9_topic_session_quality": _from(META, SESSION_QUALITY, f"WHERE {BY_TOPIC}"),
        "f10_topic_table": _from(
            CHAT,
            """topic_name, count(*) AS volume,
               display(sum(escalated_to_agent) / count(*) * 100, 1) AS escalation_rate_pct,
               display(sum(thumbs_up) / count(*) * 100, 1) AS thumbs_up_rate_pct,
               display(avg(confidence_score), 3) AS avg_confidence,
               display(avg(derived_resolution_score), 3) AS avg_resolution,
               CAST(display(avg(handle_seconds_dur), 0) AS INTEGER) AS avg_handle_secs""",
            f"WHERE {BY_TOPIC}",
        ),
        "f11_escalation_by_topic": _from(
            CHAT,
            """topic_name, count(*) AS volume,
               CAST(sum(escalated_to_agent) AS BIGINT) AS escalations,
               display(sum(escalated_to_agent) / count(*) * 100, 4) AS escalation_rate""",
            f"WHERE {BY_TOPIC} ORDER BY sum(escalated_to_agent) / count(*) DESC, topic_name LIMIT 8",
        ),
        "f12_daily_volume": _daily("TRUE", "count(session_id)", "0", "interactions"),
        "f13_volume_by_channel": _from(
            CHAT, "application_channel, count(*) AS volume",
            "WHERE application_channel IS NOT NULL GROUP BY ALL",
        ),
        "f14_resolution_histogram": f"""{_with(CHAT)}
            SELECT CAST(bin AS INTEGER) AS bin, bin / 20 AS lower, (bin + 1) / 20 AS upper,
                   count(*) AS turns
            FROM (SELECT len(list_filter(range(1, 20), lambda i: CAST(i AS DOUBLE) / 20 <= derived_resolution_score)) AS bin
                  FROM {CHAT} WHERE derived_resolution_score IS NOT NULL) GROUP BY bin""",
        "f15_headline_kpis": f"""{_with(CHAT, META)}SELECT * FROM
            (SELECT display(avg(escalated_to_agent) * 100, 4) AS escalation_rate,
               display(avg(confidence_score), 4) AS avg_confidence,
               display(avg(derived_resolution_score), 4) AS avg_resolution FROM {CHAT}
             WHERE {DASHBOARD_WHERE.format(ts=TURN_TS)}),
            (SELECT coalesce(display(avg(contained) * 100, 4), 0) AS containment_rate,
               display(avg(csat_score), 4) AS csat_score FROM {META}
             WHERE {DASHBOARD_WHERE.format(ts=SESSION_TS)})""",
        "f16_thumbs_split": f"""{_with(CHAT)}
            SELECT 'Thumbs Up' AS feedback, display(sum(thumbs_up) / count(*) * 100, 4) AS percent
            FROM {CHAT} WHERE {RATED}
            UNION ALL SELECT 'Thumbs Down', display(sum(thumbs_down) / count(*) * 100, 4)
            FROM {CHAT} WHERE {RATED}""",
        "f17_daily_escalation": _daily(
            "TRUE", "display(avg(escalated_to_agent) * 100, 4)", "NULL", "escalation_rate"
        ),
        "f18_volume_by_unit": _from(
            CHAT, "business_unit, count(*) AS volume",
            "WHERE business_unit IS NOT NULL GROUP BY ALL",
        ),
        # rankings, trend, set operations
        "g2_trending_topics": f"""{_trending(5, 'volume')}
            SELECT lead_topics.*, resolution_quality, avg_resolution, session_count, wow_trend
            FROM lead_topics LEFT JOIN sq USING (topic_name) LEFT JOIN trend USING (topic_name)""",
        "g3_weekly_trend": f"{_with(CHAT, **_trend())}SELECT * FROM trend",
        "g3_weekly_trend_full_weeks": f"""{_with(CHAT, **_trend(FULL_WEEKS_WHERE.format(ts=TURN_TS)))}
            SELECT * FROM trend""",
        "g4_distinct_rows": _from(CHAT, "DISTINCT *"),
        # data quality
        "j1_schema_check": f"""{_with(CHAT)}
            SELECT '{CHAT}' AS source, 'schema' AS "check", CAST(NULL AS VARCHAR) AS "column",
              'FAIL' AS status, CAST(2 AS DOUBLE) AS observed,
              '{len(rules.required)} columns' AS threshold,
              'missing columns: created_at, response_type' AS message
            UNION ALL {_quality_rows(rules)[1]}""",
        "j2_null_share": _report(CHAT_REPORT, "\"check\" IN ('nulls', 'not_empty')", CHAT),
        "j3_confidence_range": _report(
            CHAT_REPORT, "\"check\" = 'range' AND \"column\" = 'confidence_score'", CHAT
        ),
        "j4_mean_confidence": _report(META_REPORT, "\"check\" = 'mean_confidence'", META),
        "j5_duplicate_rows": _report(CHAT_REPORT, "\"check\" = 'duplicate_rows'", CHAT),
        "j6_duplicate_keys": _report(
            " UNION ALL ".join(
                _duplicate_rows(quality.CLICKSTREAM_RULES, CLICKS)
                + _duplicate_rows(quality.METADATA_RULES, "repeated_metadata")
            ),
            "\"check\" = 'duplicate_keys'", CLICKS, "repeated_metadata",
        ),
        "j7_unexpected_categories": _report(CHAT_REPORT, "\"check\" = 'category'", CHAT),
        "j8_numeric_ranges": _report(
            f"{CHAT_REPORT} UNION ALL {CLICK_REPORT}", "\"check\" = 'range'", CHAT, CLICKS
        ),
        "j9_quality_report": _report(ALL_REPORT, "TRUE", CHAT, CLICKS, META),
        "j9_quality_report_from_days": _report(ALL_REPORT, "TRUE", CHAT, CLICKS, META),
        "j10_quality_gate": f"""{_with(CHAT, CLICKS, META, report=ALL_REPORT)}
            SELECT source, count(*) FILTER (status = 'FAIL') = 0 AS passed,
              count(*) FILTER (status = 'FAIL') AS errors,
              count(*) FILTER (status = 'WARN') AS warnings FROM report GROUP BY source""",
        "j11_recency": f"""{_with(CHAT, CLICKS, META)}{_recency(CHAT, 'created_at', 24)}
            UNION ALL {_recency(CLICKS, 'event_timestamp', 24)}
            UNION ALL {_recency(META, 'session_start', 48)}""",
        # text guard and masking
        "k1_strip_control": f"SELECT doc_id, {_control('text')} AS clean FROM documents",
        "k2_normalize": f"SELECT doc_id, {_normalize('text')} AS clean FROM documents",
        "k3_injection_documents": _flags("documents", "doc_id"),
        "k3_injection_conversations": _flags("conversations", "conv_id, turn"),
        "k4_question_length": f"SELECT conv_id, turn, {LENGTH_VERDICT} AS verdict FROM conversations",
        "k5_collapse_whitespace": f"SELECT doc_id, {_collapse('text')} AS clean FROM documents",
        "k6_sanitize_documents": _sanitized("documents", "doc_id"),
        "k6_sanitize_conversations": _sanitized("conversations", "conv_id, turn"),
        "k7_filter_values": f"""{_with(CHAT)}, v AS (
              SELECT topic_name FROM {CHAT} UNION ALL SELECT url FROM pages),
            judged AS (SELECT topic_name, {_filter_verdict('topic_name')} AS verdict FROM v)
            SELECT topic_name, verdict,
              CASE WHEN verdict = 'OK' THEN {_strip('topic_name')} END AS clean, count(*) AS "rows"
            FROM judged GROUP BY ALL""",
        "k8_allowed_values": f"""{_with(CHAT)}SELECT business_unit, application_channel,
            {_allowed_verdict('business_unit', BUSINESS_UNITS)} AS unit_verdict,
            {_allowed_verdict('application_channel', CHANNELS)} AS channel_verdict,
            count(*) AS "rows" FROM {CHAT} GROUP BY business_unit, application_channel""",
        "k9_date_text": f"""{_with(CHAT)}SELECT value,
            CASE WHEN {_filter_verdict('value')} <> 'OK' THEN {_filter_verdict('value')}
                 WHEN NOT regexp_full_match(value, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 'BAD_FORMAT'
                 WHEN CAST(substr(value, 1, 4) AS INTEGER) NOT BETWEEN 2000 AND 2100
                   THEN 'YEAR_OUT_OF_RANGE' ELSE 'OK' END AS verdict,
            regexp_full_match(value, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
              AND TRY_CAST(value AS DATE) IS NOT NULL AS is_date,
            count(*) AS "rows"
            FROM (SELECT regexp_replace(substr(created_at, 1, 10), '-31$', '-99') AS value FROM {CHAT})
            GROUP BY value""",
        "k10_escape_html": """SELECT page_id, replace(replace(replace(replace(replace(html,
            '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS escaped
            FROM pages""",
        "k11_mask_sensitive": f"SELECT doc_id, {_mask('text')} AS text FROM documents",
        "k12_guard_summary": f"""{_prepared('documents', 'doc_id, source')}, judged AS (
              SELECT source, CASE WHEN {LENGTH_VERDICT} <> 'OK' THEN {LENGTH_VERDICT}
                WHEN {_injection('p')} THEN 'INJECTION' ELSE 'NONE' END AS reason FROM prepared)
            SELECT source, CASE WHEN reason = 'NONE' THEN 'OK' ELSE 'REJECTED' END AS verdict, reason,
              count(*) AS "rows" FROM judged GROUP BY ALL""",
        # text-model enrichment and cost
        "l1_transcripts": _unified(TRANSCRIPT.replace("{turns}", "num_turns") + " AS transcript"),
        "l3_messages": f"""SELECT conv_id, turn, CAST(2 AS INTEGER) AS messages, 'system' AS first_role,
            {_lit(get_template('topic_classification').system)} AS first_content, 'user' AS second_role,
            {_fill(get_template('topic_classification').user, topic_list=_lit(annotate.TOPIC_LIST), conversation='text')}
              AS second_content FROM conversations""",
        "l2_agent_score_prompts": f"""{_with(CHAT, clean_chat=CLEAN_CHAT)}
            SELECT contact_id, session_id, created_at,
              {_lit(get_template('agent_scoring').system)} AS "system",
              {_fill(get_template('agent_scoring').user,
                     transcript='(' + TRANSCRIPT.replace('{turns}', '3') + ')',
                     handle_seconds='CAST(handle_seconds_dur AS VARCHAR)', business_unit='business_unit')}
              AS "user" FROM clean_chat WHERE escalated_to_agent = 1""",
        "l2_summary_prompts": f"""SELECT conv_id, turn,
            {_fill(get_template('summarization', 1).user, transcript='text', max_words="'40'")} AS user_v1,
            {_fill(get_template('summarization', 2).user, transcript='text', max_words="'60'")} AS user_v2
            FROM conversations""",
        "l2_all_templates": " UNION ALL ".join(
            f"""SELECT conv_id, turn, '{t.key}' AS task, CAST({t.version} AS INTEGER) AS version,
                {_lit(t.system)} AS "system", {_fill(t.user, **TEMPLATE_VALUES)} AS "user" FROM conversations"""
            for t in TEMPLATES
        ),
        "l4_summary_replies": f"""{_with('replies')}SELECT event_id,
            json_extract_string(o, '$.summary') AS llm_summary,
            json_extract_string(o, '$.core_issue') AS llm_core_issue,
            json_extract_string(o, '$.outcome') AS llm_outcome,
            CASE WHEN o IS NULL AND trim(summary_reply) <> '' THEN {_lit(INVALID_REPLY)} END
              AS llm_processing_error
            FROM (SELECT event_id, summary_reply, {_json_object('summary_reply')} AS o FROM replies)""",
        "l5_sentiment_replies": f"""{_with('replies')}SELECT event_id,
            json_extract_string(o, '$.overall_sentiment') AS llm_sentiment,
            TRY_CAST(json_extract_string(o, '$.sentiment_score') AS DOUBLE) AS llm_sentiment_score,
            TRY_CAST(json_extract_string(o, '$.frustration_signal') AS BOOLEAN) AS llm_frustration,
            json_extract_string(o, '$.churn_risk') AS llm_churn_risk
            FROM (SELECT event_id, {_json_object('sentiment_reply')} AS o FROM replies)""",
        "l6_topic_replies": f"""{_with('replies')}SELECT event_id,
            json_extract_string(o, '$.topic') AS llm_topic,
            TRY_CAST(json_extract_string(o, '$.confidence') AS DOUBLE) AS llm_topic_confidence,
            json_extract_string(o, '$.topic') IN ({TOPICS_SQL}) AS topic_in_list
            FROM (SELECT event_id, {_json_object('topic_reply')} AS o FROM replies)""",
        "l7_annotate": f"""{WITH_UNIFIED}SELECT contact_id, session_id, created_at,
            'Customer asked for account help.' AS llm_summary, 'account issue' AS llm_core_issue,
            CASE WHEN escalated_to_agent = 1 THEN 'ESCALATED' ELSE 'RESOLVED' END AS llm_outcome,
            CAST(NULL AS VARCHAR) AS llm_processing_error,
            CASE WHEN escalated_to_agent = 1 OR (thumbs_up = 0 AND thumbs_down = 1) THEN 'NEGATIVE'
                 ELSE 'NEUTRAL' END AS llm_sentiment,
            CASE WHEN escalated_to_agent = 1 OR (thumbs_up = 0 AND thumbs_down = 1)
                 THEN CAST(-0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS llm_sentiment_score,
            thumbs_up = 0 AND thumbs_down = 1 AS llm_frustration,
            CASE WHEN escalated_to_agent = 1 AND thumbs_up = 0 AND thumbs_down = 1 THEN 'HIGH'
                 ELSE 'LOW' END AS llm_churn_risk,
            'Account Management' AS llm_topic, CAST(0.5 AS DOUBLE) AS llm_topic_confidence,
            TRUE AS topic_in_list, CAST(NULL AS VARCHAR) AS llm_summary_call_error,
            CAST(NULL AS VARCHAR) AS llm_sentiment_call_error,
            CAST(NULL AS VARCHAR) AS llm_topic_call_error FROM unified""",
        "l7_resume_retries_failures": f"""{WITH_UNIFIED}SELECT contact_id, session_id, created_at,
              resolution_tier, thumbs_up
            FROM unified u WHERE NOT EXISTS (SELECT 1 FROM unified d WHERE d.resolution_tier = 'HIGH'
              AND d.thumbs_up <> 1 AND d.contact_id = u.contact_id AND d.session_id = u.session_id
              AND d.created_at = u.created_at)""",
        "l7_resume": f"""{WITH_UNIFIED}SELECT contact_id, session_id, created_at, resolution_tier
            FROM unified u WHERE NOT EXISTS (SELECT 1 FROM unified d WHERE d.resolution_tier = 'HIGH'
              AND d.contact_id = u.contact_id AND d.session_id = u.session_id
              AND d.created_at = u.created_at)""",
        "l8_call_cost": _from("model_calls", f"call_id, model, display({COST}, 6) AS cost_usd"),
        "l9_usage_by_model": _usage("model"),
        "l9_usage_of_annotation": _annotation_usage(),
        "l9_usage_by_session": _usage("session_id", "model"),
        "l10_insight_prompt": f"""SELECT document, {_lit(get_template('insight').system)} AS "system",
            {_fill(get_template('insight').user, time_period="'January 2024'", metrics_json='document')}
              AS "user"
            FROM (SELECT {_metrics_json(_ALL)} AS document FROM ({_kpi_report('TRUE', _ALL)}))""",
        # logs
        "n1_masked_log_lines": f"""{_with('log_records')}SELECT event_id, {LOG_FIELDS},
            {_mask('message')} AS message FROM log_records""",
        "n1_read_log_files": f"""{_with('log_records')}SELECT {LOG_FIELDS},
            {_mask('message')} AS message FROM log_records""",
        "n2_step_run_times": _run_times("step"),
        "n3_block_run_times": _run_times("block"),
    }
    sql["l7_annotate_shared_replies"] = sql["l7_annotate"]
    sql["e4_shared_contacts_by_sketch"] = (
        f"SELECT count(*) AS shared_contacts, TRUE AS sketch_is_near FROM ({sql['e4_shared_contacts']})"
    )
    sql["e5_metadata_coverage_by_sketch"] = (
        f"SELECT with_metadata, TRUE AS sketch_is_near FROM ({sql['e5_metadata_coverage']})"
    )
    for name, rows in (
        ("f8_topic_measures", "f8_topic_measures_by_unit_and_channel"),
        ("f9_topic_session_quality", "f9_topic_session_quality"),
        ("f10_topic_table", "f10_topic_table"),
        ("f11_escalation", "f11_escalation_by_topic"),
        ("g2_trending_topics", "g2_trending_topics"),
        ("g3_weekly_trend_full_weeks", "g3_weekly_trend_full_weeks"),
    ):
        sql[f"{name}_from_cells"] = sql[rows]
    heading = ", ".join(f'{c} AS "{title}"' for c, title in TOPIC_TABLE_HEADINGS.items())
    sql["b5_topic_table_headings"] = f"SELECT {heading} FROM ({sql['f10_topic_table']})"
    for name, column in (
        ("volume", "volume"),
        ("escalation_rate", "escalation_rate_pct"),
        ("resolution_score", "avg_resolution_score"),
        ("thumbs_up_rate", "thumbs_up_rate_pct"),
    ):
        sql[f"g1_top_by_{name}"] = f"""{_with(CHAT)}SELECT * FROM
            (SELECT {TOPIC_MEASURES} FROM {CHAT} WHERE {BY_TOPIC})
            ORDER BY {column} DESC, topic_name LIMIT 4"""
    return {name: _expand_display(text) for name, text in sql.items()}
