"""Text guard and masking as column expressions.

The patterns follow Python's Unicode rules, whose classes differ from Java's: ``\\s`` also covers
the four separator controls, ``\\w`` is any letter or number or the underscore, and ``\\b`` is an
edge of that class. They are therefore spelled out before the pattern reaches Java.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache, reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.sources.schemas import BUSINESS_UNITS, CHANNELS

MIN_QUESTION_LENGTH = 2
MAX_QUESTION_LENGTH = 500
MAX_FIELD_LENGTH = 100

# The injection patterns, as case-blind regular expressions by family.
PROMPT_PATTERNS = [
    r"ignore\s+(all\s+)?previous\s+instructions",
    r"disregard\s+(all\s+)?prior\s+instructions",
    r"forget\s+(all\s+)?(previous|prior)\s+(instructions|rules|context)",
    r"new\s+(system\s+)?prompt",
    r"you\s+are\s+now\s+(?!an?\s+AEP)",
    r"\bDAN\b",
    r"jailbreak",
    r"<\s*system\s*>",
    r"\[INST\]",
    r"###\s*instruction",
]
SQL_PATTERNS = [
    r";\s*(drop|delete|truncate|alter|create|insert|update)\s+",
    r"\bunion\s+select\b",
    r"\bor\s+1\s*=\s*1\b",
    r"--\s+",
    r"/\*.*?\*/",
]
SHELL_PATTERNS = [
    r"[|;&`$]",
    r"\$\(",
    r"\.\./",
    r"(?:rm|del|format|shutdown|reboot)\s",
]
INJECTION_FAMILIES = {"prompt": PROMPT_PATTERNS, "sql": SQL_PATTERNS, "shell": SHELL_PATTERNS}

# What is masked, in order, and what replaces it.
MASKS = [
    (r"sk-[A-Za-z0-9_-]{20,}", "[OPENAI_KEY_REDACTED]"),
    (r"AKIA[A-Z0-9]{16}", "[AWS_KEY_REDACTED]"),
    (r"\b\d{3}-\d{2}-\d{4}\b", "[SSN_REDACTED]"),
    (r"\b[\w.+-]+@[\w-]+\.[a-zA-Z]{2,}\b", "[EMAIL_REDACTED]"),
]

# Control characters (tab, newline and carriage return stay) and invisible ones.
CONTROL_PATTERN = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
INVISIBLE = "\u200b\u200c\u200d\u200e\u200f\ufeff"

# Every character Python's str.strip removes.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

_WORD = r"\p{L}\p{N}_"
_EDGE = rf"(?:(?<![{_WORD}])(?=[{_WORD}])|(?<=[{_WORD}])(?![{_WORD}]))"


def java_pattern(pattern: str) -> str:
    """Spell a pattern's Unicode classes out for Java.

    An edge in front of a letter is tested after that letter has matched. The search then skips from
    letter to letter, instead of looking behind at every character of the text.
    """
    spelled = re.sub(r"^\\b([A-Za-z])", lambda m: f"{m[1]}(?<![{_WORD}].)", pattern)
    spelled = spelled.replace(r"[\w", f"[{_WORD}").replace(r"\b", _EDGE)
    return spelled.replace(r"\s", r"[\s\x1c-\x1f]").replace(r"\d", r"\p{Nd}")


# Per pattern, in the same order: texts of which one has to be present before it can match, in lower
# case and without the letter i. An empty list runs the pattern always.
_NEEDED = {
    "prompt": [
        ["nstruct"], ["nstruct"], ["forget"], ["prompt"], ["now"],
        ["dan"], ["lbreak"], ["system"], ["nst]"], ["###"],
    ],
    "sql": [[";"], ["select"], ["="], ["--"], ["/*"]],
    "shell": [[], ["$("], ["../"], ["rm", "del", "format", "shutdown", "reboot"]],
}


def _folded(c: Column) -> Column:
    """Text as the case-blind patterns see it: upper and then lower case.

    This brings the long s, the dotless i and the Kelvin sign to their ASCII letters. A capital
    dotted I becomes an i with a mark behind it, so the needed texts do without that letter.
    """
    return F.lower(F.upper(c))


_COMMENT = r"/\*.*?\*/"


def _has_comment(c: Column) -> Column:
    """Whether the comment pattern occurs.

    If nothing closes the first opening mark, nothing closes a later one, so two searches do. The
    pattern would run to the end of the text from every opening mark.
    """
    opened = F.position(F.lit("/*"), c)
    return (opened > 0) & (F.position(F.lit("*/"), c, opened + 2) > 0)


def _occurs(c: Column, pattern: str, needed: list[str]) -> Column:
    """Whether a pattern occurs, with case ignored and a dot matching newlines.

    It runs only on text that holds what it needs; looking for plain bytes is several times cheaper
    than a regular expression.
    """
    if pattern == _COMMENT:
        return _has_comment(c)
    found = c.rlike("(?isU)" + java_pattern(pattern))
    present = [_folded(c).contains(part) for part in needed]
    return reduce(lambda a, b: a | b, present) & found if present else found


def _any_of(c: Column, *families: str) -> Column:
    """Whether any pattern of the families occurs; the tests stop at the first hit."""
    tests = [
        _occurs(c, pattern, needed)
        for family in families
        for pattern, needed in zip(INJECTION_FAMILIES[family], _NEEDED[family], strict=True)
    ]
    return reduce(lambda a, b: a | b, tests)


def strip(c: Column) -> Column:
    """Remove white space of every kind from both ends, as opposed to spaces only."""
    return F.btrim(c, F.lit(WHITESPACE))


def strip_control(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL_PATTERN, "")


# Characters that composition can change, alone or next to others: marks, Hangul letters, and blocks
# with characters that have a preferred form. Characters Java does not know yet count as well.
_COMPOSABLE = (
    r"\p{M}\p{Cn}\x{340}-\x{387}\x{958}-\x{fff}\x{1100}-\x{11ff}\x{1f00}-\x{2001}"
    r"\x{2126}-\x{212b}\x{2329}\x{232a}\x{2adc}\x{f900}-\x{fb4f}\x{1d15e}-\x{1d1c0}"
    r"\x{2f800}-\x{2fa1f}"
)


@F.pandas_udf(T.StringType())
def _compose(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def normalize(c: Column) -> Column:
    """Canonical composition, then removal of invisible characters.

    Spark has no built-in for composition. Text without any character that could change is passed
    through; only other text is sent to Python, the rest travels there as null. The first test, for
    anything from U+0300 on, is the cheaper one.
    """
    may_change = c.rlike(r"[^\x{0}-\x{2ff}]") & c.rlike(f"[{_COMPOSABLE}{INVISIBLE}]")
    composed = _compose(F.when(may_change, c))
    return F.when(composed.isNull(), c).otherwise(F.translate(composed, INVISIBLE, ""))


def matches_family(c: Column, family: str) -> Column:
    return _any_of(c, family)


def contains_injection(c: Column) -> Column:
    """True when any pattern of any family occurs in the text.

    The first test reads the folded text unconditionally, which lets Spark compute that text once
    for all of them.
    """
    return _any_of(c, "sql", "shell", "prompt")


def collapse_whitespace(c: Column) -> Column:
    """Runs of spaces and tabs become one space, three or more newlines become two.

    Text without any such run is passed through uncopied.
    """
    spaced = F.when(
        c.contains("  ") | c.contains("\t"), F.regexp_replace(c, r"[ \t]{2,}|\t", " ")
    ).otherwise(c)
    joined = F.regexp_replace(spaced, r"\n{3,}", "\n\n")
    return F.when(c.contains("\n\n\n"), joined).otherwise(spaced)


def question_length_verdict(c: Column) -> Column:
    length = F.length(strip(c))
    return (
        F.when(c.isNull(), "NOT_TEXT")
        .when(length < MIN_QUESTION_LENGTH, "TOO_SHORT")
        .when(length > MAX_QUESTION_LENGTH, "TOO_LONG")
        .otherwise("OK")
    )


def filter_value_verdict(c: Column) -> Column:
    """Verdict on a value used as a filter."""
    value = strip(c)
    return (
        F.when(c.isNull(), "NOT_TEXT")
        .when(F.length(value) > MAX_FIELD_LENGTH, "TOO_LONG")
        .when(contains_injection(value), "INJECTION")
        .otherwise("OK")
    )


def _allowed_verdict(c: Column, allowed: list[str]) -> Column:
    safe = filter_value_verdict(c)
    known = F.lower(strip(c)).isin([v.lower() for v in allowed])
    return F.when(safe != "OK", safe).when(known, "OK").otherwise("UNKNOWN_VALUE")


def business_unit_verdict(c: Column) -> Column:
    return _allowed_verdict(c, BUSINESS_UNITS)


def channel_verdict(c: Column) -> Column:
    return _allowed_verdict(c, CHANNELS)


@cache
def _foreign_digits() -> tuple[str, str]:
    """All decimal digits beyond ASCII, and the ASCII digit of each."""
    digits = [d for d in map(chr, range(128, sys.maxunicode + 1)) if d.isdecimal()]
    return "".join(digits), "".join(str(unicodedata.decimal(d)) for d in digits)


def date_text_verdict(c: Column) -> Column:
    """``YYYY-MM-DD`` with a year from 2000 to 2100; month and day are not looked at.

    Decimal digits of any script count.
    """
    value = F.translate(strip(c), *_foreign_digits())
    safe = filter_value_verdict(c)
    year = F.substring(value, 1, 4).try_cast("int")
    return (
        F.when(safe != "OK", safe)
        .when(~value.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), "BAD_FORMAT")
        .when(~year.between(2000, 2100), "YEAR_OUT_OF_RANGE")
        .otherwise("OK")
    )


def is_calendar_date(c: Column) -> Column:
    """Whether the text names a day that exists, which the format verdict does not check."""
    value = strip(c)
    return F.coalesce(
        value.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z") & value.try_cast("date").isNotNull(),
        F.lit(False),
    )


def escape_html(c: Column) -> Column:
    for plain, entity in (
        ("&", "&amp;"),
        ("<", "&lt;"),
        (">", "&gt;"),
        ('"', "&quot;"),
        ("'", "&#x27;"),
    ):
        c = F.replace(c, F.lit(plain), F.lit(entity))
    return c


def mask_sensitive(c: Column) -> Column:
    """Replace keys, social security numbers and e-mail addresses, in that order.

    Every pattern needs one of a few marks in the text, which no replacement brings in, so text
    without any is passed through, and mails are looked for only where there is an ``@``.
    """
    mail = c.contains("@")
    marked = mail | c.contains("sk-") | c.contains("AKIA") | c.rlike(r"\p{Nd}-\p{Nd}{2}-")
    masked = c
    for pattern, replacement in MASKS[:-1]:
        masked = F.regexp_replace(masked, java_pattern(pattern), replacement)
    without_mails = F.regexp_replace(masked, _linear_mail_pattern(), f"$1{MASKS[-1][1]}")
    return F.when(marked, F.when(mail, without_mails).otherwise(masked)).otherwise(c)


def _linear_mail_pattern() -> str:
    """The mail pattern, begun once per run of name characters and without going back.

    As written, it would be tried from every word edge of a run that no ``@`` follows, and read to the
    end of the run each time. All tries in a run lead to the same ``@``, so the first place with a word
    edge decides: the first word character, with the dots and signs before it kept as group 1, or the
    place right behind a previous match.
    """
    name, domain = MASKS[-1][0].removeprefix(r"\b").split("@")
    run = java_pattern(name).removesuffix("+")
    signs = run.replace(_WORD, "")
    start = rf"(?:\G(?<=[{_WORD}])|(?<!{run})({signs}*+)(?=[{_WORD}]))"
    return f"{start}{run}++@{java_pattern(domain)}"
