"""Quality rules whose cutoffs are chosen under control of the risk of rejecting good documents.

Each rule is a score that junk has high. Labelled documents are the holdout: in every stratum a set of
cutoffs is certified when the exact binomial (Clopper-Pearson) upper bound on the share of good documents
that all rules together reject stays below the allowed rate. Strata share the error level evenly. The
search makes one cutoff of one rule stricter at a time: the first cutoffs of all rules, then the second,
and so on (fixed sequence). A cutoff that fails freezes its rule where it is, and the search goes on
with the others. What is tried up to the next failure depends on nothing but the cutoffs that have
failed, so each set of failed cutoffs is a fixed sequence of its own. Half of the error is for the
sequence before any failure, a quarter for all those after one, and so on. A rule without a certified
cutoff rejects nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import SPACES, without, words, written

#: Symbols and limits of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: The rules: a score from the counted columns, and cutoffs from lenient to strict. Above is rejected.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols_per_word": ("n_symbols / n_words", (0.8, 0.5, 0.3, 0.2, 0.1, 0.05)),
    "duplicate_lines": ("n_dup_lines / n_lines", (0.7, 0.5, 0.4, 0.3, 0.2, 0.1)),
    "repeated_words": ("n_repeat_words / n_words", (0.45, 0.4, 0.3, 0.2, 0.15, 0.1)),
    "long_words": ("word_chars / n_words", (30.0, 20.0, 15.0, 12.0, 10.0)),
    "short_words": ("- word_chars / n_words", (-1.5, -2.0, -2.5, -3.0, -3.5)),
}
FALSE_REJECTION, ERROR = 0.02, 0.05
#: Strata up to this number have their cutoffs broadcast; with more they are joined.
FEW_STRATA = 10_000

COUNTED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def _repeat_words(w: Column) -> Column:
    """How many words lie in a three-word window that the text holds twice or more.

    Windows are compared as 64-bit hashes within one text. Only a text with equal hashes is sorted.
    """
    places = F.sequence(F.lit(0), F.size(w) - 3)
    hashes = F.when(
        F.size(w) >= 4,
        F.transform(places, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
    )

    def count(hashed: Column) -> Column:
        def repeated(ordered: Column) -> Column:
            def same(x, k):
                return (x["h"] == F.get(ordered, k - 1)["h"]) | (x["h"] == F.get(ordered, k + 1)["h"])

            starts = F.filter(ordered, lambda x, k: F.coalesce(same(x, k), F.lit(False)))
            return F.array_sort(F.transform(starts, lambda x: x["i"]))

        pairs = F.array_sort(F.transform(hashed, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return bound(pairs, lambda ordered: bound(repeated(ordered), covered))

    def covered(starts: Column) -> Column:
        fresh = F.transform(
            starts, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - p, F.lit(3)))
        )
        return F.aggregate(fresh, F.lit(0), lambda a, x: a + x)

    return bound(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), count(h)).otherwise(F.lit(0)),
    )


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, though ``use`` names it inside of lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts the rules need, all as long; null text counts as empty.

    n_words, word_chars (characters in words), n_symbols, n_dup_lines (lines with a word that equal an
    earlier line), n_repeat_words and n_lines (lines with a word). Columns of these names are replaced.
    """
    t = F.coalesce(F.col("_text"), F.lit(""))
    w = words(t)
    lines = F.filter(F.split(t, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    counts = bound(
        w,
        lambda v: F.struct(
            F.size(v).alias("n_words"),
            F.aggregate(v, F.lit(0), lambda a, x: a + F.length(x)).alias("word_chars"),
            F.coalesce(_repeat_words(v), F.lit(0)).alias("n_repeat_words"),
        ),
    )
    line_counts = bound(
        lines,
        lambda v: F.struct(
            F.size(v).alias("n_lines"), (F.size(v) - F.size(F.array_distinct(v))).alias("n_dup_lines")
        ),
    )
    symbols = F.length(t) - F.length(F.translate(t, SYMBOLS, ""))
    kept = without(docs.withColumn("_text", F.col(f"`{text}`")), *COUNTED)
    return (
        kept.withColumn("_w", counts)
        .withColumn("_l", line_counts)
        .withColumns(
            {
                "n_words": F.col("_w.n_words").cast("long"),
                "word_chars": F.col("_w.word_chars").cast("long"),
                "n_symbols": symbols.cast("long"),
                "n_dup_lines": F.col("_l.n_dup_lines").cast("long"),
                "n_repeat_words": F.col("_w.n_repeat_words").cast("long"),
                "n_lines": F.col("_l.n_lines").cast("long"),
            }
        )
        .drop("_w", "_l", "_text")
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def scores() -> dict[str, Column]:
    return {name: F.try_divide(*_parts(rule)) for name, (rule, _) in RULES.items()}


def _parts(rule: str) -> tuple[Column, Column]:
    above, below = rule.split(" / ")
    return F.expr(above).cast("double"), F.expr(below).cast("double")


def _binomial_tail(x: Column, n: Column, rate: float) -> Column:
    """P(X <= x) for X binomial (n, rate), summed from the logarithms of its terms."""
    first = n * F.lit(math.log(1 - rate))
    odds = F.lit(math.log(rate / (1 - rate)))
    terms = F.aggregate(
        F.sequence(F.lit(0).cast("long"), x),
        F.struct(first.alias("log"), F.lit(0.0).alias("sum")),
        lambda a, i: F.struct(
            F.when(i == 0, a["log"])
            .otherwise(a["log"] + F.ln((n - i + 1) / F.greatest(i, F.lit(1))) + odds)
            .alias("log"),
            (
                a["sum"]
                + F.exp(
                    F.when(i == 0, a["log"]).otherwise(
                        a["log"] + F.ln((n - i + 1) / F.greatest(i, F.lit(1))) + odds
                    )
                )
            ).alias("sum"),
        ),
    )
    return terms["sum"]


def error_shares() -> list[float]:
    """The part of a stratum's error for one test, by how many rules are frozen.

    With m rules frozen, 1 / 2^(m + 1) is shared evenly by all sets of m failed cutoffs of different rules.
    """
    sets = [1] + [0] * len(RULES)
    for _, cuts in RULES.values():
        sets = [1] + [sets[m] + sets[m - 1] * len(cuts) for m in range(1, len(sets))]
    return [1 / (2 ** (m + 1) * n) for m, n in enumerate(sets)]


def cutoffs(
    counts: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    false_rejection: float = FALSE_REJECTION,
    error: float = ERROR,
) -> DataFrame:
    """Per stratum one column for each rule: its certified cutoff, or null where none is certified.

    ``counts`` needs doc_id, the stratum and the counted columns; ``labels`` doc_id and quality (1 is
    good). A document labelled good anywhere is good. With probability 1 - ``error`` over the choice of
    labelled documents, no stratum loses more than ``false_rejection`` of its good documents to the
    rules together. Documents that fail the base rules are no part of the holdout. A null stratum is
    one of its own. Documents are counted by how many cutoffs of each rule they pass, in one pass; the
    search sees only these counts, of which a stratum has no more than there are sets of cutoffs.
    """
    good = (
        labels.groupBy("doc_id")
        .agg(F.max("quality").alias("_quality"))
        .where("_quality = 1")
        .select("doc_id")
    )
    passed = [
        sum((F.when(score > cut, 0).otherwise(1) for cut in RULES[name][1]), F.lit(0)).alias(name)
        for name, score in scores().items()
    ]
    held = (
        counts.where(~base_failed())
        .join(good, "doc_id", "left_semi")
        .select(F.col(f"`{stratum}`").cast("string").alias("stratum"), *passed)
    )
    cells = held.groupBy("stratum", *RULES).agg(F.count("*").alias("docs"))
    cell = F.struct(F.array(*RULES).alias("passed"), F.col("docs"))
    sums = cells.groupBy("stratum").agg(F.sum("docs").alias("n"), F.collect_list(cell).alias("cells"))
    errors = F.array(
        *[F.lit(error * share) / F.count("*").over(Window.partitionBy()) for share in error_shares()]
    )
    sums = sums.withColumn("errors", errors)

    def together(levels: Column) -> Column:
        """How many good documents the rules reject, each with that number of its cutoffs in force."""

        def rejects(c: Column) -> Column:
            return F.exists(F.zip_with(c["passed"], levels, lambda p, k: p < k), lambda x: x)

        return F.aggregate(
            F.col("cells"), F.lit(0).cast("long"), lambda a, c: a + F.when(rejects(c), c["docs"]).otherwise(0)
        )

    def fits(x: Column, level: Column) -> Column:
        n = F.col("n")
        # no longer sum than can pass
        tail = _binomial_tail(F.least(x, F.ceil(n * false_rejection)), n, false_rejection)
        return (x <= n * false_rejection) & (tail <= level)

    def step(state: Column, tried: Column) -> Column:
        def with_level(levels: Column) -> Column:
            ok = bound(together(levels), lambda x: fits(x, F.get(F.col("errors"), F.size(state["frozen"]))))
            return F.when(ok, F.struct(levels.alias("levels"), state["frozen"].alias("frozen"))).otherwise(
                F.struct(
                    state["levels"].alias("levels"),
                    F.array_append(state["frozen"], tried["rule"]).alias("frozen"),
                )
            )

        stricter = F.transform(
            state["levels"], lambda k, i: F.when(i == tried["rule"], tried["level"]).otherwise(k)
        )
        return F.when(F.array_contains(state["frozen"], tried["rule"]), state).otherwise(
            bound(stricter, with_level)
        )

    lengths = [len(cuts) for _, cuts in RULES.values()]
    steps = [
        F.struct(F.lit(rule).alias("rule"), F.lit(level).alias("level"))
        for level in range(1, max(lengths) + 1)
        for rule, length in enumerate(lengths)
        if level <= length
    ]
    start = F.struct(
        F.array(*[F.lit(0) for _ in RULES]).alias("levels"), F.array().cast("array<int>").alias("frozen")
    )
    found = sums.select("stratum", "n", F.aggregate(F.array(*steps), start, step)["levels"].alias("levels"))
    return found.select(
        "stratum",
        "n",
        *[
            F.get(F.array(*map(F.lit, cuts)), F.col("levels")[rule] - 1).alias(name)
            for rule, (name, (_, cuts)) in enumerate(RULES.items())
        ],
    )


def judged(counts: DataFrame, limits: DataFrame, stratum: str = "lang") -> DataFrame:
    """``counts`` with ``base_failed`` and ``kept``; every row stays.

    A row is not kept if it fails the base rules or a score lies above the cutoff of its stratum.
    Strata without labelled documents have no cutoffs. Columns of these two names are replaced.
    """
    named = limits.select(
        F.col("stratum").alias("_stratum"), *[F.col(n).alias(f"_cut_{n}") for n in RULES]
    )
    if limits.count() <= FEW_STRATA:
        named = F.broadcast(named)
    rows = without(counts, "base_failed", "kept")
    fits = F.lit(True)
    for name, score in scores().items():
        fits = fits & ~F.coalesce(score > F.col(f"_cut_{name}"), F.lit(False))
    return (
        rows.join(named, F.col(f"`{stratum}`").cast("string").eqNullSafe(F.col("_stratum")), "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & fits)
        .drop("_stratum", *[f"_cut_{n}" for n in RULES])
    )


def quality_report(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """Counts and verdict of every document, as narrow rows (doc_id, stratum, counts, verdict).

    Counts are stored once, then used to choose the cutoffs and to judge.
    """
    narrow = counted(docs).select("doc_id", F.col(f"`{stratum}`"), *COUNTED)
    stored = written(narrow, "quality-counts")
    limits = written(cutoffs(stored, labels, stratum), "quality-cutoffs")
    return judged(stored, limits, stratum)


def accepted(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The documents that are kept, with all columns of ``docs``; null texts fail the base rules.

    Documents are stored once with their counts, so that texts are neither read twice nor shuffled.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    counts = counted(docs.withColumn("_row", row))
    names = ["doc_id", stratum, *COUNTED]
    stored = written(counts.select("_row", *[F.col(f"`{c}`") for c in names]), "quality-documents")
    limits = written(cutoffs(stored, labels, stratum), "quality-cutoffs")
    return judged(stored, limits, stratum).where("kept").select("_row.*")
