"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Golden-ratio points are mapped through the cumulative weights of the sources: each point is a slot of
the source it falls on. The slots of a source are ranked, and slot number r takes block number r of
the source, whose documents were shuffled and cut into blocks of equal token counts; past the last
block it starts over. So any stretch of the schedule is near the target weights.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import n_words, running_total, words, written

#: 2^32 over the golden ratio, rounded: i * STEP mod 2^32 is the fractional part of i / golden ratio.
STEP, CIRCLE = 2654435769, 1 << 32
SLOTS, LARGEST_BLOCK = 1 << 14, 1 << 20
LEAST_BLOCKS = 64
REPEATS = 3
FEW_SOURCES = 10_000


def sized(docs: DataFrame, doc_id: str, source: str, text: str, seed: int) -> DataFrame:
    """The narrow rows that the schedule needs, in an order shuffled by a seeded hash."""
    name = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")))
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").cast("string").alias("source"),
        n_words(F.col(f"`{text}`")).alias("size"),
        F.md5(name).alias("_key"),
        F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256).alias("_tie"),
    ).withColumn("_bucket", F.substring("_key", 1, 3))


def source_table(slim: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """Weight and target of each source; one row per source.

    Sources in code-point order, null last, weigh 1, 2, 3, 1, ...; targets are shares of all sizes,
    but ``repeats`` times the source's size at most, the excess going to the others by weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = (
        slim.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("source_no", F.row_number().over(by_name))
        .withColumn("weight", ((F.col("source_no") - 1) % 3 + 1).cast("long"))
        .withColumn("_cap", F.col("source_size") * repeats)
    )
    # The level: all sources above their cap stay there, the rest share what is left by weight.
    room = (F.col("_cap") / F.col("weight")).alias("_room")
    full_first = Window.orderBy(room, "source_no")
    earlier = full_first.rowsBetween(Window.unboundedPreceding, -1)
    rest = full_first.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(earlier), F.lit(0))
    return (
        ranked.withColumn("_level", left / F.sum("weight").over(rest))
        .withColumn("_open", F.col("_level") * F.col("weight") <= F.col("_cap"))
        .withColumn(
            "_level",
            F.min(F.when(F.col("_open"), F.struct(room, "source_no", "_level"))).over(every)["_level"],
        )
        .withColumn(
            "target",
            F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("weight").cast("double")),
        )
        .select("source", "source_no", "source_size", "weight", "target")
    )


def with_blocks(sources: DataFrame, block_words: int) -> DataFrame:
    """Adds the cut into blocks (``blocks``, of ``_q`` or ``_q`` + 1 words), the number of slots due
    (``quota``) and the stretch of the circle, in units of 2^-30 (``_lo`` to ``_hi``)."""
    size, zero = F.col("source_size"), F.lit(0).cast("long")
    by_no = Window.orderBy("source_no")
    due = F.col("target") * F.col("blocks") / F.col("source_size")
    cut = (
        sources.withColumn(
            "blocks",
            F.greatest(
                F.expr(f"(source_size + {block_words - 1}) div {block_words}"),
                F.least(size, F.lit(LEAST_BLOCKS)),
            ),
        )
        .withColumn("_due", F.when(size > 0, due).otherwise(F.lit(0.0)))
        .withColumn("quota", F.least(F.floor(F.col("_due") + 0.5), F.col("blocks") * REPEATS))
        .withColumn("_slots", F.sum(F.col("quota") + 1).over(Window.partitionBy()))
        .withColumn("_unit", F.lit(float(1 << 30)) / F.col("_slots"))
        .withColumn("_length", F.greatest(F.lit(1), F.floor(F.col("_due") * F.col("_unit"))))
        .withColumn("_length", F.when(F.col("quota") > 0, F.col("_length")).otherwise(zero))
    )
    return (
        cut.withColumn("_hi", F.sum("_length").over(by_no))
        .withColumn("_lo", F.col("_hi") - F.col("_length"))
        .withColumn("_circle", F.sum("_length").over(Window.partitionBy()))
        .withColumn("_q", F.when(size > 0, F.expr("source_size div blocks")).otherwise(zero))
        .withColumn("_r", F.when(size > 0, F.expr("source_size % blocks")).otherwise(zero))
        .drop("_due", "_unit", "_length")
    )


def schedule(sources: DataFrame) -> DataFrame:
    """The slots in order: ``slot``, ``source_no``, ``rank`` in its source, ``block`` and ``pass``.

    Points are drawn until every source has had its quota (four times as many slots are enough, as a
    stretch is met again after 2.7 times its mean return time at most); those beyond are passed over.
    """
    spark = sources.sparkSession
    found = sources.agg(F.sum("quota"), F.max("_circle"), F.count("*")).first()
    points, circle, count = 4 * (found[0] or 0) + 64, found[1] or 0, found[2]
    cells = max(1024, 2 * count)
    width = max(1, -(-circle // cells))
    ends = sources.where("quota > 0").select("source_no", "blocks", "quota", "_lo", "_hi")
    strips = ends.withColumn(
        "_cell", F.explode(F.sequence(F.expr(f"_lo div {width}"), F.expr(f"(_hi - 1) div {width}")))
    )
    place = F.expr(f"((id * {STEP}L) % {CIRCLE}L) * {circle}L div {CIRCLE}L")
    drawn = (
        spark.range(points)
        .withColumn("_at", place)
        .withColumn("_cell", F.expr(f"_at div {width}"))
        .join(strips, "_cell")
        .where("_at >= _lo AND _at < _hi")
        .select("id", "source_no", "blocks", "quota", F.lit(1).cast("long").alias("_one"))
        .withColumn("_chunk", F.expr("id div 4096"))
    )
    ranked = running_total(written(drawn, "slots"), ["source_no"], "_chunk", ["id"], "_one", "rank")
    return ranked.where("rank < quota").select(
        F.col("id").alias("slot"),
        "source_no",
        "rank",
        F.expr("rank % blocks").alias("block"),
        F.expr("rank div blocks").alias("pass"),
    )


def pieces(placed: DataFrame) -> DataFrame:
    """Cuts documents (with ``start`` in their source's stream) at the block bounds."""

    def block_of(at: str) -> Column:
        return F.expr(
            f"CASE WHEN {at} < _r * (_q + 1) THEN ({at}) div (_q + 1) "
            f"ELSE _r + ({at} - _r * (_q + 1)) div greatest(_q, 1) END"
        )

    begin = F.expr("block * _q + least(block, _r)")
    end = F.expr("(block + 1) * _q + least(block + 1, _r)")
    return (
        placed.where("size > 0")
        .withColumn("block", F.explode(F.sequence(block_of("start"), block_of("start + size - 1"))))
        .withColumn("word_start", F.greatest(F.lit(0), begin - F.col("start")))
        .withColumn("word_end", F.least(F.col("size"), end - F.col("start")))
    )


class Mix(NamedTuple):
    """The mix of one table: its documents as narrow rows, and the pieces taken of them."""

    documents: DataFrame
    parts: DataFrame


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: int = 7,
    block_words: int | None = None,
) -> Mix:
    """Plans the mix of all ``docs``.

    ``documents`` has one narrow row for each row of ``docs`` (doc_id, source, size in words, source
    size, target, place in its source); ``parts`` has a row for each piece of a document in a slot:
    slot, pass, source, doc_id, the place ``start``, ``word_start`` and ``word_end``. A source's words
    come within half a block of its target. Null text has no words and is never taken; a null source
    is one of its own, a null id an id like any other; repeated rows are documents of their own.
    Equal ids are ordered by text. Blocks hold at most 2^20 words, and are small enough for some 2^14
    slots in all and 64 in each source. An empty table gives empty results.
    """
    slim = written(sized(docs, doc_id, source, text, seed), "mix-documents")
    sources = source_table(slim)
    total = slim.agg(F.sum("size")).first()[0] or 0
    block = block_words or max(1, min(LARGEST_BLOCK, total // SLOTS))
    sources = written(with_blocks(sources, block), "mix-sources")
    named = slim.withColumnRenamed("source", "_name")
    match = F.col("_name").eqNullSafe(F.col("source"))
    facts = sources.select("source", "source_no", "source_size", "target", "_q", "_r")
    if sources.count() <= FEW_SOURCES:
        known = named.join(F.broadcast(facts), match)
    else:
        known = named.join(facts, match)
    stored = written(known.drop("_name"), "mix-known")
    order = ["_key", "doc_id", "_tie"]
    placed = running_total(stored, ["source_no"], "_bucket", order, "size", "start")
    placed = written(placed, "mix-placed")
    parts = schedule(sources).join(pieces(placed), ["source_no", "block"])
    return Mix(
        placed.select(
            "doc_id", "source", "source_no", "size", "source_size", "target", "start", "_tie"
        ),
        parts.select(
            "slot", "pass", "source", "source_no", "doc_id", "start", "word_start", "word_end"
        ),
    )


def taken_words(plan: Mix) -> DataFrame:
    """Per document the words that the mix takes of it, repeats counted, as ``taken``."""
    sums = plan.parts.groupBy("source_no", F.col("start").alias("_start")).agg(
        F.sum(F.col("word_end") - F.col("word_start")).alias("taken")
    )
    here = F.when(F.col("size") > 0, F.col("start"))  # only these places belong to one document
    return (
        plan.documents.withColumn("_start", here)
        .join(sums, ["source_no", "_start"], "left")
        .withColumn("taken", F.coalesce("taken", F.lit(0)))
        .drop("_start", "start", "source_no", "_tie")
    )


def mixed_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The mix as documents: a row for each pass over a document, with all columns of ``docs``.

    A document taken whole keeps its text; of one that a source's last block cuts, the words taken are
    joined by single spaces, and ``n_chars``, if there is such a column, is the new length. Repeated rows are taken as one document of that size and kept apart by
    their place. ``docs`` needs the columns doc_id, source and text; rows come in no order.
    """
    plan = mix(docs, seed=seed)
    passes = plan.parts.groupBy("source_no", "start", "pass").agg(
        F.min("word_start").alias("_from"), F.max("word_end").alias("_to")
    )
    numbered = Window.partitionBy("doc_id", "source", "_tie").orderBy("start")
    places = (
        plan.documents.where("size > 0")
        .join(passes, ["source_no", "start"])
        .select("doc_id", "source", "_tie", "size", "start", "_from", "_to")
        .withColumn("_copy", F.dense_rank().over(numbered))
    )
    key = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    rows = Window.partitionBy("doc_id", "source", "_tie").orderBy(F.lit(1))
    keyed = docs.withColumn("_tie", key).withColumn("_copy", F.row_number().over(rows))
    left, right = keyed.alias("l"), places.alias("r")
    on = (
        F.col("l.doc_id").eqNullSafe(F.col("r.doc_id"))
        & F.col("l.source").eqNullSafe(F.col("r.source"))
        & (F.col("l._tie") == F.col("r._tie"))
        & (F.col("l._copy") == F.col("r._copy"))
    )
    taken = F.slice(words(F.col("l.text")), F.col("_from") + 1, F.col("_to") - F.col("_from"))
    cut = F.array_join(taken, " ")
    whole = (F.col("_from") == 0) & (F.col("_to") == F.col("r.size"))
    fresh = {"text": F.when(whole, F.col("l.text")).otherwise(cut)}
    if "n_chars" in docs.columns:
        size = F.length(cut).cast(docs.schema["n_chars"].dataType)
        fresh["n_chars"] = F.when(whole, F.col("l.n_chars")).otherwise(size)
    return left.join(right, on).select(
        *[(fresh[c] if c in fresh else F.col(f"l.`{c}`")).alias(c) for c in docs.columns]
    )
