"""Chat formatting: a dialogue seen by each of its participants in turn.

For every participant the whole dialogue is rendered with that speaker as the assistant and all other
speakers as named users. The result has one row per participant and turn, with the place of the turn
in the rendering, so that no dialogue, however long, has to fit in one row or one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import running_total, written

OPEN, CLOSE, END = "<|", "|>", "<|end|>\n"
TURNS_PER_BUCKET = 1024


def escaped(text: Column) -> Column:
    """Text in which no header or end mark can be forged: ``<|`` becomes ``< |``."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit(OPEN), F.lit("< |"))


def rotate(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    system: str = "system",
) -> DataFrame:
    """One row per perspective (participant) and turn, with its place in the rendering.

    ``rendered`` holds header, text and end mark; joined in the order of ``char_start`` the rows of a
    perspective are its rendering, whose characters they cover without a gap. ``is_target`` tells whether the
    perspective's own speaker talks; then ``mask_start`` and ``mask_end`` bound the characters to learn
    (text and end mark, not the header), else both are null.

    Every distinct role but ``system`` is a participant. System turns stand in every rendering and are
    never targets. Turns without a role are those of a user without a name. A dialogue without any
    participant has no rows. A null conversation id is one dialogue, null text is empty, null turns
    come last. Equal turn numbers are ordered by role, then text; repeated rows stay. Other columns
    are not carried on.
    """
    plain = turns.select(
        F.col(f"`{conversation}`").alias("conv_id"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.col(f"`{role}`").cast("string").alias("role"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    speakers = (
        plain.where(F.col("role") != system)
        .select(F.col("conv_id").alias("_conv"), F.col("role").alias("perspective"))
        .distinct()
    )
    own = F.col("role") == F.col("perspective")
    name = F.when(F.col("role").isNotNull(), F.concat(F.lit(" name="), escaped(F.col("role"))))
    header = (
        F.when(F.col("role") == system, F.lit(f"{OPEN}system{CLOSE}"))
        .when(own, F.lit(f"{OPEN}assistant{CLOSE}"))
        .otherwise(F.concat(F.lit(f"{OPEN}user"), F.coalesce(name, F.lit("")), F.lit(CLOSE)))
    )
    seen = (
        plain.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv")))
        .withColumn("_head", header)
        .withColumn("rendered", F.concat("_head", escaped(F.col("text")), F.lit(END)))
        .select(
            "conv_id",
            "perspective",
            "turn",
            "role",
            "rendered",
            F.coalesce(own, F.lit(False)).alias("is_target"),
            F.length("_head").cast("long").alias("_head_chars"),
            F.length("rendered").cast("long").alias("_chars"),
            F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("_conv_key"),
            F.col("conv_id").isNull().alias("_no_conv"),
            F.coalesce(F.col("turn"), F.lit(2**63 - 1)).alias("_turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("_role"),
        )
        .withColumn("_bucket", F.floor(F.col("_turn") / TURNS_PER_BUCKET))
    )
    stored = written(seen, "rotated")
    group, order = ["_conv_key", "_no_conv", "perspective"], ["_turn", "_role", "rendered"]
    placed = running_total(stored, group, "_bucket", order, "_chars", "char_start")
    text_start = F.col("char_start") + F.col("_head_chars")
    return placed.withColumn("char_end", F.col("char_start") + F.col("_chars")).select(
        "conv_id",
        "perspective",
        "turn",
        "role",
        "rendered",
        "char_start",
        "char_end",
        "is_target",
        F.when(F.col("is_target"), text_start).alias("mask_start"),
        F.when(F.col("is_target"), F.col("char_end")).alias("mask_end"),
    )
