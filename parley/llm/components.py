"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import written
from parley.operators.joins import spread_join


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) in both directions, with the least node next to u, u itself included."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
    return spread_join(both, least, ["u"], "inner")  # a hub's edges may be dealt to several tasks


def _large_star(edges: DataFrame) -> DataFrame:
    step = _with_least(edges).where(F.col("v") > F.col("u"))
    return step.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = spread_join(down, least, ["u"], "inner").where(F.col("v") != F.col("m"))
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        least.select("u", F.col("m").alias("v"))
    )


def _state(edges: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())


def components(edges: DataFrame) -> DataFrame:
    """For each node of ``edges`` (u, v; any type with an order): ``node`` and ``root``, the least
    node it is connected with, itself included. Repeated and looping edges do no harm.

    Every round is stored in the shared folder. The number of rounds grows with the logarithm of the
    longest path; the nodes of a hub are never gathered in one task.
    """
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    links = written(edges.where(F.col("u") != F.col("v")).distinct(), "links")
    before = None
    while (now := _state(links)) != before:
        before = now
        links = written(_small_star(_large_star(links).distinct()).distinct(), "links")
    return nodes.join(
        links.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left"
    ).select("node", F.coalesce("root", "node").alias("root"))
