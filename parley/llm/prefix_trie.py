"""The prefix trie of conversations, as burst tries.

Conversations are sequences of turn ids (128 bits of SHA-256 over role and text). Equal ones are one row with a
count. A *container* holds the suffixes of all conversations under one trie head. One with more than
``LIMIT`` suffixes is burst: the turns they all begin with become nodes, and the next turn id tells to which
smaller container a suffix, cut short, goes. Containers that are small enough are sorted and swept, in one task each: the sweep
compares neighbours, keeps the open path on a stack and gives a node its sums when it closes. What burst containers need of those
below them goes up level by level, summed before it is shuffled.

Long conversations are cut into segments of ``SEGMENT`` turns. Segments after the first hang under heads of their own,
told apart by a hash over the segments before; the lowest are done first, and the node at which a segment ends takes its
sums from the head below. So no conversation, turn, prefix or group of copies has to fit in one row or task, apart from the ids that
end at one node: their digest is one running hash, fed with texts of ``BLOCK`` ids joined beforehand.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import settled, to_batch, written
from parley.operators.joins import spread_join

#: Suffixes a container may hold, turns of a segment, turns looked ahead when a container bursts, ids joined.
LIMIT, SEGMENT, AHEAD, BLOCK = 8192, 1024, 64, 4096
#: Turn numbers are counted through in ranges of this many, each a group of its own.
RANGE = 4096
FLUSH = 8192

NODE = {
    "conv_id": pa.int64(), "depth": pa.int64(), "parent_conv_id": pa.int64(), "n_convs": pa.int64(),
    "n_children": pa.int64(), "n_leaves": pa.int64(), "saved_tokens": pa.int64(),
    "ends_id": pa.int64(), "n_ends": pa.int64(),
}
#: A swept node; ``up`` and ``head`` are set for the top of a container.
SWEPT = {**NODE, "head": pa.string(), "up": pa.string(), "top": pa.bool_()}
SWEPT_DDL = (
    ", ".join(f"{name} long" for name in NODE) + ", head string, up string, top boolean"
)


def _digest(value: Column) -> Column:
    return F.substring(F.sha2(value, 256), 1, 32)


def number_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_id, n_bytes): the turns of each conversation counted from 1, with their ids.

    Turns stand by ``turn``, null first, equal ones by role, then text. Null role and text are empty.
    Turns without conv_id belong to no conversation and are left out. ``n_bytes`` is the text's UTF-8 length.
    A conversation is counted in ranges of turn numbers, so a hot one is many groups.
    """
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in ("role", "text"))
    step = F.coalesce(F.floor(F.col("turn") / RANGE), F.lit(-(1 << 60)))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"), text.alias("text"), step.alias("step")
    )
    inner = Window.partitionBy("conv_id", "step").orderBy(F.asc_nulls_first("turn"), "role", "text")
    before = Window.partitionBy("conv_id").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = rows.groupBy("conv_id", "step").agg(F.count("*").alias("n"))
    steps = steps.select("conv_id", "step", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = rows.withColumn("pos", F.row_number().over(inner)).select(
        "conv_id",
        "step",
        "pos",
        _digest(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("turn_id"),
        F.octet_length("text").cast("long").alias("n_bytes"),
    )
    return placed.join(steps, ["conv_id", "step"]).select(
        "conv_id", (F.col("pos") + F.col("before")).alias("pos"), "turn_id", "n_bytes"
    )


def _segments(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, int]:
    """A row for each conversation and segment, the last one shorter than ``SEGMENT``, and the number of levels.

    Columns: conv_id, level, ids, sizes, head (of the segment), below (the head under its end, if it goes on).
    """
    longest = turns.agg(F.max("pos")).first()[0] or 0
    nothing = [F.lit(None).cast(kind) for kind in ("string", "long")]
    if longest < SEGMENT:
        levels, ends = 1, convs.select("conv_id", F.lit(0).cast("long").alias("pos"))
    else:  # one place past its last turn, every conversation has a row
        levels = longest // SEGMENT + 1
        last = turns.select("conv_id", "pos").union(convs.select("conv_id", F.lit(0).cast("long")))
        ends = last.groupBy("conv_id").agg((F.max("pos") + 1).alias("pos"))
    rows = turns.select("conv_id", "pos", "turn_id", "n_bytes").union(
        ends.select("conv_id", "pos", *nothing)
    )
    turn = F.when(F.col("turn_id").isNotNull(), F.struct("pos", "turn_id", "n_bytes"))
    level = F.greatest(F.floor((F.col("pos") - 1) / SEGMENT), F.lit(0))
    found = (
        rows.groupBy("conv_id", level.alias("level"))
        .agg(F.sort_array(F.collect_list(turn)).alias("t"))
        .select("conv_id", "level", F.col("t.turn_id").alias("ids"), F.col("t.n_bytes").alias("sizes"))
    )
    empty = F.lit("")
    if levels == 1:
        return found.withColumns({"head": empty, "below": F.lit(None).cast("string")}), 1
    so_far = Window.partitionBy("conv_id").orderBy("level").rowsBetween(Window.unboundedPreceding, 0)
    a, b = (F.bit_xor(F.xxhash64(F.lit(k), "level", "ids")).over(so_far) for k in (1, 2))
    path = F.format_string("%016x%016x", a, b)
    chained = found.withColumn("path", path)
    earlier = F.lag("path").over(Window.partitionBy("conv_id").orderBy("level"))
    return chained.select(
        "conv_id", "level", "ids", "sizes", F.coalesce(earlier, empty).alias("head"),
        F.when(F.size("ids") == SEGMENT, F.col("path")).alias("below"),
    ), levels


class Sweep:
    """Turns sorted suffixes into nodes, container by container."""

    def __init__(self):
        self.out: list[tuple] = []
        self.head = None

    def container(self, row: dict) -> None:
        if row["head"] != self.head:
            self.finish()
            self.head, self.first, self.path, self.open = row["head"], row, [], []
            self._push(row["own"])

    def _push(self, size: int) -> None:
        # size of its last turn, smallest member, members, children, leaves, saved, ends, their number, children's rows
        self.open.append([size, None, 0, 0, 0, 0, None, 0, []])

    def add(self, row: dict) -> None:
        self.container(row)
        ids, shared = row["ids"], 0
        for mine, last in zip(ids, self.path):
            if mine != last:
                break
            shared += 1
        while len(self.open) > shared + 1:
            self._close()
        for size in row["sizes"][shared:]:
            self._push(size)
        self.path = ids
        node = self.open[-1]
        node[1] = row["rep"] if node[1] is None else min(node[1], row["rep"])
        node[2] += row["n"]
        if row["below"] is None:
            node[6:8] = row["rep"], row["n"]
        else:
            node[3:8] = (row[f"below_{x}"] for x in ("children", "leaves", "saved", "ends_id", "n_ends"))

    def _close(self) -> tuple:
        size, least, n, children, leaves, saved, ends, n_ends, rows = self.open.pop()
        leaves = leaves if children else 1
        saved += (n - 1) * size
        self.out += [(r[0], r[1], least, *r[3:]) for r in rows]
        depth = self.first["depth"] + len(self.open)
        done = (least, depth, None, n, children, leaves, saved, ends, n_ends, None, None, False)
        if self.open:
            up = self.open[-1]
            up[1] = least if up[1] is None else min(up[1], least)
            up[2] += n
            up[3] += 1
            up[4] += leaves
            up[5] += saved
            up[8].append(done)
        return done

    def finish(self) -> None:
        if self.head is not None:
            while len(self.open) > 1:
                self._close()
            top = self._close()
            self.out.append((*top[:2], self.first["parent"], *top[3:9], self.head, self.first["up"], True))
        self.head = None


def _swept(suffixes: DataFrame) -> DataFrame:
    """Nodes of all containers of (head, up, depth, parent, own, rep, n, ids, sizes, below, below_*)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep = Sweep()
        for batch in batches:
            for row in batch.to_pylist():
                sweep.add(row)
                if len(sweep.out) >= FLUSH:
                    yield to_batch(SWEPT, zip(*sweep.out))
                    sweep.out = []
        sweep.finish()
        yield to_batch(SWEPT, zip(*sweep.out))

    placed = suffixes.repartition("head").sortWithinPartitions("head", "ids")
    return placed.mapInArrow(run, SWEPT_DDL)


def _paths(large: DataFrame) -> DataFrame:
    """One row per container to burst, with the turns that all its suffixes begin with."""
    ids, sizes = (F.slice(c, 1, AHEAD) for c in ("ids", "sizes"))
    found = large.groupBy("head", "up", "depth", "parent", "own").agg(
        F.min("rep").alias("least"),
        F.sum("n").alias("n_convs"),
        F.min(F.struct(ids.alias("ids"), sizes.alias("sizes"))).alias("low"),
        F.max(ids).alias("high"),
    )
    same = F.zip_with("low.ids", "high", lambda a, b: a.eqNullSafe(b))
    first = F.array_position(same, False)
    shared = F.when(first > 0, first - 1).otherwise(F.size(same))
    chain = F.concat(F.array("own"), F.slice("low.sizes", F.lit(1), F.col("shared")))
    return found.withColumn("shared", shared.cast("int")).select(
        "head", "up", "depth", "parent", "least", "n_convs", "shared", chain.alias("chain")
    )


def _burst(large: DataFrame, paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The smaller containers' suffixes, and what ends at the node where a burst container parts."""
    keys = paths.select("head", "shared", "least")
    rows = spread_join(large.drop("up", "parent", "own"), keys, ["head"], "left")
    goes_on = F.size("ids") > F.col("shared")
    next_id = F.get("ids", F.col("shared"))
    smaller = rows.where(goes_on).select(
        _digest(F.concat("head", next_id)).alias("head"),
        F.col("head").alias("up"),
        (F.col("depth") + F.col("shared") + 1).alias("depth"),
        F.col("least").alias("parent"),
        F.get("sizes", F.col("shared")).alias("own"),
        "rep",
        "n",
        *[F.slice(c, F.col("shared") + 2, F.greatest(F.size(c), F.lit(1))).alias(c) for c in ("ids", "sizes")],
        *[c for c in rows.columns if c.startswith("below")],
    )
    ended = rows.where(~goes_on).select("head", F.col("rep").alias("ends_id"), F.col("n").alias("n_ends"))
    return smaller, ended


def _chains(paths: DataFrame, ended: DataFrame, tops: DataFrame) -> DataFrame:
    """Nodes of burst containers, in the form of swept ones; ``tops`` are those of the containers below."""
    sums = tops.groupBy(F.col("up").alias("head")).agg(
        F.count("*").alias("kids"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved")
    )
    rows = paths.join(sums, "head").join(ended, "head", "left")
    at = rows.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("shared"))))
    last, rest = F.col("at") == F.col("shared"), F.slice("chain", F.col("at") + 1, F.size("chain"))
    size = F.aggregate(rest, F.lit(0).cast("long"), lambda a, b: a + b)
    top = F.col("at") == 0
    return at.select(
        F.col("least").alias("conv_id"),
        (F.col("depth") + F.col("at")).alias("depth"),
        F.when(top, F.col("parent")).otherwise(F.col("least")).alias("parent_conv_id"),
        "n_convs",
        F.when(last, F.col("kids")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("saved") + (F.col("n_convs") - 1) * size).alias("saved_tokens"),
        F.when(last, F.col("ends_id")).alias("ends_id"),
        F.when(last, F.coalesce("n_ends", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_ends"),
        F.when(top, F.col("head")).alias("head"),
        F.when(top, F.col("up")).alias("up"),
        top.alias("top"),
    )


def _level(suffixes: DataFrame, limit: int) -> DataFrame:
    """All nodes under the given heads, tops included, as swept ones."""
    parts, bursts, live = [], [], suffixes
    while True:
        sizes = live.groupBy("head").agg(F.count("*").alias("held"))
        live = written(spread_join(live, sizes, ["head"], "left"), "trie-containers")
        large = live.where(F.col("held") > limit).drop("held")
        parts.append(written(_swept(live.where(F.col("held") <= limit).drop("held")), "trie-swept"))
        if large.isEmpty():
            break
        paths = written(_paths(large), "trie-paths")
        live, ended = _burst(large, paths)
        bursts.append((paths, ended))
    nodes = parts.pop()
    tops = nodes.where("top")
    for (paths, ended), part in zip(reversed(bursts), reversed(parts)):
        chains = written(_chains(paths, ended, tops), "trie-chains")
        nodes = nodes.unionByName(chains).unionByName(part)
        tops = chains.where("top").unionByName(part.where("top"))
    return nodes


def _ends(segments: DataFrame, sequences: DataFrame) -> DataFrame:
    """(ends_id, ends_sha256) of conversations that occur more than once, ids joined by commas in order."""
    key = _digest(F.concat(F.col("level").cast("string"), F.lit("|"), "head", F.lit("|"), F.array_join("ids", "")))
    repeated = sequences.where("n > 1 AND below IS NULL").select(key.alias("key"))
    members = spread_join(
        segments.where("below IS NULL").select(key.alias("key"), "conv_id"), repeated, ["key"], "left_semi"
    )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = {"key": pa.string(), "first": pa.int64(), "ids": pa.string()}
        now, held, out = None, [], []
        for batch in batches:
            for k, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (k != now or len(held) == BLOCK):
                    out.append((now, held[0], ",".join(map(str, held))))
                    held = []
                now = k
                held.append(conv)
            yield to_batch(fields, zip(*out))
            out = []
        if held:
            yield to_batch(fields, [[now], [held[0]], [",".join(map(str, held))]])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = {"ends_id": pa.int64(), "ends_sha256": pa.string()}
        now, first, run, out = None, None, None, []
        for batch in batches:
            for k, least, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if k == now:
                    run.update(b"," + ids.encode())
                    continue
                if run:
                    out.append((first, run.hexdigest()))
                now, first, run = k, least, hashlib.sha256(ids.encode())
            yield to_batch(fields, zip(*out))
            out = []
        if run:
            yield to_batch(fields, [[first], [run.hexdigest()]])

    blocks = (
        members.repartitionByRange("key", "conv_id")
        .sortWithinPartitions("key", "conv_id")
        .mapInArrow(joined, "key string, first long, ids string")
    )
    placed = blocks.repartition("key").sortWithinPartitions("key", "first")
    return placed.mapInArrow(hashed, "ends_id long, ends_sha256 string")


def trie_nodes(convs: DataFrame, turns: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The nodes of the trie over ``convs`` (conv_id, distinct) and their numbered turns, see ``number_turns``.

    A node stands for the conversations that begin with the same ``depth`` turns, its members; those with no
    turns are members of the root only. conv_id is its smallest member, ``parent_conv_id`` its parent's (null for the root),
    ``n_leaves`` the childless nodes of its subtree, ``saved_tokens`` the sum, over its subtree, of members but one times the
    bytes of the last turn, ``ends_sha256`` the SHA-256 of the ids of members that end there, in order and joined by commas.
    Without any conversation there is no node. (conv_id, depth) tells nodes apart.
    """
    spark = convs.sparkSession

    def build() -> DataFrame:
        found, levels = _segments(convs, written(turns, "trie-turns"))
        segments = written(found, "trie-segments")
        sequences = written(
            segments.groupBy("level", "head", "ids", "sizes", "below").agg(
                F.min("conv_id").alias("rep"), F.count("*").alias("n")
            ),
            "trie-sequences",
        )
        below, nodes = None, None
        for level in reversed(range(levels)):
            rows = sequences.where(F.col("level") == level).drop("level")
            names = ("children", "leaves", "saved", "ends_id", "n_ends")
            if below is None:
                rows = rows.withColumns({f"below_{x}": F.lit(None).cast("long") for x in names})
            else:
                # most rows go no further: only those that do are joined
                on = rows.where("below IS NOT NULL").join(below, "below", "left")
                rows = rows.where("below IS NULL").unionByName(on, allowMissingColumns=True)
            suffixes = rows.select(
                "head", F.lit(None).cast("string").alias("up"), F.lit(level * SEGMENT).cast("long").alias("depth"),
                F.lit(None).cast("long").alias("parent"), F.lit(0).cast("long").alias("own"),
                "rep", "n", "ids", "sizes", "below", *[f"below_{x}" for x in names],
            )
            found = _level(suffixes, limit)
            tops = F.col("top") & F.col("up").isNull()
            if level:  # the tops stand for the ends of the segments above, which give their rows
                below = found.where(tops).select(
                    F.col("head").alias("below"), F.col("n_children").alias("below_children"),
                    F.col("n_leaves").alias("below_leaves"), F.col("saved_tokens").alias("below_saved"),
                    F.col("ends_id").alias("below_ends_id"), F.col("n_ends").alias("below_n_ends"),
                )
                found = found.where(~tops)
            nodes = found if nodes is None else nodes.unionByName(found)
        nodes = nodes.select(*NODE)
        alone = F.sha2(F.coalesce(F.col("ends_id").cast("string"), F.lit("")), 256)
        several = nodes.where("n_ends > 1").join(_ends(segments, sequences), "ends_id")
        return (
            nodes.where("n_ends <= 1").withColumn("ends_sha256", alone)
            .unionByName(several).drop("ends_id", "n_ends")
        )

    return settled(spark, build, "trie-nodes")


def prefix_trie(turns: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The trie of whole conversations from (conv_id, turn, role, text), see ``trie_nodes``."""
    numbered = written(number_turns(turns), "turns-numbered")
    return trie_nodes(numbered.select("conv_id").distinct(), numbered, limit)
