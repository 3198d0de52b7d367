"""Prefix trie of conversations on minimal-perfect-hash node tables.

A node is a distinct sequence of first turns, known by a 128-bit digest of it. A shard is a run of
whole conversations (of a long one, a stretch of CHUNK turns): it lists its distinct prefix digests,
gives each a slot of a minimal perfect hash, scatters counts into flat arrays and
accumulates them through the array of parent slots, deepest nodes first. The sums of all shards
are then added up by digest, where a node that a third of all conversations share has one row
a shard, not one a conversation.

Two rounds of this suffice. The first counts members. In the second, each node's own weight
stands in one shard only, that of its smallest member, whose path holds all nodes above it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeline.llm.common import join_groups, numbered, staged, whole_groups

#: Turns of one conversation in a shard, rows of a shard (a bound on memory), ids that one row carries to the digest of the ends.
CHUNK, SHARD, IDS = 1024, 100_000, 256
#: Stands for a missing conv_id, which is larger than all others.
NO_ID = (1 << 63) - 1
#: Characters of a text by which turns with the same number and role are ordered, before its hash.
HEAD = 32


class NodeTable:
    """Minimal perfect hash of distinct 128-bit keys: level by level, keys that are alone at their place take the next slots.

    Slots are verified: each belongs to one key, and a key that is not in the table gets -1.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray) -> None:
        n = len(low)
        self.levels: list[np.ndarray] = []  # slot at each place, or -1
        slots, left, used = np.empty(n, np.int64), np.arange(n), 0
        while len(left):
            if len(self.levels) == 64:
                raise ValueError("keys are not distinct")
            size = max(16, 3 * len(left) // 2)
            at = self._place(low[left], high[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            slot_at = np.where(alone, np.cumsum(alone) - 1 + used, -1)
            self.levels.append(slot_at)
            taken = alone[at]
            slots[left[taken]] = slot_at[at[taken]]
            used += int(alone.sum())
            left = left[~taken]
        self.low, self.high = np.empty_like(low), np.empty_like(high)
        self.low[slots], self.high[slots] = low, high
        if n and (np.bincount(slots, minlength=n).max() != 1 or (self.slots(low, high) != slots).any()):
            raise ValueError("two keys share a slot")

    @staticmethod
    def _place(low: np.ndarray, high: np.ndarray, level: int, size: int) -> np.ndarray:
        plus, times = (np.uint64((2 * level + 1) * odd & (1 << 64) - 1) for odd in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
        x = (low + plus) ^ (high * times)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)

    def slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        out, left = np.full(len(low), -1, np.int64), np.arange(len(low))
        for level, slot_at in enumerate(self.levels):
            slot = slot_at[self._place(low[left], high[left], level, len(slot_at))]
            found = slot >= 0
            own, at = slot[found], left[found]
            same = (self.low[own] == low[at]) & (self.high[own] == high[at])
            out[at[same]] = own[same]
            left = left[~found]
        return out


class Shard:
    """The trie of some paths, as flat arrays by slot: depth, parent slot (-1 above the shard's top), size of the last text."""

    def __init__(self, depth: np.ndarray, low: np.ndarray, high: np.ndarray, up_low: np.ndarray, up_high: np.ndarray, chunk: int) -> None:
        order = np.lexsort((high, low))
        first = np.ones(len(order), bool)
        first[1:] = (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)
        self.node = order[first]  # a row of each distinct node
        self.table = NodeTable(low[self.node], high[self.node])
        slot = self.table.slots(low[self.node], high[self.node])
        self.node = self.node[np.argsort(slot)]
        self.depth = depth[self.node]
        self.parent = self.table.slots(up_low[self.node], up_high[self.node])
        self.parent[self.depth % chunk == 0] = -1  # of another stretch, also where that is in this shard
        self.by_depth = np.argsort(-self.depth, kind="stable")
        self.cuts = np.flatnonzero(np.diff(self.depth[self.by_depth])) + 1

    def accumulate(self, values: np.ndarray, into: Callable[[np.ndarray, np.ndarray, np.ndarray], None]) -> np.ndarray:
        """`values` of each slot taken together with those of all slots below it."""
        for level in np.split(self.by_depth, self.cuts):
            parent = self.parent[level]
            inner = parent >= 0
            into(values, parent[inner], values[level[inner]])
        return values


def _shards(batches: Iterator[pa.RecordBatch], shard: int) -> Iterator[pa.Table]:
    """Whole stretches of conversations, about `shard` rows at a time."""
    held, rows = [], 0
    for table in whole_groups(batches, "conv", "chunk"):
        held.append(table)
        rows += table.num_rows
        if rows >= shard:
            yield pa.concat_tables(held).combine_chunks()
            held, rows = [], 0
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _numbers(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy() for n in names]


def _unsigned(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy().view(np.uint64) for n in names]


def _dealt(paths: DataFrame) -> DataFrame:
    return paths.repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "depth")


_KEY = ["depth", "low", "high"]
_NODES = "depth long, low long, high long, up_low long, up_high long, size long, n_convs long, conv long"


def _count(batches: Iterator[pa.RecordBatch], stretch: int, rows: int) -> Iterator[pa.RecordBatch]:
    """The nodes of each shard: how many of its conversations go through, and the smallest."""
    names = [part.split()[0] for part in _NODES.split(", ")]
    for table in _shards(batches, rows):
        conv, chunk, depth, size = _numbers(table, "conv", "chunk", "depth", "size")
        low, high, up_low, up_high = _unsigned(table, "low", "high", "up_low", "up_high")
        shard = Shard(depth, low, high, up_low, up_high, stretch)
        ends = np.append(np.flatnonzero((np.diff(conv) != 0) | (np.diff(chunk) != 0)), len(conv) - 1)
        at = shard.table.slots(low[ends], high[ends])
        members = np.bincount(at, minlength=len(shard.node))
        least = np.full(len(shard.node), NO_ID, np.int64)
        np.minimum.at(least, at, conv[ends])
        shard.accumulate(members, np.add.at)
        shard.accumulate(least, np.minimum.at)
        own = [x[shard.node] for x in (depth, low, high, up_low, up_high, size)]
        yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (*own, members.astype(np.int64), least)], names)


def _add(batches: Iterator[pa.RecordBatch], stretch: int, rows: int) -> Iterator[pa.RecordBatch]:
    """For the nodes of each shard, the sums of the weights that stand in the shard at or below them."""
    for table in _shards(batches, rows):
        is_path = table.column("saved").is_null().to_numpy(zero_copy_only=False) if table.num_rows else np.zeros(0, bool)
        depth, *_ = _numbers(table, "depth")
        low, high, up_low, up_high = _unsigned(table, "low", "high", "up_low", "up_high")
        shard = Shard(*(x[is_path] for x in (depth, low, high, up_low, up_high)), stretch)
        weights = table.filter(pa.array(~is_path))
        at = shard.table.slots(*_unsigned(weights, "low", "high"))
        if (at < 0).any():
            raise ValueError("a weight stands at a node that its smallest member does not reach")
        sums = []
        for name in ("saved", "leaves"):
            values = np.zeros(len(shard.node), np.int64)
            np.add.at(values, at, weights.column(name).to_numpy())
            sums.append(shard.accumulate(values, np.add.at))
        some = (sums[0] != 0) | (sums[1] != 0)
        own = [x[is_path][shard.node][some].view(np.int64) for x in (depth, low, high)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*own, *(s[some] for s in sums))], [*_KEY, "saved", "leaves"])


def _join_ids(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Up to `most` consecutive ids of a node as one text."""
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("low", "high", "conv")))
        out = []
        for (low, high), own in groupby(rows, lambda r: r[:2]):
            ids = [r[2] for r in own]
            out += [(low, high, ids[i], ",".join("null" if x == NO_ID else str(x) for x in ids[i : i + most])) for i in range(0, len(ids), most)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*out)], ["low", "high", "first", "ids"])


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a node of the texts that follow each other; the text of one batch and the state of one digest are held."""
    names = ["low", "high", "ends_sha256"]
    kinds = (pa.int64(), pa.int64(), pa.string())
    node, state = None, hashlib.sha256()
    for batch in batches:
        done = []
        for low, high, ids in zip(*(batch.column(c).to_pylist() for c in ("low", "high", "ids"))):
            if (low, high) == node:
                state.update(b"," + ids.encode())
                continue
            if node is not None:
                done.append((*node, state.hexdigest()))
            node, state = (low, high), hashlib.sha256(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in zip(zip(*done), kinds)], names)
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip((*node, state.hexdigest()), kinds)], names)


def ordered_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The turns of `df` without their texts: conv, pos (from 0), n_turns, said_1 and said_2 (digests of role and text), size (code points).

    Turns ascend by number, null first; turns with the same number by role, the first characters of the text and a hash of
    it. Repeated rows are turns each. A null role or text is empty. Rows without a conv_id are one
    conversation, larger than all others. Other columns are not read. No conversation, however long, is ordered by one task.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    slim = df.select(
        F.coalesce(F.col(f"`{conv_col}`").cast("long"), F.lit(NO_ID)).alias("conv"),
        F.col(f"`{turn_col}`").alias("turn"),
        role.alias("role"),
        F.substring(text, 1, HEAD).alias("head"),
        F.xxhash64(role, text).alias("said_1"),
        F.xxhash64(F.lit(1), role, text).alias("said_2"),
        F.char_length(text).cast("long").alias("size"),
    )
    lined = staged(slim.withColumn("line", F.monotonically_increasing_id()))
    order = numbered(lined, "conv", "turn", "role", "head", "said_1", "said_2", "line")
    return order.select("conv", "pos", F.col("n").alias("n_turns"), "said_1", "said_2", "size")


def as_paths(turns: DataFrame) -> DataFrame:
    """The conversations of `ordered_turns` as they are: conv, depth (0: before the first turn), said_1, said_2, size, last."""
    inner = turns.select("conv", (F.col("pos") + 1).alias("depth"), "said_1", "said_2", "size", (F.col("pos") + 1 == F.col("n_turns")).alias("last"))
    convs = turns.groupBy("conv").agg(F.max("n_turns").alias("n_turns"))
    return inner.unionByName(_tops(convs.withColumn("length", F.col("n_turns"))))


def _tops(convs: DataFrame) -> DataFrame:
    none = F.lit(0).cast("long")
    return convs.select("conv", none.alias("depth"), none.alias("said_1"), none.alias("said_2"), none.alias("size"), (F.col("length") == 0).alias("last"))


def rebuilt(turns: DataFrame, span: int = 100, most: int = 6) -> DataFrame:
    """Paths in which each conversation c begins with the first h turns of c - c % span and goes on with its own after its first h.

    h is the unsigned CRC-32 of the decimal c, modulo `most`; of a shorter first part there is what there is, and nothing of one that is
    absent. The conversation without an id is left as it is. A base has at most span followers a side
    of zero and gives less than `most` turns to each, so no key of the joins grows.
    """
    turns = staged(turns)
    known = F.col("conv") != NO_ID
    h = F.when(known, F.crc32(F.col("conv").cast("string").cast("binary")) % most).otherwise(F.lit(0).cast("long"))
    convs = turns.groupBy("conv").agg(F.max("n_turns").alias("n_turns")).withColumn("h", h)
    convs = convs.withColumn("base", F.when(known, F.col("conv") - F.col("conv") % span))
    lengths = convs.select(F.col("conv").alias("base"), F.col("n_turns").alias("base_turns"))
    kept = F.least("h", F.coalesce("base_turns", F.lit(0)))
    convs = convs.join(lengths, "base", "left").withColumn("kept", kept)
    convs = staged(convs.withColumn("length", F.col("kept") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))))
    mark = (F.col("depth") == F.col("length")).alias("last")
    columns = ["conv", "depth", "said_1", "said_2", "size", mark]
    firsts = turns.where(F.col("pos") < most).select(F.col("conv").alias("base"), "pos", "said_1", "said_2", "size")
    borrowed = firsts.join(convs, "base").where(F.col("pos") < F.col("kept")).withColumn("depth", F.col("pos") + 1).select(*columns)
    whole = join_groups(turns, convs.select("conv", "h", "kept", "length", F.col("n_turns").alias("many")), "conv", "many", turns.count(), "pos")
    own = whole.where(F.col("pos") >= F.col("h")).withColumn("depth", F.col("pos") - F.col("h") + F.col("kept") + 1).select(*columns)
    return own.unionByName(borrowed).unionByName(_tops(convs))


def _with_digests(paths: DataFrame, stretch: int) -> DataFrame:
    """Each node's digest and its parent's. A digest is the XOR of the hashes of (depth, turn) on the path, so stretches add up."""
    at_top = F.col("depth") == 0
    turn = ["depth", "said_1", "said_2"]
    paths = paths.select(
        "*",
        F.floor(F.col("depth") / stretch).alias("chunk"),
        F.when(at_top, 0).otherwise(F.xxhash64(*turn)).alias("g_low"),
        F.when(at_top, 0).otherwise(F.xxhash64(F.lit(2), *reversed(turn))).alias("g_high"),
    )
    whole = paths.groupBy("conv", "chunk").agg(F.bit_xor("g_low").alias("w_low"), F.bit_xor("g_high").alias("w_high"))
    earlier = W.partitionBy("conv").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    before = whole.select("conv", "chunk", F.bit_xor("w_low").over(earlier).alias("b_low"), F.bit_xor("w_high").over(earlier).alias("b_high")).where("chunk > 0")
    inside = W.partitionBy("conv", "chunk").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    local = paths.withColumn("i_low", F.bit_xor("g_low").over(inside)).withColumn("i_high", F.bit_xor("g_high").over(inside))
    joined = local.join(before, ["conv", "chunk"], "left")

    def digest(which: str):
        return F.col(f"i_{which}").bitwiseXOR(F.coalesce(F.col(f"b_{which}"), F.lit(0).cast("long")))

    return joined.select(
        "conv", "chunk", "depth", "size", "last",
        digest("low").alias("low"), digest("high").alias("high"),
        digest("low").bitwiseXOR(F.col("g_low")).alias("up_low"), digest("high").bitwiseXOR(F.col("g_high")).alias("up_high"),
    )


def prefix_trie(paths: DataFrame, stretch: int = CHUNK, shard: int = SHARD, ids_a_row: int = IDS) -> DataFrame:
    """One row for each node of the trie of `paths` (from `as_paths` or `rebuilt`).

    conv_id: smallest member; depth; parent_conv_id: its parent's conv_id (root: null); n_convs: members;
    n_children; n_leaves: nodes without children at or below it; saved_tokens: over all nodes at or below it,
    (members - 1) times the code points of the node's last text; ends_sha256: of the decimal ids of the members that end here,
    ascending, comma-joined (the conversation without an id is `null`, and null as conv_id where it is alone). No conversations,
    no rows, not even a root.

    A conversation of any length is spread over shards by stretches of `stretch` turns, a prefix that many share is counted in each shard
    first. Digests of 128 bits stand for the turns. The ids that end at one node are put together by many tasks;
    only the running hash over them, which the definition makes one sequence, is one task's work, `ids_a_row` of them a row.
    """
    paths = staged(_with_digests(paths, stretch))
    slim = paths.drop("last")
    counted = _dealt(slim).mapInArrow(partial(_count, stretch=stretch, rows=shard), _NODES)
    nodes = counted.groupBy(*_KEY).agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv").alias("conv"), F.max("size").alias("size"), F.max("up_low").alias("up_low"), F.max("up_high").alias("up_high")
    )
    nodes = staged(nodes)
    below = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_low").alias("low"), F.col("up_high").alias("high"))
    children = below.agg(F.count(F.lit(1)).alias("n_children"))
    nodes = staged(nodes.join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))

    own = nodes.select(
        "conv", F.floor(F.col("depth") / stretch).alias("chunk"), *_KEY,
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved"), (F.col("n_children") == 0).cast("long").alias("leaves"),
    ).where("saved > 0 or leaves > 0")
    # what stands in later stretches of a conversation counts from the last node of each earlier one on
    sums = own.groupBy("conv", "chunk").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    bridges = paths.where(F.col("depth") % stretch == stretch - 1).select("conv", "chunk", *_KEY)
    steps = bridges.join(sums, ["conv", "chunk"], "full")
    later = W.partitionBy("conv").orderBy(F.col("chunk").desc()).rowsBetween(W.unboundedPreceding, -1)
    carried = steps.select("conv", "chunk", *_KEY, F.sum("saved").over(later).alias("saved"), F.sum("leaves").over(later).alias("leaves")).where("low is not null")
    carried = carried.select("conv", "chunk", *_KEY, F.coalesce("saved", F.lit(0)).alias("saved"), F.coalesce("leaves", F.lit(0)).alias("leaves"))
    weights = own.unionByName(carried.where("saved > 0 or leaves > 0"))
    both = slim.unionByName(weights, allowMissingColumns=True).fillna(0, ["up_low", "up_high", "size"])
    added = _dealt(both).mapInArrow(partial(_add, stretch=stretch, rows=shard), "depth long, low long, high long, saved long, leaves long")
    totals = added.groupBy(*_KEY).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))

    by = ["low", "high", "conv"]
    ids = paths.where("last").select(*by).repartitionByRange(*by).sortWithinPartitions(*by)
    ids = ids.mapInArrow(partial(_join_ids, most=ids_a_row), "low long, high long, first long, ids string")
    ends = staged(ids.repartition("low", "high").sortWithinPartitions("low", "high", "first").mapInArrow(_hash_ids, "low long, high long, ends_sha256 string"))
    whole = staged(nodes.join(totals, _KEY, "left").join(ends, ["low", "high"], "left"))

    groups = nodes.where("n_children > 0").select(F.struct("low", "high").alias("key"), F.col("conv").alias("parent"), F.col("n_children").alias("many"))
    keyed = whole.withColumn("key", F.when(F.col("depth") > 0, F.struct(F.col("up_low").alias("low"), F.col("up_high").alias("high"))))
    out = join_groups(keyed, groups, "key", "many", nodes.count(), "low")

    def shown(conv: str):
        return F.when(F.col(conv) != NO_ID, F.col(conv))

    return out.select(
        shown("conv").alias("conv_id"), "depth", shown("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
