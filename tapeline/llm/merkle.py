"""Merkle manifest of a table by time-forward processing.

Every node has a label that is larger than its children's: the last leaf below it, then its
level. A priority queue ordered by label carries each digest to the time of its parent, which
is due when all its children are known. A second sweep in reversed order carries proof
suffixes from the root back to the leaves.

The queue is external: a tree is cut into blocks of a few levels. A block's messages stand in
a heap of one task; what a block sends to the next one is written and sorted by Spark's
shuffle, by (tree, block, position), which is the order of the labels. So each round
shrinks the nodes by ARITY ** LEVELS, and no task or heap holds more than a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import numbered, staged, whole_groups

ARITY = 3
#: Levels of a block: a task climbs 3 ** 4 = 81 consecutive nodes at a time.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

Step = tuple[str, str]  # the siblings left and right of a node, each joined
PROOF = "array<struct<left: string, right: string>>"
_STEP = pa.struct([("left", pa.string()), ("right", pa.string())])


def leaf_digest(*fields: Column) -> Column:
    """Lowercase hex sha256 of the fields one after the other: `-` for null, else UTF-8 byte count, `:`, value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that `leaf` and the siblings in `proof` give."""
    return F.aggregate(proof, leaf, lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """Sha256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""), 256)


class Block:
    """The nodes above consecutive nodes of one level, from position `first` on; `total` such nodes are in the tree."""

    def __init__(self, digests: list[str], first: int, total: int) -> None:
        self.digests, self.first, self.end = digests, first, first + len(digests)
        self.height = 0
        while self.height < LEVELS and ARITY**self.height < total:
            self.height += 1
        self.children: dict[tuple[int, int], list[str]] = {}

    def label(self, level: int, position: int) -> tuple[int, int, int]:
        return min((position + 1) * ARITY**level, self.end) - 1, level, position

    def climb(self) -> str:
        """The digest of the node on top. Labels come up in ascending order, those of one node together."""
        queue: list[tuple[tuple[int, int, int], int, str]] = []
        top = ""

        def send(level: int, position: int, digest: str) -> None:
            nonlocal top
            if level == self.height:
                top = digest
            else:
                heappush(queue, (self.label(level + 1, position // ARITY), position, digest))

        for at, digest in enumerate(self.digests, self.first):
            send(0, at, digest)
            while queue and queue[0][0][0] == at:
                _, level, position = label = queue[0][0]
                own = self.children[level, position] = []
                while queue and queue[0][0] == label:
                    own.append(heappop(queue)[2])
                send(level, position, hashlib.sha256("".join(own).encode()).hexdigest())
        return top

    def descend(self, suffix: list[Step]) -> list[list[Step]]:
        """The proof of each node below, whose last steps are `suffix`. Labels come up in descending order; call `climb` first."""
        proofs: list[list[Step]] = [suffix] * len(self.digests)
        last, level, position = self.label(self.height, self.first // ARITY**self.height)
        queue = [(-last, -level, -position, suffix)]
        while queue:
            _, level, position, proof = heappop(queue)
            level, position = -level, -position
            if level == 0:
                proofs[position - self.first] = proof
                continue
            own = self.children[level, position]
            for i in range(len(own)):
                last, below, at = self.label(level - 1, position * ARITY + i)
                heappush(queue, (-last, -below, -at, [("".join(own[:i]), "".join(own[i + 1 :])), *proof]))
        return proofs


def _climbed(nodes: DataFrame) -> DataFrame:
    """The tops of all blocks of `nodes` (tree, pos, digest, n) as nodes."""
    size = ARITY**LEVELS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "tree", "block"):
            rows = zip(*(table.column(c).to_pylist() for c in ("tree", "block", "pos", "digest", "n")))
            out = []
            for (tree, block), own in groupby(rows, lambda r: r[:2]):
                own = list(own)
                out.append((tree, block, Block([r[3] for r in own], own[0][2], own[0][4]).climb(), -(-own[0][4] // size)))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in zip(zip(*out), kinds)], ["tree", "pos", "digest", "n"])

    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
    slim = nodes.select("tree", F.floor(F.col("pos") / size).alias("block"), "pos", "digest", "n")
    return slim.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos").mapInArrow(run, "tree string, pos long, digest string, n long")


def _swept(nodes: DataFrame, messages: DataFrame, carried: str | None = None) -> DataFrame:
    """What each node of `nodes` learns from the message (tree, pos, proof, subroot, root) to the block above it.

    Gives messages to the nodes, or, if `carried` names a column of `nodes`, that column with digest and message.
    """
    size = ARITY**LEVELS
    rest = carried or "pos"
    kind = nodes.schema[rest].dataType
    block = F.floor(F.col("pos") / size)
    members = nodes.select("tree", block.alias("block"), F.lit(1).alias("kind"), "pos", "digest", "n", F.col(rest).alias("rest"))
    told = messages.select("tree", F.col("pos").alias("block"), F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("pos"), "proof", "subroot", "root")
    names = ["tree", rest, *(["digest"] if carried else []), "proof", "subroot", "root"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "tree", "block"):
            is_member = table.column("kind").to_numpy() == 1
            rows = list(zip(*(table.column(c).to_pylist() for c in ("tree", "block", "pos", "digest", "n", "proof", "subroot", "root"))))
            proofs: list[list[Step]] = []
            roots: list[tuple[str, str]] = []
            for _, own in groupby(rows, lambda r: r[:2]):
                told, *below = own
                found = Block([r[3] for r in below], below[0][2], below[0][4])
                found.climb()
                proofs += found.descend([(s["left"], s["right"]) for s in told[5]])
                roots += [told[6:]] * len(below)
            steps = [step for proof in proofs for step in proof]
            offsets = [0]
            for proof in proofs:
                offsets.append(offsets[-1] + len(proof))
            both = [pa.array([s[i] for s in steps], pa.string()) for i in (0, 1)]
            proof = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(both, fields=list(_STEP)))
            kept = table.filter(pa.array(is_member)).combine_chunks()
            arrays = [
                *[_one(kept.column(c)) for c in ("tree", "rest", *(["digest"] if carried else []))],
                proof,
                *[pa.array([r[i] for r in roots], pa.string()) for i in (0, 1)],
            ]
            yield pa.RecordBatch.from_arrays(arrays, names)

    both = members.unionByName(told, allowMissingColumns=True)
    sorted_ = both.repartition("tree", "block").sortWithinPartitions("tree", "block", "kind", "pos")
    schema = f"tree string, {rest} {kind.simpleString()}, " + ("digest string, " if carried else "") + f"proof {PROOF}, subroot string, root string"
    return sorted_.mapInArrow(run, schema)


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _rounds(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Nodes of each round, the leaves first, and the top of each tree (tree, round, digest)."""
    rounds = [leaves, staged(_climbed(leaves))]
    while not (high := rounds[-1].where("n > 1")).isEmpty():
        rounds.append(staged(_climbed(high)))
    tops = None
    for i, nodes in enumerate(rounds[1:], 1):
        own = nodes.where("n = 1").select("tree", F.lit(i).alias("round"), "digest")
        tops = own if tops is None else tops.union(own)
    return rounds, tops


def _proofs(rounds: list[DataFrame], tops: DataFrame, carried: str) -> DataFrame:
    """The reversed sweep, from a message (tree, round, proof, subroot, root) for each tree to its leaves."""
    columns = ["tree", "pos", "proof", "subroot", "root"]
    start = tops.withColumn("pos", F.lit(0).cast("long"))
    messages = None
    for i in range(len(rounds) - 1, 0, -1):
        own = start.where(F.col("round") == i).select(*columns)
        messages = own if messages is None else own.unionByName(messages)
        if i > 1:
            messages = staged(_swept(rounds[i - 1].where("n > 1"), messages)).select(*columns)
    return _swept(rounds[0], messages, carried)


def manifest(df: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: tuple[str, ...] = FIELDS, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row for each row of `df`: id, leaf, subroot, root, proof, and the columns `extra` (name: expression over `df`).

    leaf is `leaf_digest` of `fields`. Leaves of a group ascend by id (nulls first); rows with the same
    id come in the order of their leaves, wholly equal rows in any. While several nodes remain, every three
    consecutive ones become their hash (the last run may be shorter, even one). What remains is
    subroot; the subroots of all groups, in the order of the group's name as UTF-8 bytes, nulls
    first, give root in the same way. proof holds for each level the siblings left and right, from the
    leaf to the root; `fold(leaf, proof)` is root. One row alone: all three digests are equal and the proof has no step
    that names a sibling. An empty table gives no rows. Columns other than these are not read.

    Texts are hashed where they are read and never shuffled. A group with a third of all rows, or a single id
    with that many, is numbered, climbed and swept by many tasks; no task holds more than a block.
    """
    added = {"__id": F.col(f"`{id_col}`"), **(extra or {})}
    source = df.select(
        F.col(f"`{group_col}`").cast("string").alias("tree"),
        F.col(f"`{id_col}`").alias("id"),
        leaf_digest(*[F.col(f"`{c}`") for c in fields]).alias("digest"),
        F.struct(*[value.alias(name) for name, value in added.items()]).alias("row"),
    )
    leaves = staged(source.withColumn("line", F.monotonically_increasing_id()))
    rounds, tops = _rounds(staged(numbered(leaves, "tree", "id", "digest", "line")))
    groups = staged(tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.struct("tree", "round").alias("row"), "digest"))
    upper, root = _rounds(staged(numbered(groups, "tree", "name")))
    first = root.select("tree", "round", F.array().cast(PROOF).alias("proof"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    told = staged(_proofs(upper, first, "row").select("row.tree", "row.round", "proof", F.col("digest").alias("subroot"), "root"))
    out = _proofs(rounds, told, "row")
    return out.select(F.col("row.__id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root", "proof", *[F.col("row")[name].alias(name) for name in extra or {}])
