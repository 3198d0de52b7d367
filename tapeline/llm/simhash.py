"""SimHash near-dedup with pigeonring filtering.

A 64-bit fingerprint is a ring of four segments. If two fingerprints differ in at most d bits,
there is a segment from which on every chain of l consecutive segments differs in at most
l * d / 4 bits. For d = 3: that segment is equal, it and the next differ in at most 1 bit, the
first three in at most 2. The first two conditions are made the search key (one bit in the
second segment leaves three of its four quarters equal); the longer chains are checked before
the full distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import give_back, join_groups, packed, staged, text_slices, with_row_key
from tapeline.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 3
SEGMENTS = 4
SEGMENT_BITS = 16
#: Buckets of more fingerprints than SMALL are first joined by one-bit differences, then compared in blocks.
SMALL = 256
BLOCK = 1024


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles, repeats included; 0 without a word."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII blanks
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(line, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.append(0, ends[:-shingle]).tolist()
        hashes = [xxh64_intdigest(line[a:b], 42) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], np.uint64)
        bits += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(bits * 2 > len(hashes)).tobytes(), "big")


def fingerprints(rows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(row_key, id, fingerprint as a signed long) for each row of (row_key, id, text); null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            found = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("row_key"), part.column("id"), pa.array(found)], ["row_key", "id", "fingerprint"])
        give_back()

    return rows.select("row_key", "id", "text").mapInArrow(run, f"row_key long, id {rows.schema['id'].dataType.simpleString()}, fingerprint long")


def _segment(prints: np.ndarray, i: int) -> np.ndarray:
    return (prints >> np.uint64(SEGMENT_BITS * (i % SEGMENTS))) & np.uint64((1 << SEGMENT_BITS) - 1)


def ring_keys(prints: np.ndarray, max_bits: int) -> list[np.ndarray]:
    """Keys of which two fingerprints within `max_bits` share one: a segment with budget 0, and parts of the next one.

    A key's first five bits say which segment and which parts it is made of.
    """
    if not 0 <= max_bits < SEGMENTS:
        raise ValueError("the first segment of a chain must be equal: at most 3 bits")
    allowed = 2 * max_bits // SEGMENTS  # differing bits that a chain of two segments may have
    quarter, quarters = 4, 4
    keys = []
    for i in range(SEGMENTS):
        first, second = _segment(prints, i), _segment(prints, i + 1)
        for kind, parts in enumerate(combinations(range(quarters), quarters - allowed)):
            key = first | np.uint64((i * 8 + kind) << 58)
            for place, part in enumerate(parts):
                value = (second >> np.uint64(quarter * part)) & np.uint64(15)
                key = key | (value << np.uint64(SEGMENT_BITS + quarter * place))
            keys.append(key)
    return keys


def _chain_holds(difference: np.ndarray, start: np.ndarray, max_bits: int) -> np.ndarray:
    """Do all chains from segment `start` on stay within their share of the budget? The last one is the whole distance."""
    total = np.zeros(difference.shape, np.int64)
    ok = np.ones(difference.shape, bool)
    for l in range(SEGMENTS):
        at = ((start + l) % SEGMENTS * SEGMENT_BITS).astype(np.uint64)
        total += np.bitwise_count((difference >> at) & np.uint64((1 << SEGMENT_BITS) - 1))
        ok &= total * SEGMENTS <= (l + 1) * max_bits
    return ok


class _Forest:
    """Union-find over n members, in whole-array steps."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            a, b = np.minimum(a, b), np.maximum(a, b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, b, a)
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def _join_small(keys: np.ndarray, prints: np.ndarray, sizes: np.ndarray, max_bits: int) -> np.ndarray:
    """Root of each member: all small buckets at once, each member against the one `step` places on."""
    forest = _Forest(len(keys))
    segment = (keys >> np.uint64(61)).astype(np.int64)
    ends = np.repeat(np.cumsum(sizes), sizes)
    at = np.flatnonzero((np.repeat(sizes, sizes) <= SMALL) & (ends - np.arange(len(keys)) > 1))
    found, step = [], 1
    while len(at):
        ok = at[_chain_holds(prints[at] ^ prints[at + step], segment[at], max_bits)]
        found.append(np.stack([ok, ok + step]))
        step += 1
        at = at[ends[at] - at > step]
    if found:
        forest.union(*np.concatenate(found, axis=1))
    return forest.root


def _join_large(prints: np.ndarray, max_bits: int) -> np.ndarray:
    """Root of each member of one large bucket.

    First members that differ in one bit are joined, by sorting with that bit masked (64
    sorts). Blocks whose members are then all joined need no comparison, so a dense
    cluster costs its size times 64, not its square.
    """
    forest = _Forest(len(prints))
    for bit in range(64):
        masked = prints & ~np.uint64(1 << bit)
        order = np.argsort(masked, kind="stable")
        same = np.flatnonzero(masked[order][1:] == masked[order][:-1])
        forest.union(order[same], order[same + 1])
    order = np.argsort(forest.root, kind="stable")
    for a in range(0, len(order), BLOCK):
        for b in range(a, len(order), BLOCK):
            left, right = order[a : a + BLOCK], order[b : b + BLOCK]
            first = forest.root[left[0]]
            if (forest.root[left] == first).all() and (forest.root[right] == first).all():
                continue
            x, y = np.nonzero(np.bitwise_count(prints[left][:, None] ^ prints[right][None, :]) <= max_bits)
            forest.union(left[x], right[y])
    return forest.root


def link_bucket_members(keys: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (indices) that join all members of each bucket (run of equal keys) connected within `max_bits` bits."""
    n = len(keys)
    sizes = np.diff(np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), n))
    root = _join_small(keys, prints, sizes, max_bits)
    for start, size in zip((np.cumsum(sizes) - sizes)[sizes > SMALL], sizes[sizes > SMALL]):
        root[start : start + size] = start + _join_large(prints[start : start + size], max_bits)
    linked = np.flatnonzero(root != np.arange(n))
    return linked, root[linked]


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) links between distinct fingerprints (rep, fingerprint) that connect what pairs within `max_bits` connect.

    A task holds its share of the search keys: 16 keys of 29 bits and more a fingerprint. A bucket
    with any share of the fingerprints is one sixteenth of that share of the keys, and costs no square.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("fingerprint").to_numpy().view(np.uint64)
            for keys in ring_keys(own, max_bits):
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch.column("fingerprint"), batch.column("rep")], ["key", "fingerprint", "rep"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        keys, own, rep = (table.column(c).to_numpy() for c in ("key", "fingerprint", "rep"))
        order = np.argsort(keys, kind="stable")
        keys, own, rep = keys[order].view(np.uint64), own[order].view(np.uint64), rep[order]
        a, b = link_bucket_members(keys, own, max_bits)
        pairs = np.unique(np.stack([rep[a], rep[b]], axis=1), axis=0) if len(a) else np.empty((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])
        del held, table, keys, own, rep, order, a, b, pairs
        give_back()

    keyed = prints.select("rep", "fingerprint").mapInArrow(spread, "key long, fingerprint long, rep long")
    return keyed.repartition("key").mapInArrow(compare, "a long, b long")


def _marked(rows: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """(row_key, id, fingerprint, component) of rows (row_key, id, text); component is the first row_key reachable."""
    prints = staged(fingerprints(rows, shingle))
    groups = staged(prints.groupBy("fingerprint").agg(F.min("row_key").alias("rep"), F.count(F.lit(1)).alias("rows")))
    component = F.col("rep")
    if max_bits:
        found = connected_components(links(groups, max_bits)).withColumnRenamed("node", "rep")
        groups = groups.join(found, "rep", "left")
        component = F.coalesce("component", "rep")
    groups = staged(groups.select("fingerprint", "rows", component.alias("component")))
    return join_groups(prints, groups, "fingerprint", "rows", prints.count(), "row_key")


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return with_row_key(packed(df, id_col, text_col).toDF("row", "id", "text"), "id", "text")


def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Each row's id, fingerprint (16 hex digits), component_id and whether it is the component's representative.

    component_id is the smallest id reachable by links of at most `max_bits` bits, the own one
    included; the row that has it is the representative. Null texts count as empty; texts without
    a word have fingerprint zero and link like any other. Null ids come before all others; rows
    that repeat an id are rows of their own, and the first in the order of id and text represents.
    An empty table gives no rows. Other columns are not read.
    """
    plain = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    marked = staged(_marked(with_row_key(plain, "id", "text"), shingle, max_bits))
    heads = marked.where("row_key = component").select("component", F.col("id").alias("component_id"))
    sizes = marked.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    named = join_groups(marked, staged(sizes.join(heads, "component")), "component", "members", marked.count(), "row_key")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return named.select(
        F.col("id").alias(id_col), digits.alias("fingerprint"), "component_id", (F.col("row_key") == F.col("component")).alias("representative")
    )


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The representative of each component, with the columns of `df`."""
    rows = _rows(df, id_col, text_col)
    dropped = staged(_marked(rows, shingle, max_bits).where("row_key <> component").select("row_key"))
    return rows.join(dropped, "row_key", "left_anti").select("row.*")
