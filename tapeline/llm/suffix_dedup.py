"""Suffix-array dedup: which bytes lie in a string of `threshold` bytes that also starts earlier?

The suffixes are ordered only through their first `threshold` bytes, most significant digit
first, and a suffix drops out as soon as it is alone in its group; the groups that remain are
the repeated windows. A digit is a block of bytes, taken by its hash, so a pass is one shuffle
and no task needs a sorted neighbour from another one. Three passes:

1. Each window is filed under an anchor: the block of GRAM bytes in it with the least hash. Equal
   windows choose equal anchors, so windows that share no anchor need no comparison, and one
   row stands for all windows filed under an anchor (one for 31 bytes on average).
   Anchors that are alone drop out.
2. Anchors with equal blocks are told apart by all bytes that the windows filed there reach (up to 160).
   Where these are equal too, all windows of the later anchor are repeats; the earliest
   one stands for the group from there on. Alone under its block: done.
3. What is left (different reaches around one block: the edges of repeated passages) is spelt
   out: the window that starts at each byte, by the hash of all its bytes. All but the earliest
   of a group are repeats.

The 64-bit key, which deals the rows out, covers the block of an anchor or all bytes of a window; the 64-bit tag,
from a second function, covers all that an anchor reaches, or the window again. So reaches around one block are told
apart by 64 bits, and windows by 128.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.llm.common import give_back, packed, slot_bits, slots_for, staged, text_slices, with_bit, with_row_key

THRESHOLD = 100
GRAM = 40
#: Bytes of text hashed at once, and bytes of text after which a task gives out what it has found.
CHUNK = 1 << 18
HELD = 4 << 20
#: Different reaches of one block in a task's text, from which on it spells out their windows at once.
#: So a task never sends more rows than this of one block, however common it is.
COMMON = 32
MAX_SLOTS = 1 << 27

ANCHOR, MARK, WINDOW, SPAN = 0, 1, 2, 3
ROW = "kind byte, key long, tag long, doc long, at int, till int"
_ROW = [("kind", pa.int8()), ("key", pa.int64()), ("tag", pa.int64()), ("doc", pa.int64()), ("at", pa.int32()), ("till", pa.int32())]

_random = np.random.default_rng(20240607)
_CODES = _random.integers(0, 1 << 64, (2, 256), np.uint64, endpoint=False) | np.uint64(1)
_BASES = _random.integers(0, 1 << 64, 2, np.uint64, endpoint=False) | np.uint64(1)
_INVERSES = np.array([pow(int(b), -1, 1 << 64) for b in _BASES], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of the two bases and of their inverses modulo 2^64, as far as they are needed."""

    tables: list[np.ndarray] = []

    @classmethod
    def up_to(cls, n: int) -> list[np.ndarray]:
        if not cls.tables or len(cls.tables[0]) < n:
            most = max(n, CHUNK + 1)
            cls.tables = [np.cumprod(np.append(np.uint64(1), np.full(most, x, np.uint64))) for x in (*_BASES, *_INVERSES)]
        return cls.tables


class Bytes:
    """Bytes of which any stretch can be hashed at once: sums of code * base^place, moved back to place 0."""

    def __init__(self, data: np.ndarray) -> None:
        self.powers = _Powers.up_to(len(data) + 1)
        self.sums = []
        for f in (0, 1):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_CODES[f][data] * self.powers[f][: len(data)], out=sums[1:])
            self.sums.append(sums)

    def hash(self, f: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[f][stop] - self.sums[f][start]) * self.powers[2 + f][start])

    def grams(self, size: int) -> np.ndarray:
        sums = self.sums[0]
        return _mixed((sums[size:] - sums[: len(sums) - size]) * self.powers[2][: len(sums) - size])


def _sliding(values: np.ndarray, size: int, best) -> np.ndarray:
    """best (minimum or maximum) of each run of `size` values."""
    width = 1
    while width * 2 <= size:
        values = best(values[:-width], values[width:])
        width *= 2
    return best(values[: len(values) - (size - width)], values[size - width :]) if width < size else values


def anchors(data: np.ndarray, ends: np.ndarray, threshold: int, gram: int) -> tuple[np.ndarray, ...]:
    """(start, stop, key, tag) of the anchors in texts that lie one after another in `data`.

    The windows filed under an anchor start one after another; start to stop is all that they
    reach, and the tag covers these bytes.
    """
    empty = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(data) < threshold:
        return empty
    whole = Bytes(data)
    grams = whole.grams(gram)
    least = _sliding(grams, threshold - gram + 1, np.minimum)  # of the window that starts here
    begins = ends - np.diff(np.append(0, ends))
    crossing = np.zeros(len(least) + 1, np.int64)
    np.add.at(crossing, np.minimum(np.maximum(ends - threshold + 1, begins), len(least)), 1)
    np.add.at(crossing, np.minimum(ends, len(least)), -1)
    least[np.cumsum(crossing[:-1]) > 0] = 0
    reach = threshold - gram
    padded = np.concatenate([np.zeros(reach, np.uint64), least, np.zeros(reach, np.uint64)])
    at = np.flatnonzero((_sliding(padded, reach + 1, np.maximum) == grams) & (grams > 0))
    filed = np.concatenate([least, np.zeros(len(data) - len(least), np.uint64)])  # no window starts there
    own, low, high = grams[at], np.full(len(at), len(data)), np.zeros(len(at), np.int64)
    for back in range(reach + 1):
        start = at - back
        held = (start >= 0) & (filed[start] == own)
        low = np.where(held, start, low)
        high = np.where(held, np.maximum(high, start + threshold), high)
    tag = whole.hash(1, low, high) ^ _mixed(((at - low) << 32 | (high - at)).astype(np.uint64))
    return low, high, own, tag.view(np.int64)


def _batch(kind: int, n: int, **columns: np.ndarray) -> pa.RecordBatch:
    values = {"kind": np.full(n, kind), "key": 0, "tag": 0, "at": 0, "till": 0} | columns
    arrays = [pa.array(np.broadcast_to(values[name], n).astype(t.to_pandas_dtype())) for name, t in _ROW]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in _ROW])


def _spans(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> list[pa.RecordBatch]:
    """Rows for the unions of overlapping or touching spans of each document."""
    if not len(doc):
        return []
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order].astype(np.int64), stop[order].astype(np.int64)
    first = np.append(True, doc[1:] != doc[:-1])
    shift = np.cumsum(first) * (1 << 33)  # so that one running maximum serves all documents
    most = np.maximum.accumulate(stop + shift)
    new = np.append(True, (start + shift)[1:] > most[:-1])
    heads = np.flatnonzero(new)
    last = np.append(heads[1:] - 1, len(doc) - 1)
    return [_batch(SPAN, len(heads), key=doc[heads], doc=doc[heads], at=start[heads], till=(most - shift)[last])]


def _later(key: np.ndarray, tag: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Most significant digit first: the rows of shared keys in the order (key, tag, doc, at); of these, which repeat the first of their (key, tag)."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    order = order[np.append(same, False) | np.append(False, same)]  # who is alone under the first digit drops out
    order = order[np.lexsort((at[order], doc[order], tag[order], key[order]))]
    k, t = key[order], tag[order]
    new = np.append(True, (k[1:] != k[:-1]) | (t[1:] != t[:-1]))[: len(order)]
    head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order, (doc[order] != doc[order][head]) | (at[order] != at[order][head])


def _concatenated(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, bytes, ends) for runs of texts of about CHUNK bytes."""
    first = 0
    while first < len(texts):
        stop, size = first, 0
        while stop < len(texts) and (stop == first or size + len(texts[stop]) <= CHUNK):
            size += len(texts[stop])
            stop += 1
        yield first, np.frombuffer(b"".join(texts[first:stop]), np.uint8), np.cumsum([len(t) for t in texts[first:stop]])
        first = stop


def _window_rows(texts: list[bytes], docs: np.ndarray, reaches: list[tuple[np.ndarray, np.ndarray]], threshold: int) -> list[pa.RecordBatch]:
    """WINDOW rows of all windows inside the (starts, stops) of each text; who repeats another one here goes out as a span."""
    found = []
    for first, data, ends in _concatenated(texts):
        whole = Bytes(data)
        for i, end in enumerate(ends, first):
            begin = int(end) - len(texts[i])
            low, many = reaches[i][0], reaches[i][1] - reaches[i][0] - threshold + 1
            start = np.unique(np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum()))
            found.append((np.full(len(start), docs[i]), start, whole.hash(0, start + begin, start + begin + threshold), whole.hash(1, start + begin, start + begin + threshold)))
    if not found:
        return []
    doc, at, key, tag = (np.concatenate(x) for x in zip(*found))
    tag = tag.view(np.int64)
    order, later = _later(key, tag, doc, at)
    gone = order[later]
    keep = np.ones(len(doc), bool)
    keep[gone] = False
    rows = _spans(doc[gone], at[gone], at[gone] + threshold)
    return [*rows, _batch(WINDOW, int(keep.sum()), key=key[keep].view(np.int64), tag=tag[keep], doc=doc[keep], at=at[keep])]


def _first_pass(texts: list[bytes], docs: np.ndarray, threshold: int, gram: int) -> list[pa.RecordBatch]:
    """Rows of some whole texts: of anchors with equal reaches only the earliest stays, the others go out as spans."""
    found = []
    for first, data, ends in _concatenated(texts):
        at, till, key, tag = anchors(data, ends, threshold, gram)
        text = np.searchsorted(ends, at, "right")
        begin = np.append(0, ends)[text]
        found.append((text + first, at - begin, till - begin, key, tag))
    number, at, till, key, tag = (np.concatenate(x) for x in zip(*found))
    if not len(number):
        return []
    doc = docs[number]
    order, later = _later(key, tag, doc, at)
    gone = order[later]
    rows = _spans(doc[gone], at[gone], till[gone])
    stays = order[~later]  # still in the order of key
    run = np.flatnonzero(np.append(True, key[stays][1:] != key[stays][:-1])[: len(stays)])
    many = np.diff(np.append(run, len(stays)))
    common = stays[np.repeat(many > COMMON, many)]
    keep = np.ones(len(doc), bool)
    keep[gone] = keep[common] = False
    rows.append(_batch(ANCHOR, int(keep.sum()), key=key[keep].view(np.int64), tag=tag[keep], doc=doc[keep], at=at[keep], till=till[keep]))
    if len(common):
        marks = np.unique(key[common]).view(np.int64)
        rows.append(_batch(MARK, len(marks), key=marks, doc=0))
        common = common[np.argsort(number[common], kind="stable")]
        own, begins = np.unique(number[common], return_index=True)
        reaches = list(zip(np.split(at[common], begins[1:]), np.split(till[common], begins[1:])))
        rows += _window_rows([texts[i] for i in own], docs[own], reaches, threshold)
    return rows


def _columns(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray] | None:
    held = list(batches)
    if not held:
        return None
    table = pa.Table.from_batches(held)
    return {name: table.column(name).to_numpy() for name in table.column_names}


def covered_spans(rows: DataFrame, threshold: int = THRESHOLD, gram: int = GRAM) -> DataFrame:
    """(doc, at, till): spans of the texts in rows (row_key, text) whose bytes repeat. Spans of a document may overlap."""

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[bytes] = []
        docs: list[np.ndarray] = []
        size = 0
        for part, some in text_slices(batches):
            texts += some
            docs.append(part.column("row_key").to_numpy())
            size += sum(map(len, some))
            if size >= HELD:
                yield from _first_pass(texts, np.concatenate(docs), threshold, gram)
                texts, docs, size = [], [], 0
        if texts:
            yield from _first_pass(texts, np.concatenate(docs), threshold, gram)
        del texts, docs
        give_back()

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _columns(batches)
        if c is None:
            return
        held = c["kind"] >= WINDOW
        if held.any():
            yield pa.RecordBatch.from_arrays([pa.array(c[name][held]) for name, _ in _ROW], [name for name, _ in _ROW])
        marked = np.unique(c["key"][c["kind"] == MARK])
        own = c["kind"] == ANCHOR
        key, tag, doc, at, till = (c[name][own] for name in ("key", "tag", "doc", "at", "till"))
        order, later = _later(key, tag, doc, at)
        gone = order[later]
        yield from _spans(doc[gone], at[gone], till[gone])
        stays = order[~later]
        run = np.flatnonzero(np.append(True, key[stays][1:] != key[stays][:-1])[: len(stays)])
        many = np.diff(np.append(run, len(stays)))
        edge = np.isin(key, marked)  # blocks that another task has spelt out
        edge[stays[np.repeat(many > 1, many)]] = True
        edge[gone] = False
        yield _batch(ANCHOR, int(edge.sum()), key=key[edge], tag=tag[edge], doc=doc[edge], at=at[edge], till=till[edge])
        del c, held, own, key, tag, doc, at, till, order, later, gone, stays, run, many, edge
        give_back()

    def spell_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, rows=512):
            starts, stops = ([np.array(x, np.int64) for x in part.column(c).to_pylist()] for c in ("starts", "stops"))
            yield from _window_rows(texts, part.column("row_key").to_numpy(), list(zip(starts, stops)), threshold)
        give_back()

    def third_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _columns(batches)
        if c is None:
            return
        held = c["kind"] == SPAN
        if held.any():
            yield from _spans(c["doc"][held], c["at"][held], c["till"][held])
        key, tag, doc, at = (c[name][~held] for name in ("key", "tag", "doc", "at"))
        order, later = _later(key, tag, doc, at)
        gone = order[later]
        yield from _spans(doc[gone], at[gone], at[gone] + threshold)
        del c, held, key, tag, doc, at, order, later, gone
        give_back()

    found = staged(rows.select("row_key", "text").mapInArrow(first_pass, ROW).repartition("key").mapInArrow(second_pass, ROW))
    edges = staged(found.where(F.col("kind") == ANCHOR).groupBy(F.col("doc").alias("row_key")).agg(F.collect_list(F.struct("at", "till")).alias("reaches")))
    edges = edges.select("row_key", F.col("reaches.at").alias("starts"), F.col("reaches.till").alias("stops"))
    texts = among(rows, edges).join(edges, "row_key").select("row_key", "text", "starts", "stops")
    windows = texts.mapInArrow(spell_out, ROW).unionByName(found.where(F.col("kind") >= WINDOW))
    return windows.repartition("key").mapInArrow(third_pass, ROW).select("doc", "at", "till")


def among(rows: DataFrame, chosen: DataFrame, outside: bool = False) -> DataFrame:
    """The rows whose row_key may be in `chosen`, by a bitmap of fixed size; `outside`: those that surely are not."""
    slots = slots_for(chosen.count(), 16, MAX_SLOTS)
    slot = lambda: F.pmod(F.xxhash64("row_key"), F.lit(slots))
    bits = staged(slot_bits(chosen.select(slot().alias("slot")).distinct(), "slot"))
    marked = with_bit(rows, bits, slot(), "maybe")
    return marked.where(~F.col("maybe") if outside else F.col("maybe")).drop("maybe")


def _merged(spans: list[dict], size: int) -> list[tuple[int, int]]:
    """Union of the spans within a text of `size` bytes."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted((s["at"], min(s["till"], size)) for s in spans or []):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def _with_spans(rows: DataFrame, threshold: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """(rows surely without a repeat, the other rows with their `spans`, which may be null). Only the latter shuffle."""
    spans = covered_spans(rows, threshold, gram).groupBy(F.col("doc").alias("row_key")).agg(F.collect_list(F.struct("at", "till")).alias("spans"))
    spans = staged(spans)
    return among(rows, spans, outside=True), among(rows, spans).join(spans, "row_key", "left")


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = with_row_key(packed(df, id_col, text_col).toDF("row", "id", "text"), "id", "text")
    return rows.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))


def removed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, gram: int = GRAM) -> DataFrame:
    """Each row's id, n_bytes, n_removed, n_spans and kept_sha256.

    A byte is removed if a string of `threshold` bytes that covers it also starts earlier: in a
    row of smaller id (nulls first; rows that repeat an id are ordered by their text), or earlier in the
    same text; overlaps count. Texts are whole UTF-8 bytes, null is empty, and shorter ones
    lose nothing. Other columns are not read. An empty table gives no rows.
    """
    plain = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = with_row_key(plain, "id", "text").withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    untouched, touched = _with_spans(rows, threshold, gram)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            out = []
            for text, spans in zip(texts, part.column("spans").to_pylist()):
                gone, sha, last = _merged(spans, len(text)), hashlib.sha256(), 0
                for start, stop in gone:
                    sha.update(text[last:start])
                    last = stop
                sha.update(text[last:])
                out.append((len(text), sum(b - a for a, b in gone), len(gone), sha.hexdigest()))
            arrays = [pa.array(list(x), kind) for x, kind in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([part.column("id"), *arrays], [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = df.schema[id_col].dataType.simpleString()
    none = F.lit(0).cast("long")
    same = untouched.select(
        F.col("id").alias(id_col),
        F.octet_length("text").cast("long").alias("n_bytes"),
        none.alias("n_removed"),
        none.alias("n_spans"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )
    cut = touched.select("id", "text", "spans").mapInArrow(measure, f"{id_col} {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return same.unionByName(cut)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, gram: int = GRAM) -> DataFrame:
    """The rows of `df`, their texts without the repeated bytes; rows that lose all of their text go.

    A character of which bytes are removed goes as a whole. Null texts stay null.
    """
    rows = _rows(df, id_col, text_col)
    untouched, touched = _with_spans(rows, threshold, gram)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            left = []
            for data, own in zip(texts, part.column("spans").to_pylist()):
                pieces, last = [], 0
                for start, stop in _merged(own, len(data)):
                    pieces.append(data[last:start].decode(errors="ignore"))
                    last = stop
                left.append("".join([*pieces, data[last:].decode(errors="ignore")]))
            some = pa.array([bool(kept) or not data for kept, data in zip(left, texts)], pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column("row").filter(some), pa.array(left, pa.string()).filter(some)], ["row", "left"])
        give_back()

    kept = T.StructType([touched.schema["row"], T.StructField("left", T.StringType())])
    cut_rows = touched.select("row", "text", "spans").mapInArrow(cut, kept)
    text_kept = F.when(F.col("row")[text_col].isNull(), F.lit(None)).otherwise(F.col("left"))
    changed = cut_rows.withColumn("row", F.col("row").withField(f"`{text_col}`", text_kept))
    return untouched.select("row.*").unionByName(changed.select("row.*"))
