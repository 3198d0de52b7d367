"""Bounded-space online packing: a fixed number of open windows a task, best fit, merged leftovers.

Each task reads its documents once, in any order, and keeps `windows` open windows. A document goes whole into the
window it fits best. Where none fits and no new one may be opened, the fullest is emitted; since documents may be cut,
it is topped up with the document's beginning first, so it leaves without padding. What is open at a
task's end is merged, task by task and then group of tasks by group of tasks: every step leaves
less than one window, and the very last is cut into windows whose lengths are powers of two.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import give_back, staged, whole_groups
from tapeline.llm.words import REMEMBER, WordTokenizer, slices

CAPACITY = 2048
END_ID = 1
WINDOWS = 64
#: Tasks whose leftovers are merged by one task of the next round.
GROUP = 16

Piece = tuple[object, int, np.ndarray, int]  # document, start in it, ids, tokens of the document


class Packer:
    """The open windows of one task. `out` takes the pieces of a window that is emitted."""

    def __init__(self, capacity: int, windows: int, out) -> None:
        self.capacity, self.windows, self.out = capacity, windows, out
        self.open: list[tuple[int, int]] = []  # (room left, key), the fullest first
        self.held: dict[int, list[Piece]] = {}
        self.keys = 0

    def add(self, doc: object, ids: np.ndarray, tokens: int, start: int = 0) -> None:
        whole = len(ids) - len(ids) % self.capacity
        for at in range(0, whole, self.capacity):
            self.out([(doc, start + at, ids[at : at + self.capacity], tokens)])
        start, ids = start + whole, ids[whole:]
        while len(ids):
            at = bisect_left(self.open, (len(ids), -1))
            if at == len(self.open):
                if at < self.windows:
                    self.keys += 1
                    self.held[self.keys] = []
                    self.open.append((self.capacity, self.keys))
                else:
                    at = 0  # the fullest: topped up, emitted
            room, key = self.open.pop(at)
            cut = ids[:room]
            self.held[key].append((doc, start, cut, tokens))
            start, ids, room = start + len(cut), ids[room:], room - len(cut)
            if room:
                insort(self.open, (room, key))
            else:
                self.out(self.held.pop(key))

    def leftover(self) -> list[Piece]:
        """Less than one window: what is left when the open windows are merged, the fullest first."""
        merged = Packer(self.capacity, 1, self.out)
        for _, key in self.open:
            for doc, start, ids, tokens in self.held[key]:
                merged.add(doc, ids, tokens, start)
        self.open, self.held = [], {}
        return [piece for pieces in merged.held.values() for piece in pieces]


def _by_powers(pieces: list[Piece], out) -> None:
    """Windows whose lengths are distinct powers of two, the longest first."""
    left = sum(len(ids) for _, _, ids, _ in pieces)
    window, room = [], 0
    for doc, start, ids, tokens in pieces:
        while len(ids):
            room = room or 1 << left.bit_length() - 1
            cut = ids[:room]
            window.append((doc, start, cut, tokens))
            start, ids, room, left = start + len(cut), ids[room:], room - len(cut), left - len(cut)
            if not room:
                out(window)
                window = []


class _Rows:
    """Emitted windows and leftovers as Arrow batches."""

    def __init__(self, id_col: str, kind: pa.DataType, task: int, first: int) -> None:
        self.names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "task"]
        longs = [pa.int64()] * 6
        self.kinds = [kind, *longs, pa.binary(), pa.int64()]
        self.task, self.sequence, self.rows = task, first, []

    def emit(self, pieces: list[Piece]) -> None:
        offset = 0
        for doc, start, ids, tokens in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), tokens, self.sequence, offset, None, self.task))
            offset += len(ids)
        self.sequence += 1

    def leave(self, pieces: list[Piece]) -> None:
        for at, (doc, start, ids, tokens) in enumerate(pieces):
            self.rows.append((doc, start, len(ids), 0, tokens, None, at, ids.tobytes(), self.task))

    def flush(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        if self.rows and len(self.rows) >= least:
            yield pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in zip(zip(*self.rows), self.kinds)], self.names)
            self.rows = []


def _first_sequence(round_: int, task: int) -> int:
    """Sequences are numbered apart in each task of each round."""
    return round_ << 58 | task << 30


_tokenizers: dict[str, WordTokenizer] = {}  # what a worker keeps for its next task


def _packed(batches: Iterator[pa.RecordBatch], path: str, id_col: str, capacity: int, end_id: int, windows: int, remember: int) -> Iterator[pa.RecordBatch]:
    tokenizer = _tokenizers.pop(path, None) or WordTokenizer(path, remember)
    task = TaskContext.get().partitionId()
    rows, packer = None, None
    for part, texts in slices(batches):
        if rows is None:
            rows = _Rows(id_col, part.schema.field("id").type, task, _first_sequence(0, task))
            packer = Packer(capacity, windows, rows.emit)
        for doc, ids in zip(part.column("id").to_pylist(), tokenizer.encode(texts)):
            whole = np.append(ids, np.uint32(end_id)).astype("<u4")
            packer.add(doc, whole, len(whole))
        yield from rows.flush(1000)
    if rows is not None:
        rows.leave(packer.leftover())
        yield from rows.flush()
    tokenizer.forget(remember // 2)
    _tokenizers[path] = tokenizer
    give_back()


def _merged(batches: Iterator[pa.RecordBatch], id_col: str, capacity: int, round_: int, last: bool) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, "group"):
        groups = table.column("group").to_pylist()
        columns = [table.column(c).to_pylist() for c in (id_col, "start", "ids", "doc_tokens")]
        rows, packer, group = None, None, None
        for own, doc, start, ids, tokens in [*zip(groups, *columns), (None,) * 5]:
            if own != group:
                if rows is not None:
                    left = packer.leftover()
                    if last:
                        _by_powers(left, rows.emit)
                    else:
                        rows.leave(left)
                    yield from rows.flush()
                if ids is None:
                    break
                group = own
                rows = _Rows(id_col, table.schema.field(id_col).type, own, _first_sequence(round_, own))
                packer = Packer(capacity, 1, rows.emit)
            packer.add(doc, np.frombuffer(ids, "<u4"), tokens, start)


def pack(
    df: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    windows: int = WINDOWS,
    group: int = GROUP,
    remember: int = REMEMBER,
) -> DataFrame:
    """One row for each piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids by the tokenizer at `path`, then `end_id`. Null texts count as empty: one piece that holds `end_id`. Ids of
    any type, repeated or null, pass through; rows that repeat are packed each. Other columns are not read. An empty table gives
    no rows. Sequences have `capacity` tokens but for at most one of each smaller power of two, over the whole table, so nothing is padded.

    A task holds one slice of texts, a bounded store of words, and `windows` open windows of at most `capacity` ids. One merge
    task holds the leftovers, each less than a window, of `group` others. No text is shuffled and the driver sees nothing.
    """
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary, task long"
    slim = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    run = partial(_packed, path=path, id_col=id_col, capacity=capacity, end_id=end_id, windows=windows, remember=remember)
    rounds = [staged(slim.mapInArrow(run, schema))]
    while True:
        left = rounds[-1].where("sequence_id is null")
        tasks = left.select("task").distinct().count()
        if not tasks:
            break
        last = tasks <= group
        grouped = left.withColumn("group", F.lit(0).cast("long") if last else F.floor(F.col("task") / group))
        dealt = grouped.repartition("group").sortWithinPartitions("group", "task", "offset")
        merge = partial(_merged, id_col=id_col, capacity=capacity, round_=len(rounds), last=last)
        rounds.append(staged(dealt.mapInArrow(merge, schema)))
    out = None
    for pieces in rounds:
        own = pieces.where("sequence_id is not null").drop("ids", "task")
        out = own if out is None else out.unionByName(own)
    return out
