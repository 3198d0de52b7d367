"""Best-fit packing with Martello-Toth dominance reduction, on the histogram of piece lengths.

Which document has which length does not matter for a packing, only how many pieces of each
length there are. The lengths are at most `capacity`, so the whole instance, however many
documents it stands for, is `capacity` counts. Reduction and best fit work on those counts
in bulk; the resulting plan deals out places to the numbered pieces of each length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeline.llm.common import give_back, staged
from tapeline.llm.words import REMEMBER, SLICE, WordTokenizer, slices

CAPACITY = 4096
END_ID = 1
#: Pieces of one length are numbered in this many buckets at least, by as many tasks.
BUCKETS = 64

Runs = tuple[tuple[int, int], ...]  # (length, copies) in a sequence


_tokenizers: dict[str, WordTokenizer] = {}


def tokenize(
    df: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    remember: int = REMEMBER,
    keep: bool = True,
    slice_bytes: int = SLICE,
) -> DataFrame:
    """One row for each piece: id, piece, start, length, ids_crc32. A text's ids end with `end_id`; only longer ones are cut.

    A worker keeps the tokenizer and half of the words it remembers for its next task, unless `keep` is false. It holds a
    slice of about `slice_bytes` of texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _tokenizers.pop(path, None) or WordTokenizer(path, remember)
        for part, texts in slices(batches, most=slice_bytes):
            owner, rows = [], []
            for i, ids in enumerate(own.encode(texts)):
                whole = np.append(ids, np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(whole), capacity)):
                    cut = whole[start : start + capacity]
                    owner.append(i)
                    rows.append((piece, start, len(cut), zlib.crc32(cut.tobytes())))
            arrays = [pa.array(list(x), kind) for x, kind in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            ids = part.column("id").take(pa.array(owner)).combine_chunks()
            yield pa.RecordBatch.from_arrays([ids, *arrays], [id_col, "piece", "start", "length", "ids_crc32"])
        if keep:
            own.forget(remember // 2)
            _tokenizers[path] = own
        del own
        give_back()

    kind = df.schema[id_col].dataType.simpleString()
    slim = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return slim.mapInArrow(run, f"{id_col} {kind}, piece int, start long, length long, ids_crc32 long")


def reduce_by_dominance(counts: np.ndarray, capacity: int) -> list[tuple[Runs, int]]:
    """Fix every sequence that provably belongs to some optimal packing; `counts` keeps the rest.

    For a longest open length j, a set holding j dominates all others that hold it if
    - nothing else fits beside j, or
    - a k fills the rest exactly, or
    - no two others fit beside j, and k is the largest that fits, or
    - no three others fit, and the largest k that fits is as long as any two that fit together.
    A condition that holds once holds while j and k last, as the rest only shrinks.
    """
    fixed: list[tuple[Runs, int]] = []
    for j in range(capacity, 0, -1):
        while counts[j]:
            counts[j] -= 1
            rest = capacity - j
            open_lengths = np.flatnonzero(counts[: rest + 1])
            if not len(open_lengths):
                counts[j] += 1
                many = int(counts[j]) if j > rest else 1
                fixed.append((((j, 1),), many))
                counts[j] -= many
                continue
            k = int(open_lengths[-1])
            smallest = np.repeat(open_lengths[:3], np.minimum(counts[open_lengths[:3]], 3))[:3]
            sure = k == rest or len(smallest) < 2 or smallest[0] + smallest[1] > rest
            if not sure and (len(smallest) < 3 or smallest.sum() > rest):
                pairs = open_lengths[np.searchsorted(open_lengths, rest - open_lengths, "right") - 1]
                fits = (open_lengths + pairs <= rest) & ((pairs != open_lengths) | (counts[open_lengths] > 1))
                lower = np.maximum(np.searchsorted(open_lengths, open_lengths) - 1, 0)  # where a length has no second copy
                alone = (pairs == open_lengths) & (counts[open_lengths] == 1) & (np.arange(len(open_lengths)) > 0)
                best = max([int((open_lengths + pairs)[fits].max(initial=0)), int((open_lengths + open_lengths[lower])[alone].max(initial=0))])
                sure = k >= best
            counts[j] += 1
            if not sure:
                break
            many = int(counts[j] // 2 if k == j else min(counts[j], counts[k]))
            fixed.append((((j, 2),) if k == j else ((j, 1), (k, 1)), many))
            counts[j] -= many
            counts[k] -= many
    return fixed


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Runs, int]]:
    """Best-fit decreasing, all pieces of a length at once: (what is in a sequence, how many such sequences)."""
    groups: dict[int, list[tuple[Runs, int]]] = {}
    rooms: list[int] = []

    def put(room: int, runs: Runs, many: int) -> None:
        if many:
            if room not in groups:
                groups[room] = []
                insort(rooms, room)
            groups[room].append((runs, many))

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                runs, many = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, runs, many = capacity, (), left
            each = room // length
            full = min(many, left // each)
            put(room - each * length, (*runs, (length, each)), full)
            left -= full * each
            last = left if full < many and left < each else 0
            if last:
                put(room - last * length, (*runs, (length, last)), 1)
                left = 0
            if runs:
                put(room, runs, many - full - (1 if last else 0))
    return [group for found in groups.values() for group in found]


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> tuple[dict[str, np.ndarray], int]:
    """Where the pieces of each length go, and the number of sequences.

    Row i of the plan: from number `first` on, the pieces of `length` go `each` to a sequence,
    into sequences from `sequence` on, at `offset` and after. Sorted by (length, first).
    """
    left = counts.astype(np.int64).copy()
    sequences = reduce_by_dominance(left, capacity)
    sequences += best_fit(left, capacity)
    used = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for runs, many in sequences:
        offset = 0
        for length, each in runs:
            rows.append((length, used[length], each, sequence, offset))
            used[length] += each * many
            offset += length * each
        sequence += many
    names = ("length", "first", "each", "sequence", "offset")
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {name: table[:, i] for i, name in enumerate(names)}, sequence


def pack(
    df: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    remember: int = REMEMBER,
    keep: bool = True,
    slice_bytes: int = SLICE,
) -> DataFrame:
    """One row for each piece with its sequence_id and offset.

    Null texts count as empty: one piece that holds `end_id`. Ids of any type, repeated or null, pass
    through; rows that repeat are packed each. An empty table gives no rows. Pieces of one length are numbered in hash
    buckets whose counts are lined up, so a length that a third of all pieces share is
    numbered by many tasks. The driver sees `capacity` counts. `remember`, `keep` and
    `slice_bytes` bound what a worker holds, see `tokenize`.
    """
    pieces = staged(tokenize(df, path, id_col, text_col, capacity, end_id, remember, keep, slice_bytes).withColumn("spread", F.xxhash64(id_col, "piece", "ids_crc32")))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    placed, _ = plan(counts, capacity)
    buckets = max(BUCKETS, int(counts.max()) // 100_000)
    bucket = F.pmod("spread", F.lit(buckets))
    numbered = pieces.withColumn("bucket", bucket)
    per = numbered.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    lined = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = per.select("length", "bucket", F.coalesce(F.sum("n").over(lined), F.lit(0)).alias("before"))
    inside = F.row_number().over(W.partitionBy("length", "bucket").orderBy("spread")) - 1
    numbered = numbered.withColumn("inside", inside).join(starts, ["length", "bucket"]).withColumn("number", F.col("before") + F.col("inside"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bound = placed["length"] << 40 | placed["first"]
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            at = np.searchsorted(bound, length << 40 | number, "right") - 1
            past = number - placed["first"][at]
            sequence = placed["sequence"][at] + past // placed["each"][at]
            offset = placed["offset"][at] + past % placed["each"][at] * length
            kept = [batch.column(c) for c in (id_col, "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = df.schema[id_col].dataType.simpleString()
    return numbered.select(id_col, "piece", "start", "length", "ids_crc32", "number").mapInArrow(
        deal, f"{id_col} {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
