"""K-d tree sharding, in DataFrame functions only.

The rows are points in metadata space. A node that must hold k shards is split along its
widest dimension at the weighted quantile floor(k/2)/k of its bytes, until each leaf is one
shard of the target bytes. All nodes of a level are split together: the medians come from
distributed histograms of bytes that are refined where the median falls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.llm.common import staged

#: Bytes that each row costs beside its text.
ROW_BYTES = 16
#: A round of the search for a median looks at 2^DIGIT bins of each node, until the bin weighs less than TOLERANCE of a shard.
DIGIT = 11
TOLERANCE = 0.002
#: A key is 52 bits: 20 of the position, 16 of the text's hash, 16 of the row's.
LOW_BITS = 32
SCALE = (1 << 20) - 1


def _position(df: DataFrame, name: str) -> Column:
    """A dimension as a number: numeric columns as they are, texts by a hash (equal texts coincide)."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        return F.coalesce(F.col(f"`{name}`").cast("double"), F.lit(0.0))
    return F.coalesce(F.xxhash64(F.col(f"`{name}`").cast("string")).cast("double"), F.lit(0.0))


def _route(cuts: dict[int, tuple[int, int]], node: int = 1, leaf: dict[int, int] | None = None) -> Column:
    """Node that a row falls in (or its `leaf` value), by the cuts {node: (dimension, key)} made so far; one comparison a level."""
    if node not in cuts:
        return F.lit(leaf[node] if leaf else node)
    dim, cut = cuts[node]
    return F.when(F.col(f"k{dim}") > cut, _route(cuts, node * 2 + 1, leaf)).otherwise(_route(cuts, node * 2, leaf))


def _of_node(values: dict[int, int], missing: int) -> Column:
    """The value of the row's node, looked up in an array (the nodes of a level are consecutive numbers)."""
    base = 1 << (min(values).bit_length() - 1)
    return F.get(F.lit([values.get(n, missing) for n in range(base, 2 * base)]), F.col("node") - base)


def _cuts(points: DataFrame, goals: dict[int, tuple[int, float, float]], brackets: dict[int, tuple[int, int]], dims: int) -> dict[int, int]:
    """Weighted quantiles of all nodes of a level: for goals {node: (dimension, bytes to the left, tolerance)}, the keys to cut at.

    A node's bracket (low, high] starts as its range of keys. A round sums the bytes in up to
    2^DIGIT equal bins of each bracket and goes on in the bin that holds the goal, until that
    bin is one key or weighs less than the tolerance. What reaches the driver is bounded by
    2^DIGIT sums a node.
    """
    state = {n: (*brackets[n], 0.0) for n in goals}
    ready: dict[int, int] = {}
    while left := [n for n in goals if n not in ready]:
        shift = {n: max(0, (state[n][1] - state[n][0]).bit_length() - DIGIT) for n in left}
        keys = F.array(*[f"k{d}" for d in range(dims)])
        rows = points.select("node", "size", F.get(keys, _of_node({n: goals[n][0] for n in left}, -1)).alias("key"))
        rows = rows.where((F.col("key") > _of_node({n: state[n][0] for n in left}, 0)) & (F.col("key") <= _of_node({n: state[n][1] for n in left}, -1)))
        rows = rows.select("node", "size", (F.col("key") - _of_node({n: state[n][0] for n in left}, 0) - 1).alias("past"), _of_node(shift, 0).cast("int").alias("shift"))
        place = F.expr("shiftright(past, shift)")
        sums: dict[int, list[tuple[int, float]]] = {n: [] for n in left}
        for r in rows.groupBy("node", place.alias("place")).agg(F.sum("size").alias("bytes")).collect():
            sums[r["node"]].append((r["place"], float(r["bytes"])))
        for n in left:
            low_n, high_n, before = state[n]
            _, goal, tolerance = goals[n]
            found, inside = (low_n, low_n), 0.0
            for at, inside in sorted(sums[n]):
                found = (low_n + (at << shift[n]), min(high_n, low_n + ((at + 1) << shift[n])))
                if before + inside > goal:
                    break
                before += inside
            state[n] = (*found, before)
            if shift[n] == 0 or inside <= tolerance:
                ready[n] = found[1] if goal - before > before + inside - goal else found[0]
    return ready


def kd_leaves(points: DataFrame, dims: int, shards: int) -> DataFrame:
    """`points` (size, k0..k<dims-1>) with a column shard, 0 to shards - 1."""
    level: dict[int, tuple[int, int]] = {1: (0, shards)}  # node: (first shard, number of shards)
    done: dict[int, int] = {}
    cuts: dict[int, tuple[int, int]] = {}
    while level:
        done |= {node: first for node, (first, k) in level.items() if k == 1}
        level = {node: x for node, x in level.items() if x[1] > 1}
        if not level:
            break
        at = points.withColumn("node", _route(cuts)).where(F.col("node").isin(list(level)))
        ends = [f(f"k{d}").alias(f"{s}{d}") for d in range(dims) for f, s in ((F.min, "lo"), (F.max, "hi"))]
        stats = {r["node"]: r for r in at.groupBy("node").agg(F.sum("size").alias("bytes"), *ends).collect()}
        goals, brackets = {}, {}
        for node, (_, k) in level.items():
            if node not in stats:
                cuts[node] = (0, 0)
                continue
            r = stats[node]
            widest = max(range(dims), key=lambda d: ((r[f"hi{d}"] >> LOW_BITS) - (r[f"lo{d}"] >> LOW_BITS), -d))
            share = float(r["bytes"]) / k
            goals[node] = (widest, share * (k // 2), share * TOLERANCE)
            brackets[node] = (r[f"lo{widest}"] - 1, r[f"hi{widest}"])
        for node, cut in _cuts(at, goals, brackets, dims).items():
            cuts[node] = (goals[node][0], cut)
        below = {}
        for node, (first, k) in level.items():
            below[node * 2], below[node * 2 + 1] = (first, k // 2), (first + k // 2, k - k // 2)
        level = below
    return points.withColumn("shard", _route(cuts, leaf=done).cast("int"))


def shard_documents(
    df: DataFrame,
    shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    dimensions: tuple[str, ...] = ("size", "source", "lang", "doc_id"),
    rows_per_task: int = 100_000,
) -> DataFrame:
    """Every row with its size, text_crc32, law, shard, slot and grown_shard.

    Law `bytes`: leaf sizes differ by what one row or one refinement bracket holds. A row's key
    in a dimension is its scaled position, then a hash of its text and id, so equal
    positions (one source may hold a third of all rows) can still be cut, and copies stay
    together unless a median falls between them. Null texts have no bytes; null ids and null
    metadata take position 0; rows that repeat in everything are cut apart by nothing and stay together.
    Slots are gapless from 0 within a shard: rows are numbered inside (shard, hash bucket)
    and buckets are lined up by their counts, so that no shard is numbered by one task.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    slim = df.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text, F.col(f"`{id_col}`")).alias("spread"),
        *[_position(df, d).alias(f"p{i}") if d != "size" else F.log2(F.octet_length(text) + ROW_BYTES).alias(f"p{i}") for i, d in enumerate(dimensions)],
    )
    slim = staged(slim)
    dims = range(len(dimensions))
    bounds = slim.agg(F.count(F.lit(1)).alias("n"), *[f(f"p{i}").alias(f"{s}{i}") for i in dims for f, s in ((F.min, "lo"), (F.max, "hi"))]).first()

    def key(i: int) -> Column:
        width = (bounds[f"hi{i}"] or 0.0) - (bounds[f"lo{i}"] or 0.0)
        at = F.floor((F.col(f"p{i}") - bounds[f"lo{i}"]) / width * SCALE) if width > 0 else F.lit(0)
        # copies are neighbours, and yet can be cut
        low = F.col("text_crc32").bitwiseAND(0xFFFF) * 65536 + F.pmod(F.col("spread"), F.lit(65536))
        return (at.cast("long") * (1 << LOW_BITS) + low).alias(f"k{i}")

    points = staged(slim.select("doc_id", "size", "text_crc32", "spread", *[key(i) for i in dims]))
    leaves = staged(kd_leaves(points, len(dimensions), shards).select("doc_id", "size", "text_crc32", "spread", "shard"))
    per_shard = max(16, -(-bounds["n"] // (shards * rows_per_task)))
    bucket = F.pmod(F.xxhash64("spread"), F.lit(per_shard)).cast("int")
    counts = leaves.groupBy("shard", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    starts = counts.withColumn("start", F.sum("n").over(W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)))
    starts = starts.select(F.col("shard").alias("s_shard"), F.col("bucket").alias("s_bucket"), F.coalesce("start", F.lit(0)).alias("start"))
    inside = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("spread", "doc_id")) - 1
    numbered = leaves.withColumn("bucket", bucket).withColumn("inside", inside)
    # one row for each shard and bucket: shards * per_shard, or one for each rows_per_task rows
    placed = numbered.join(F.broadcast(starts), (F.col("shard") == F.col("s_shard")) & (F.col("bucket") == F.col("s_bucket")))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("start") + F.col("inside")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
