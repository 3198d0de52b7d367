"""Helpers shared by the corpus operators: written intermediates, row keys, skew-proof group joins, bitmaps."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.staging import scratch

#: A group with more than 1/HOT of all rows is joined by broadcast; by counting there are fewer than HOT of them.
HOT = 1000

#: Texts that one Arrow batch carries to Python while an intermediate is written.
TEXTS_PER_BATCH = 1000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_recorders: list[list[str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder and read it back; survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, "llm")
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, min(int(before), TEXTS_PER_BATCH) or TEXTS_PER_BATCH)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(ARROW_ROWS, before)
    for paths in _recorders:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def recorded(paths: list[str]) -> Iterator[None]:
    """Note in `paths` what `staged` writes meanwhile."""
    _recorders.append(paths)
    try:
        yield
    finally:
        _recorders.remove(paths)


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Delete written intermediates. Only for a caller who knows that nothing unread depends on them."""
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, with `value` computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def packed(df: DataFrame, *own: str) -> DataFrame:
    """All columns of `df` as one struct `row`, so that no extra column can clash; `own` columns are copied beside it."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[F.col(f"`{c}`").alias(c) for c in own])


def unpacked(df: DataFrame, columns: list[str], *added: str) -> DataFrame:
    """The columns held in `row`, then `added`; an input column that is named like an added one gives way to it."""
    kept = [F.col("row")[c].alias(c) for c in columns if c not in added]
    return df.select(*kept, *added)


def with_row_key(df: DataFrame, id_col: str = "doc_id", tie: str = "text", key: str = "row_key") -> DataFrame:
    """A unique long `key` in the order of `id_col`.

    Unique, non-null integer ids are the key themselves. Otherwise (null, repeated or
    non-integer ids) rows are numbered in the order of id (nulls first), then `tie`; rows equal in
    both are numbered in any order, which is safe where only their order relative to
    others counts.
    """
    kind = df.schema[id_col].dataType
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        odd = df.groupBy(F.col(id_col).alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null")
        if odd.isEmpty():
            return df.withColumn(key, F.col(id_col).cast("long"))
    once = staged(df)
    order = [F.col(id_col).asc_nulls_first(), F.col(tie).asc_nulls_first()]
    return staged(once.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(key, F.monotonically_increasing_id()))


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, spread: str) -> DataFrame:
    """Left-join each row to its group's one row in `groups`, whatever the skew.

    Groups with more than total / HOT rows are broadcast (fewer than HOT rows by counting).
    Their member rows then carry a key of their own through the shuffle (`spread`, any
    well-spread column), so that no key of the shuffled join has more than total / HOT rows.
    """
    names = [c for c in groups.columns if c != key]
    fields = F.struct(*[F.col(c) for c in names])
    hot = groups.where(F.col(size) * HOT > total).select(F.col(key).alias("hot_key"), fields.alias("hot"))
    cold = groups.where(F.col(size) * HOT <= total).select(
        # no literal: the optimizer would take it out of the join's keys, and hot rows would meet again
        F.col(key).alias("cold_key"), (F.col(size) * 0).cast("long").alias("cold_salt"), fields.alias("cold")
    )
    keyed = rows.join(F.broadcast(hot), F.col(key) == F.col("hot_key"), "left").withColumn(
        "salt", F.when(F.col("hot").isNotNull(), F.xxhash64(F.col(spread)).bitwiseOR(F.lit(1))).otherwise(F.lit(0))
    )
    joined = keyed.join(cold, (F.col(key) == F.col("cold_key")) & (F.col("salt") == F.col("cold_salt")), "left")
    found = joined.withColumn("group", F.coalesce("hot", "cold"))
    return found.select(*rows.columns, *[F.col("group")[c].alias(c) for c in names])


def slot_bits(slots: DataFrame, slot: str) -> DataFrame:
    """Bitmap table (bucket, bits) of the slot numbers: 4 KB of bits a row, at most slots / 32768 rows."""
    at = F.col(slot) + 1
    return slots.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))


def with_bit(df: DataFrame, bits: DataFrame, slot: Column, name: str) -> DataFrame:
    """Boolean column `name`: is the bit of `slot` set? The bitmap is broadcast; its size is fixed by the number of slots."""
    at = slot + 1
    side = F.broadcast(bits.select(F.col("bucket").alias("b_bucket"), F.col("bits").alias("b_bits")))
    place = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring(F.col("b_bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    hit = F.getbit(byte, (place % 8).cast("int")) == 1
    joined = df.join(side, F.bitmap_bucket_number(at) == F.col("b_bucket"), "left")
    return joined.withColumn(name, F.coalesce(hit, F.lit(False))).drop("b_bucket", "b_bits")


def slots_for(n: int, per_row: int, most: int) -> int:
    """A power of two of at least n * per_row slots, between 2^16 and `most`."""
    return min(most, max(1 << 16, 1 << max(1, n * per_row - 1).bit_length()))


def text_slices(batches, text: str = "text", rows: int = 256):
    """From Arrow batches: slices of up to `rows` rows, each with its texts as UTF-8 bytes (null: empty)."""
    import pyarrow as pa

    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, [x or b"" for x in part.column(text).cast(pa.binary()).to_pylist()]


def numbered(df: DataFrame, key: str, *order: str) -> DataFrame:
    """`df` with `pos`, from 0 in the order of `order` (nulls first) among the rows of `key`, and `n`, how many those are.

    A null `key` is a key like any other. Rows are dealt out by ranges of key and order and each
    task numbers its own, so a key with a third of all rows is numbered by many tasks; what
    lines the tasks up has one row for each key and task. `order` must tell the rows of a key apart.
    """
    by = [F.col(c).asc_nulls_first() for c in (key, *order)]
    lined = staged(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()))
    task = F.shiftright("at", 33)
    runs = lined.groupBy(F.col(key).alias("run_key"), task.alias("run_task")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("many"))
    whole = W.partitionBy("run_key")
    earlier = F.sum("many").over(whole.orderBy("run_task").rowsBetween(W.unboundedPreceding, -1))
    runs = runs.select("run_key", "run_task", "first", F.coalesce(earlier, F.lit(0)).alias("earlier"), F.sum("many").over(whole).alias("n"))
    joined = lined.join(runs, F.col(key).eqNullSafe(F.col("run_key")) & (task == F.col("run_task")))
    return joined.select(*df.columns, (F.col("at") - F.col("first") + F.col("earlier")).alias("pos"), "n")


def whole_groups(batches, *keys: str):
    """Arrow tables that hold whole groups of `keys`, from batches sorted by them: at most one group more than a batch."""
    import pyarrow as pa

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k) for k in keys]
        ends = [c[-1].as_py() for c in columns]
        start = batch.num_rows - 1
        while start and all(c[start - 1].as_py() == end for c, end in zip(columns, ends)):
            start -= 1
        if start or ends != last:
            if done := [*held, *([batch.slice(0, start)] if start else [])]:
                yield pa.Table.from_batches(done).combine_chunks()
            held = []
        held.append(batch.slice(start))
        last = ends
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def give_back() -> None:
    """Return to the system the memory that a Python worker no longer uses; its process outlives the task."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)
