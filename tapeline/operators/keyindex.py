"""Key index of a stored table: a bitmap of key hashes for each partition value, written beside the data.

A bit that is not set proves that no stored row of the partition has the key, so its rows are inserted without
reading the table; only partitions for which a bit is set are read, and only for the rows in
question. Bits are written before the data they stand for: after a crash between the two, a bit may stand for
nothing, which costs a look and never a double.

A partition's bitmap has a fixed number of bits. One that holds more keys than that is read on every
insert into it; the result stays exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.operators.partitions import MISSING, folder_names, partition_values, read_partitions, rebalanced, texts_of
from tapeline.staging import stage

#: Bits of a partition: half a megabyte when full, 4 KB for each stretch in use.
SLOTS = 1 << 22
FOLDER = "_keys"
ALL = "all"
BITS = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("bits", T.BinaryType()), T.StructField("part", T.StringType())])


class KeyIndex:
    """The index of the table at `path` on `keys`, by the partition column `by` (None: one bitmap for the table)."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], by: str | None = None, slots: int = SLOTS) -> None:
        self.spark, self.path, self.keys, self.by = spark, path, keys, by
        stored = partition_values(spark, f"{path}/{FOLDER}", "slots")
        self.slots = int(stored[0]) if stored else slots
        self.at = f"{path}/{FOLDER}/slots={self.slots}"
        self.exists = bool(stored)

    def _part(self) -> Column:
        return F.lit(ALL) if self.by is None else F.coalesce(F.col(self.by).cast("string"), F.lit(MISSING))

    def _parts(self, rows: DataFrame) -> list[str]:
        return [ALL] if self.by is None else texts_of(rows, self.by)

    def _slot(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.slots)) + 1

    def add(self, rows: DataFrame) -> None:
        """Set the bits of these rows."""
        bits = rows.select(self._part().alias("part"), self._slot().alias("slot")).groupBy("part", F.bitmap_bucket_number("slot").alias("bucket"))
        made = bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
        rebalanced(made, "part").write.mode("append").option("compression", "zstd").partitionBy("part").parquet(self.at)
        self.exists = True

    def marked(self, rows: DataFrame) -> DataFrame:
        """`rows` with the boolean `_maybe`: may the key be stored? Reads the bitmaps of the partitions in `rows` only."""
        bits = read_partitions(self.spark, self.at, BITS, "part", self._parts(rows))
        bits = bits.groupBy(F.col("part").alias("_part"), F.col("bucket").alias("_bucket")).agg(F.bitmap_or_agg("bits").alias("_bits"))
        keyed = rows.withColumns({"_part": self._part(), "_slot": self._slot()}).withColumn("_bucket", F.bitmap_bucket_number("_slot"))
        place = F.bitmap_bit_position("_slot")
        byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
        hit = F.getbit(byte, (place % 8).cast("int")) == 1
        return keyed.join(bits, ["_part", "_bucket"], "left").select(*rows.columns, F.coalesce(hit, F.lit(False)).alias("_maybe"))

    def absent(self, rows: DataFrame) -> DataFrame:
        """The rows whose key is not stored. Of the table, only the partitions that may hold one of the keys are read."""
        if not self.exists:
            self._catch_up(rows.schema)
        if not self.exists or not set(self._parts(rows)) & set(partition_values(self.spark, self.at, "part")):
            return rows
        marked = stage(self.marked(rows))
        maybe = marked.where("_maybe").drop("_maybe")
        fields = T.StructType([rows.schema[k] for k in dict.fromkeys([*self.keys, *([self.by] if self.by else [])])])
        if self.by is not None:
            stored = read_partitions(self.spark, self.path, fields, self.by, texts_of(maybe, self.by))
        elif maybe.isEmpty():
            return marked.drop("_maybe")
        else:
            stored = self.spark.read.schema(fields).parquet(self.path)
        found = maybe.join(stored.select(*self.keys), self.keys, "left_anti").select(*rows.columns)
        return marked.where(~F.col("_maybe")).drop("_maybe").unionByName(found)

    def _catch_up(self, schema: T.StructType) -> None:
        """Index a table that was stored without one."""
        if any(not name.startswith(("_", ".")) for name in folder_names(self.spark, self.path)):
            fields = T.StructType([schema[k] for k in dict.fromkeys([*self.keys, *([self.by] if self.by else [])])])
            self.add(self.spark.read.schema(fields).parquet(self.path))
