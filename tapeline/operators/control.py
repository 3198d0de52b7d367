"""Batch control: a versioned table of landing batches whose change is one atomic commit.

A version is a folder of rows; it counts once its marker file stands in `_versions`. The marker is written under
another name and renamed, which fails if the version is already taken, so of two writers one starts over.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.operators.partitions import file_system, folder_names

SCHEMA = "batch_id string, announced_at timestamp, is_executed boolean, executed_at timestamp"


class VersionTaken(RuntimeError):
    """Another writer committed first."""


class BatchControl:
    """The control table at `path`: batch_id, announced_at, is_executed, executed_at."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def version(self) -> int:
        """The newest committed version; 0 before the first."""
        return max((int(name) for name in folder_names(self.spark, f"{self.path}/_versions") if name.isdigit()), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest if not given."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], SCHEMA)
        folder = self.spark.read.text(f"{self.path}/_versions/{version:010d}").first()[0]
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/{folder}")

    def commit(self, rows: DataFrame, base: int) -> int:
        """Make `rows` the version after `base`, or raise VersionTaken."""
        folder = f"rows-{uuid.uuid4().hex}"
        rows.select("batch_id", "announced_at", "is_executed", "executed_at").coalesce(1).write.parquet(f"{self.path}/{folder}")
        jvm = self.spark._jvm
        fs, written = file_system(self.spark, f"{self.path}/_versions/.{folder}")
        stream = fs.create(written, False)
        stream.writeBytes(folder)
        stream.close()
        target = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_versions/{base + 1:010d}")
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(fs.makeQualified(written), fs.makeQualified(target), options)
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                raise VersionTaken(f"version {base + 1} of {self.path} is taken") from e
            raise
        return base + 1

    def announce(self, batches: DataFrame, stamp: Column | None = None) -> int:
        """Add the batch ids that are not listed yet, as not executed. Returns the version that lists them."""
        base = self.version()
        known = self.read(base)
        new = batches.select("batch_id").where("batch_id IS NOT NULL").distinct().join(known.select("batch_id"), "batch_id", "left_anti")
        if new.isEmpty():
            return base
        rows = new.select("batch_id", (F.current_timestamp() if stamp is None else stamp).alias("announced_at"), F.lit(False).alias("is_executed"))
        return self.commit(known.unionByName(rows.withColumn("executed_at", F.lit(None).cast("timestamp"))), base)

    def flip(self, base: int, stamp: Column | None = None) -> int:
        """Mark executed what was open in version `base`: batches announced since then stay open, as the commit fails then."""
        was_open = ~F.col("is_executed")
        at = F.when(was_open, F.current_timestamp() if stamp is None else stamp).otherwise(F.col("executed_at"))
        return self.commit(self.read(base).withColumns({"executed_at": at, "is_executed": F.lit(True)}), base)
