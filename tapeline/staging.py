"""Written intermediates: cut a long lineage once, in a folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediates and streaming checkpoints.

    `spark.checkpoint.dir` names it on a cluster. Only a local master may fall back to a
    temporary folder, because there every task runs on this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tapeline-")
    return _local_dirs[app]


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below `shared_dir`, in this application's own folder."""
    return f"{shared_dir(spark)}/tapeline/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write `df` once as Parquet and read it back.

    Used where a frame feeds several branches of one plan (a temp table in SQL). The copy
    survives lost executors, and its file sizes give the planner true numbers to choose
    joins from.
    """
    spark = df.sparkSession
    path = scratch(spark, "stage")
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
