"""Partitions of a stored table found from folder names alone: no scan, no footer, one folder listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folder of rows whose partition value is missing, as the writer names it.
MISSING = "__HIVE_DEFAULT_PARTITION__"


def file_system(spark: SparkSession, path: str):
    """(file system, path) of the JVM."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, at = file_system(spark, path)
    return [entry.getPath().getName() for entry in fs.listStatus(at)] if fs.exists(at) else []


def partition_values(spark: SparkSession, path: str, by: str) -> list[str]:
    """The values of `by` that have a folder, ascending, as text."""
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    start = f"{by}="
    return sorted(unescape(name[len(start) :]) for name in folder_names(spark, path) if name.startswith(start))


def read_partitions(spark: SparkSession, path: str, schema: T.StructType | None, by: str, values: list[str]) -> DataFrame:
    """Rows of these partitions; no other folder is listed or read. Values without a folder are left out.

    Without a schema one file of these partitions tells it, so one of them must be there.
    """
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    there = set(partition_values(spark, path, by))
    folders = [f"{path}/{by}={escape(v)}" for v in values if v in there]
    if not folders:
        if schema is None:
            raise ValueError(f"{path} has none of these partitions: {values}")
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("basePath", path).parquet(*folders)


def texts_of(df: DataFrame, by: str) -> list[str]:
    """The distinct partition values in `df` as folders name them. A batch touches few of them, however many rows it has."""
    return [r[0] for r in df.select(F.coalesce(F.col(by).cast("string"), F.lit(MISSING))).distinct().collect()]


def rebalanced(df: DataFrame, by: str) -> DataFrame:
    """Rows of a partition together before a partitioned write, so that it has few files; a large partition is split."""
    return df.hint("rebalance", by)
