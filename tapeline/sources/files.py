"""File scans and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_csv_panel(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Comma CSV with a header into a declared schema; '' is NULL, rows are never inferred."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def landing_schema(columns: list[str], stamp: str = "sys_load_time") -> T.StructType:
    """Every column text, plus the load timestamp."""
    fields = [T.StructField(c, T.StringType()) for c in columns]
    return T.StructType([*fields, T.StructField(stamp, T.TimestampNTZType())])


def read_landing(spark: SparkSession, path: str, columns: list[str], fmt: str = "parquet") -> DataFrame:
    """Untyped landing rows; names may hold spaces. The file name comes along as `source_file`."""
    reader = spark.read.schema(landing_schema(columns))
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path).withColumn("source_file", F.col("_metadata.file_name"))


def file_record_date(source_file: Column) -> Column:
    """Date from the first eight characters of a file name (yyyyMMdd...)."""
    return F.try_to_date(F.substring(source_file, 1, 8), "yyyyMMdd")


def file_info_type(source_file: Column) -> Column:
    """The three characters before the first dot of a file name."""
    return F.substring(source_file, F.locate(".", source_file) - 3, F.lit(3))


def split_by(df: DataFrame, column: str, path: str) -> None:
    """Route rows to one folder per value in a single pass."""
    df.write.mode("append").partitionBy(column).parquet(path)


def fan_out(df: DataFrame, paths: list[str]) -> None:
    """Overwrite several targets with the same rows. Pass a staged frame: each write reads it."""
    for path in paths:
        df.write.mode("overwrite").parquet(path)
