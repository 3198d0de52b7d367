"""Aggregations with panel semantics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeline.functions import series
from tapeline.functions.numeric import flag
from tapeline.functions.series import by


def share_where(df: DataFrame, keys: list[str], preds: dict[str, Column]) -> DataFrame:
    """Share of rows per key that satisfy each predicate, plus the row count."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("total"), *[(F.sum(flag(p)) / F.count("*")).alias(name) for name, p in preds.items()]
    )


def list_slope(df: DataFrame, keys: list[str], y: str, x: str) -> DataFrame:
    """Slope and intercept per key over two parallel arrays (lock-step, shorter one padded with NULL)."""
    pairs = df.select(*keys, F.explode(F.arrays_zip(F.col(x).alias("x"), F.col(y).alias("y"))).alias("p"))
    return pairs.groupBy(*keys).agg(F.regr_slope("p.y", "p.x").alias("slope"), F.regr_intercept("p.y", "p.x").alias("intercept"))


def positional_median(df: DataFrame, key: str, idx: str, col: str, n: int, k: int, out: str) -> DataFrame:
    """k-th smallest of the last n rows (the lower median for even n)."""
    return df.withColumn(out, series.kth_smallest(F.col(col), by(key, idx), n, k))


def scale_params(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row with the minimum and mean of every column."""
    return df.agg(*[F.min(c).cast("double").alias(f"min_{c}") for c in cols], *[F.avg(F.col(c).cast("double")).alias(f"avg_{c}") for c in cols])


def max_count_per_key(df: DataFrame, key: str) -> DataFrame:
    """Largest number of rows any key has."""
    return df.groupBy(key).agg(F.count("*").alias("n")).agg(F.max("n").alias("max_count"))


def with_total(df: DataFrame, key: str, label: str, sums: list[str], newest: str) -> DataFrame:
    """Group rows plus one total row: sums of the measures, newest date, key = label."""
    total = df.agg(F.max(newest).alias(newest), *[F.sum(c).cast(dict(df.dtypes)[c]).alias(c) for c in sums])
    return df.select(key, newest, *sums).unionByName(total.select(F.lit(label).alias(key), newest, *sums))


def capped_sum(df: DataFrame, keys: list[str], rank: str, caps: list[int], value: Column, prefix: str) -> DataFrame:
    """Sum of a value over the rows ranked up to each cap."""
    return df.groupBy(*keys).agg(*[F.sum(F.when(F.col(rank) > k, 0).otherwise(value)).alias(f"{prefix}{k}") for k in caps])


def rank_groups(df: DataFrame, keys: list[str], part: list[str], value: Column, out: str = "value", rank: str = "rank") -> DataFrame:
    """Aggregate per key, then number the groups within `part` by descending value."""
    sums = df.groupBy(*keys).agg(value.alias(out))
    ties = [c for c in keys if c not in part]
    return sums.withColumn(rank, F.row_number().over(W.partitionBy(*part).orderBy(F.desc(out), *ties)))


def rows_per_day(df: DataFrame, date: str, filled: list[str]) -> DataFrame:
    """Row count per day and how many rows have each text column filled."""
    return df.groupBy(F.col(date).cast("date").alias("day")).agg(
        F.count("*").alias("rows"), *[F.sum(flag(F.col(c) != "")).alias(f"{c}_filled") for c in filled]
    )
