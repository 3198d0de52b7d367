"""Stored tables: insert-if-absent, snapshots, retention, batch control.

A table is a Parquet folder. Every write is one committed Spark job; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tapeline.operators.keyindex import KeyIndex
from tapeline.operators.partitions import rebalanced
from tapeline.operators.windows import latest_per_key, newest_dates
from tapeline.staging import stage


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, or None before the first write."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def _complete(keys: list[str]) -> Column:
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    return complete


def absent_rows(target: DataFrame | None, new: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Rows of `new` that a unique index on `keys` would accept.

    One row per key (the first by `order`, by all columns if not given), and none whose key
    is stored already. A key with a NULL never conflicts, so those rows all pass: each has a number of its own,
    so one pass over `new` serves both kinds and no task gets all of them.
    """
    complete = _complete(keys)
    rest = [F.col(c) for c in new.columns if c not in keys]
    own = F.when(complete, F.lit(0)).otherwise(F.monotonically_increasing_id() + 1)
    accepted = latest_per_key(new.withColumn("_own", own), [*keys, "_own"], order or rest or [F.lit(0)]).drop("_own")
    if target is None:
        return accepted
    unique = accepted.where(complete).join(target.select(*keys), keys, "left_anti").select(*new.columns)
    return unique.unionByName(accepted.where(~complete))


def insert_ignore(
    spark: SparkSession, path: str, new: DataFrame, keys: list[str], order: list[Column] | None = None, by: str | None = None
) -> None:
    """Append the rows whose key is not stored yet. Running it twice changes nothing.

    `by` names a key column (a date) the table is partitioned by. The table's key index tells which partitions may hold
    one of the new keys; only those are read, so a new day reads nothing. Without `by` there is one
    bitmap for all keys, and the stored keys are read only if one of the new ones may be among them.
    """
    index = KeyIndex(spark, path, keys, by)
    complete = _complete(keys)
    once = stage(absent_rows(None, new, keys, order))  # `new` may be a long plan: it is computed here only
    unique = once.where(complete)
    absent = index.absent(unique)
    rows = absent if absent is unique else stage(absent)
    index.add(rows)
    accepted = rows.unionByName(once.where(~complete))
    if by:
        rebalanced(accepted, by).write.mode("append").partitionBy(by).parquet(path)
    else:
        accepted.write.mode("append").parquet(path)


def overwrite_snapshot(df: DataFrame, path: str) -> None:
    """Replace a table. The rows are staged first, so `df` may read the table it replaces."""
    stage(df).write.mode("overwrite").parquet(path)


def delete_where(df: DataFrame, pred: Column) -> DataFrame:
    """Rows that remain after DELETE WHERE pred (NULL does not delete)."""
    return df.where(~F.coalesce(pred, F.lit(False)))


def backup_snapshot(df: DataFrame, path: str, stamp: Column | None = None) -> None:
    """Append the frame with the time of the snapshot."""
    df.withColumn("snapshot_ts", F.current_timestamp() if stamp is None else stamp).write.mode("append").parquet(path)


def keep_last_n_dates(df: DataFrame, date: str, n: int = 30) -> DataFrame:
    """Rows of the n newest dates; older ones are pruned."""
    return newest_dates(df, date, n)


def open_batches(landing: DataFrame, control: DataFrame) -> DataFrame:
    """Landing rows of the batches that were not executed yet."""
    return landing.join(control.where(~F.col("is_executed")).select("batch_id"), "batch_id", "left_semi")


def mark_executed(control: DataFrame) -> DataFrame:
    return control.withColumn("is_executed", F.lit(True))


def union_keys(key: str, *dfs: DataFrame) -> DataFrame:
    """Distinct keys of several frames; each is reduced before the union."""
    out = dfs[0].select(key).distinct()
    for df in dfs[1:]:
        out = out.union(df.select(key).distinct())
    return out.distinct()


def overlay(history: DataFrame, today: DataFrame, date: str, d: Column) -> DataFrame:
    """History before d plus the provisional rows of d."""
    return history.where(F.col(date) < d).unionByName(today.where(F.col(date) == d))
