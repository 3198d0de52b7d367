"""Stored snapshots of one date each: which dates there are is read from folder names, and only the dates asked for are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeline.operators.partitions import file_system, folder_names, partition_values, read_partitions
from tapeline.operators.tables import insert_ignore


class SnapshotStore:
    """Tables below `root`, partitioned by a date column."""

    def __init__(self, spark: SparkSession, root: str, by: str = "load_date") -> None:
        self.spark, self.root, self.by = spark, root.rstrip("/"), by

    def insert(self, name: str, rows: DataFrame, keys: list[str], by: str | None = None, date: str | None = None) -> None:
        """Append rows whose key is not stored; a snapshot that is inserted again adds nothing.

        The snapshot of `date` is there afterwards even if no row is of that date: a folder that holds the columns only.
        """
        by = by or self.by
        insert_ignore(self.spark, f"{self.root}/{name}", rows, keys, by=by)
        if date is not None and date not in self.dates(name, by):
            rows.drop(by).limit(0).write.mode("append").parquet(f"{self.root}/{name}/{by}={date}")

    def dates(self, name: str, by: str | None = None) -> list[str]:
        """Dates of the stored snapshots, the newest first."""
        return partition_values(self.spark, f"{self.root}/{name}", by or self.by)[::-1]

    def read(self, name: str, dates: list[str], by: str | None = None) -> DataFrame:
        return read_partitions(self.spark, f"{self.root}/{name}", None, by or self.by, dates)

    def newest(self, name: str, place: int = 0, by: str | None = None, until: str | None = None) -> DataFrame | None:
        """The newest snapshot (place 0), the one before (1), ... of those not after `until`; None if there are not so many."""
        dates = [d for d in self.dates(name, by) if until is None or d <= until]
        return self.read(name, [dates[place]], by) if place < len(dates) else None


class RunLedger:
    """Which steps of a run are stored: an empty file for each, created when the step's table is written."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.path = spark, f"{root.rstrip('/')}/_ledger"

    def done(self, run: str) -> set[str]:
        return {name for name in folder_names(self.spark, f"{self.path}/{run}") if not name.startswith((".", "_"))}

    def mark(self, run: str, step: str) -> None:
        fs, at = file_system(self.spark, f"{self.path}/{run}/{step}")
        fs.create(at, True).close()

    def runs(self) -> list[str]:
        return sorted(folder_names(self.spark, self.path))
