"""Ticks as a stream: bars up to a cut-off, de-duplication, routing, idempotent loads.

Every sink writes a batch under its own id, so a replayed batch replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeline.functions.numeric import dec
from tapeline.operators.rows import trading_time
from tapeline.operators.tables import insert_ignore, read_table
from tapeline.operators.windows import latest_per_key
from tapeline.plans.intraday import tick_bars
from tapeline.staging import scratch


def read_stream(
    spark: SparkSession, path: str, like: DataFrame, files_per_batch: int | None = None, bytes_per_batch: int | None = None
) -> DataFrame:
    """Parquet files as a stream. A single file is reached through a one-letter glob class.

    A backfill of many files is read in batches of at most so many files or bytes (at least one file).
    """
    reader = spark.readStream.schema(like.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    folder, _, name = path.rstrip("/").rpartition("/")
    return reader.parquet(f"{folder}/[{name[0]}]{name[1:]}")


def run_available(
    df: DataFrame, sink: Callable[[DataFrame, int], None], mode: str = "append", checkpoint: str | None = None
) -> StreamingQuery:
    """Process everything that is there now, batch by batch, and wait for the end."""
    spark = df.sparkSession
    query = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint or scratch(spark, "stream"))
        .trigger(availableNow=True)
        .foreachBatch(sink)
        .start()
    )
    query.awaitTermination()
    return query


def batch_sink(path: str, *partition_by: str) -> Callable[[DataFrame, int], None]:
    """Write each batch to its own folder, overwriting a replay."""

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/batch={batch_id}")

    return write


def insert_sink(path: str, keys: list[str], by: str | None = None) -> Callable[[DataFrame, int], None]:
    """Insert-if-absent per batch; a replayed batch finds its keys stored. A batch reads only partitions that may hold its keys."""

    def write(batch: DataFrame, _: int) -> None:
        insert_ignore(batch.sparkSession, path, batch, keys, by=by)

    return write


def stream_bars(ticks: DataFrame, cutoff: str, late: str = "1 day") -> DataFrame:
    """Daily bars per code from weekday ticks up to the cut-off, updated as ticks arrive.

    Event time needs a TIMESTAMP; run the session in UTC so that a day stays the market's day.
    """
    rows = trading_time(ticks, "tick_ts", cutoff).withColumn("tick_ts", F.col("tick_ts").cast("timestamp")).withWatermark("tick_ts", late)
    bars = tick_bars(rows, "code", F.window("tick_ts", "1 day"))
    high, low, open_, close = (F.col(c) for c in ("high", "low", "open", "close"))
    return bars.select(
        "code",
        F.col("window.start").cast("date").alias("load_date"),
        "high",
        "low",
        "open",
        "close",
        dec((high + low + close) / 3, 4, 14).alias("typ3"),
        dec((high + low + open_ + close) / 4, 4, 14).alias("typ4"),
    )


def newest_version(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last update of every key of a stream written in update mode."""
    return latest_per_key(spark.read.parquet(path), keys, [F.desc("batch")]).drop("batch")


def dedupe_ticks(ticks: DataFrame, keys: list[str], ts: str, late: str = "2 days") -> DataFrame:
    """First arrival of every key; the state of a key is dropped once the watermark passes it."""
    stamped = ticks.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return stamped.dropDuplicatesWithinWatermark(keys)


def append_new_ticks(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Batch twin: distinct new ticks whose key is not stored yet."""
    return new.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti")


def drain_queue(queue: DataFrame, route_by: str, path: str) -> StreamingQuery:
    """Route queue rows to a folder per value. The stream's checkpoint replaces deleting what was read."""
    return run_available(queue, batch_sink(path, route_by))


def stored_rows(spark: SparkSession, path: str) -> int:
    """Rows of a sink folder (0 before the first batch)."""
    found = read_table(spark, path)
    return 0 if found is None else found.count()


def progress_log(query: StreamingQuery) -> list[dict]:
    """Rows per micro-batch: the live twin of the load log."""
    return [{"batch_id": p["batchId"], "rows": p["numInputRows"], "started": p["timestamp"]} for p in query.recentProgress]
