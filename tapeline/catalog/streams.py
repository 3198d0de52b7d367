"""Streams run to the end of the given tables and are compared like any batch query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.catalog.registry import fragment, query
from tapeline.plans.intraday import CUTOFFS
from tapeline.plans.loading import forex_rows, typed_ticks
from tapeline.sources import panels
from tapeline.sources.files import table
from tapeline.staging import scratch, stage
from tapeline.streaming import state, ticks


def events_stream(spark: SparkSession, sf: str) -> DataFrame:
    return ticks.read_stream(spark, f"{sf}/events.parquet", table(spark, sf, "events"))


@query(
    "stream_intraday_bars",
    f"""
SELECT code, tick_ts::DATE AS load_date, max(p) / 1e4 AS high, min(p) / 1e4 AS low,
  (min(epoch(tick_ts)::BIGINT::HUGEINT * 1000000000000 + p) % 1000000000000)::BIGINT / 1e4 AS open, (max(epoch(tick_ts)::BIGINT::HUGEINT * 1000000000000 + p) % 1000000000000)::BIGINT / 1e4 AS close
FROM k_tick WHERE isodow(tick_ts) < 6 AND tick_ts::TIME <= TIME '{CUTOFFS[0]}' GROUP BY 1, 2""",
)
def stream_intraday_bars(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "bars")
    live = ticks.stream_bars(typed_ticks(panels.web_ticker_of(events_stream(spark, sf))), CUTOFFS[0])
    ticks.run_available(live, ticks.batch_sink(path), "update")
    return ticks.newest_version(spark, path, ["code", "load_date"]).drop("typ3", "typ4")


@query("stream_deduplicated_ticks", "SELECT event_type, date_trunc('minute', ts) AS minute, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2")
def stream_deduplicated_ticks(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "dedupe")
    live = events_stream(spark, sf).withColumn("minute", F.date_trunc("minute", "ts").cast("timestamp_ntz"))
    twice = live.unionByName(live)
    ticks.run_available(ticks.dedupe_ticks(twice, ["event_type", "minute", "user_id"], "minute", "40 days"), ticks.batch_sink(path))
    minute = F.col("minute").cast("timestamp_ntz").alias("minute")
    return spark.read.parquet(path).groupBy("event_type", minute).agg(F.count("*").alias("users"))


fragment("fx", "SELECT ['EUR_USD', 'USD_JPY', 'AUD_USD', 'GBP_USD'][user_id % 4 + 1] AS instrument, round(value * 100)::BIGINT AS bid FROM events")


@query("stream_routed_quotes", "SELECT instrument, count(*) AS n, sum(bid)::DOUBLE AS bid FROM fx GROUP BY 1")
def stream_routed_quotes(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "routes")
    queue = forex_rows(panels.forex_snapshot_of(events_stream(spark, sf)))
    ticks.drain_queue(queue, "instrument", path)
    return spark.read.parquet(path).groupBy("instrument").agg(F.count("*").alias("n"), F.sum("bid").alias("bid"))


@query(
    "stream_insert_if_absent",
    "SELECT user_id, ts::DATE AS day, count(*) AS n FROM (SELECT DISTINCT user_id, ts::DATE AS ts FROM events) GROUP BY 1, 2",
)
def stream_insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "insert")
    live = events_stream(spark, sf).select("user_id", F.col("ts").cast("date").alias("day"), "event_id")
    for _ in range(2):  # a full replay with a fresh checkpoint must change nothing
        ticks.run_available(live, ticks.insert_sink(path, ["user_id", "day"], by="day"))
    return spark.read.parquet(path).groupBy("user_id", "day").agg(F.count("*").alias("n"))


#: Days of the derived bars in each file of the stream, and by how many days the codes' files are apart: rows come out of order.
FILE_DAYS, APART = (700, 3, 40, 1100, 365, 10_000), 25


def bars_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The derived bars as a folder of uneven files, one for each micro-batch, and a heartbeat that closes the last day."""
    bars = stage(panels.quotes(spark, sf).select("code", "load_date", "open", "high", "low", "close"))
    path = scratch(spark, "bar-files")
    first = bars.agg(F.min("load_date")).first()[0]
    day = F.date_diff("load_date", F.lit(first)) + F.pmod(F.xxhash64("code"), F.lit(APART))
    start = 0
    for days in FILE_DAYS:
        part = bars.where((day >= start) & (day < start + days))
        part.orderBy(F.desc("load_date")).coalesce(1).write.mode("append").parquet(path)
        start += days
    beat = bars.agg(F.date_add(F.max("load_date"), 365).alias("load_date"))
    beat.select(*[F.col(c) if c == "load_date" else F.lit(None).cast(bars.schema[c].dataType).alias(c) for c in bars.columns]).coalesce(1).write.mode("append").parquet(path)
    return ticks.read_stream(spark, path, bars, files_per_batch=1)


def folded(spark: SparkSession, fold: DataFrame) -> DataFrame:
    """All rows of a fold that were in time, after its stream has ended."""
    path = scratch(spark, "folds")
    state.run_fold(fold, ticks.batch_sink(path, "late"))
    return spark.read.parquet(path).where(~F.col("late")).drop("batch", "late")


@query("stream_candles", "SELECT code, load_date, open::DOUBLE AS open, high::DOUBLE AS high, low::DOUBLE AS low, close::DOUBLE AS close FROM d_ha")
def stream_candles(spark: SparkSession, sf: str) -> DataFrame:
    return folded(spark, state.stream_candles(bars_stream(spark, sf)))


@query(
    "stream_sar",
    "SELECT code, load_date, extreme::DOUBLE AS extreme, ud_trend, af::DOUBLE AS af, sar::DOUBLE AS sar, n_sar::DOUBLE AS n_sar FROM d_sar",
)
def stream_sar(spark: SparkSession, sf: str) -> DataFrame:
    return folded(spark, state.stream_sar(bars_stream(spark, sf)))
