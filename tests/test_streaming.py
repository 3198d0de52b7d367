from __future__ import annotations

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from tapeline.catalog import queries
from tapeline.operators.folds import parabolic_sar, smoothed_candles
from tapeline.plans.intraday import CUTOFFS, intraday_bars
from tapeline.plans.loading import typed_ticks
from tapeline.sources import panels
from tapeline.sources.files import table
from tapeline.streaming import state, ticks


def test_stream_bars_equal_batch_bars(spark, sf):
    batch = intraday_bars(typed_ticks(panels.web_ticker(spark, sf)), CUTOFFS[0]).select("code", "load_date", "open", "high", "low", "close")
    newest = batch.select("load_date").first()[0]
    live = queries()["stream_intraday_bars"](spark, sf).where(F.col("load_date") == F.lit(newest))
    as_double = [F.col(c).cast("double") if c not in ("code", "load_date") else F.col(c) for c in batch.columns]
    assert rows(live.select(*batch.columns)) == rows(batch.select(*as_double))


def test_stream_state_equals_batch_fold(spark, sf):
    bars = panels.quotes(spark, sf)
    live = queries()["stream_candles"](spark, sf)
    cols = ["code", "load_date", *[F.col(c).cast("double") for c in ("open", "high", "low", "close")]]
    assert rows(live.select(*cols)) == rows(smoothed_candles(bars).select(*cols))
    stops = queries()["stream_sar"](spark, sf).select("code", "load_date", "ud_trend", "n_sar")
    assert rows(stops) == rows(parabolic_sar(bars).select("code", "load_date", "ud_trend", F.col("n_sar").cast("double")))


class Feed:
    """Files that a stream of bars reads one at a time, its checkpoint and its sink."""

    def __init__(self, spark, tmp_path):
        self.spark, self.path, self.sink, self.checkpoint = spark, *(str(tmp_path / x) for x in ("in", "out", "check"))

    def bars(self, *given):
        day = dt.date(2020, 1, 1)
        return self.spark.createDataFrame([(code, day + dt.timedelta(n), *([None if p is None else p] * 4)) for code, n, p in given], "code string, load_date date, open double, high double, low double, close double").select(
            "code", "load_date", *[F.col(c).cast("decimal(12,3)").alias(c) for c in ("open", "high", "low", "close")]
        )

    def add(self, *given):
        self.bars(*given).coalesce(1).write.mode("append").parquet(self.path)

    def run(self, wait="5 days"):
        live = ticks.read_stream(self.spark, self.path, self.bars(("a", 0, 1.0)), files_per_batch=1)
        return state.run_fold(state.stream_candles(live, wait), ticks.batch_sink(self.sink, "late"), self.checkpoint)

    def got(self, late):
        return self.spark.read.parquet(self.sink).where(F.col("late") == late).drop("batch", "late")


def test_rows_out_of_order_wait_and_late_ones_go_out_marked(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add(("a", 3, 4.0), ("a", 0, 1.0), ("b", 1, 9.0))
    feed.add(("a", 2, 3.0), ("a", 1, 2.0), ("c", 30, None))  # in time: the watermark stood at day -2
    feed.add(("c", 31, None))  # read with the watermark at day 25, so that the rows before it are folded
    feed.add(("a", 2, 99.0), ("b", 0, 99.0), ("d", 4, 7.0), ("a", 32, 5.0))  # too late for a and b, but not for d
    feed.add(("z", 99, None))
    feed.run()
    whole = feed.bars(("a", 0, 1.0), ("a", 1, 2.0), ("a", 2, 3.0), ("a", 3, 4.0), ("a", 32, 5.0), ("b", 1, 9.0), ("d", 4, 7.0))
    assert rows(feed.got(False)) == rows(smoothed_candles(whole))
    day = dt.date(2020, 1, 1)
    assert rows(feed.got(True)) == [("a", day + dt.timedelta(2), None, None, None, None), ("b", day, None, None, None, None)]


def test_state_goes_on_after_a_restart(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    given = [("a", n, float(10 + n * n % 7)) for n in range(40)]
    feed.add(*given[:20])
    feed.run()
    first = feed.got(False).count()
    assert 0 < first < 20  # the newest days still wait
    feed.add(*given[20:])
    feed.add(("z", 99, None))
    feed.run()
    assert rows(feed.got(False)) == rows(smoothed_candles(feed.bars(*given)))
    assert feed.got(True).count() == 0


def test_backfill_is_read_in_bounded_batches(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    for n in range(6):
        feed.add(*[("a", 10 * n + i, 1.0) for i in range(10)])
    live = ticks.read_stream(spark, feed.path, feed.bars(("a", 0, 1.0)), bytes_per_batch=1)
    query = state.run_fold(state.stream_candles(live), ticks.batch_sink(feed.sink, "late"))
    assert [p["rows"] for p in ticks.progress_log(query) if p["rows"]] == [10] * 6


def test_batch_and_stream_dedupe_agree(spark, sf):
    keys = ["event_type", "minute", "user_id"]
    e = table(spark, sf, "events").withColumn("minute", F.date_trunc("minute", "ts").cast("timestamp_ntz"))
    old, new = e.where("event_id % 2 = 0"), e
    added = ticks.append_new_ticks(old, new, keys)
    assert added.count() + old.dropDuplicates(keys).count() == e.dropDuplicates(keys).count()
    live = queries()["stream_deduplicated_ticks"](spark, sf)
    assert live.agg(F.sum("users")).first()[0] == e.dropDuplicates(keys).count()


def test_checkpoint_replays_nothing(spark, sf, tmp_path):
    e = table(spark, sf, "events")
    sink, checkpoint = str(tmp_path / "sink"), str(tmp_path / "check")
    for _ in range(2):
        stream = ticks.read_stream(spark, f"{sf}/events.parquet", e).select("event_id")
        query = ticks.run_available(stream, ticks.batch_sink(sink), checkpoint=checkpoint)
    assert ticks.stored_rows(spark, sink) == e.count()
    assert sum(p["rows"] for p in ticks.progress_log(query)) == 0
