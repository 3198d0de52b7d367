"""State machines carried per code across micro-batches, with the same step as the batch fold.

Rows may arrive in any order within `wait` days of event time. They wait in the code's list state until the
watermark has passed them; a timer then folds them one by one in date order. A row that is not
newer than what has been folded cannot be put in order any more: it goes out marked late, and the
state stays as it is. So the state of a code is its last output and the rows of `wait` days.

The watermark moves with the newest date of any code. Rows without prices are heartbeats: they move
it and nothing else, which closes the last days of a feed that has ended.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tapeline.functions.numeric import thousandths
from tapeline.operators.folds import Step, candle_step, from_thousandths, sar_columns, sar_step
from tapeline.streaming.ticks import run_available

WAIT = "40 days"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EPOCH = dt.date(1970, 1, 1)


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Queries started meanwhile keep typed state with timers, which the default store cannot."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS_DB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def milliseconds(day: dt.date) -> int:
    return (day - EPOCH).days * 86_400_000


class OrderedFold(StatefulProcessor):
    """Folds the rows of one code in date order; see the module's text."""

    def __init__(self, inputs: list[str], needed: list[str], step: Step, outputs: list[str]) -> None:
        self.inputs, self.needed, self.step, self.outputs = inputs, needed, step, outputs

    def init(self, handle: StatefulProcessorHandle) -> None:
        longs = T.LongType()
        self.handle = handle
        self.folded = handle.getValueState("folded", T.StructType([T.StructField("load_date", T.DateType()), *[T.StructField(c, longs) for c in self.outputs]]))
        self.waiting = handle.getListState("waiting", T.StructType([T.StructField("load_date", T.DateType()), *[T.StructField(c, longs) for c in self.inputs]]))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last = self.folded.get()[0] if self.folded.exists() else None
        new = []
        for row in rows:
            if any(row[c] is None for c in self.needed):
                continue
            if last is not None and row["load_date"] <= last:
                yield self._row(key, row["load_date"], (None,) * len(self.outputs), True)
            else:
                new.append((row["load_date"], *(row[c] for c in self.inputs)))
        if new:
            self.waiting.appendList(new)
            # one timer for what came now: when it is due, all rows up to the watermark are folded
            self.handle.registerTimer(milliseconds(min(new)[0]))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        closed = EPOCH + dt.timedelta(milliseconds=timerValues.getCurrentWatermarkInMs())
        waiting = sorted((tuple(row) for row in self.waiting.get()), key=lambda r: (r[0], [(x is not None, x or 0) for x in r[1:]]))
        due = [row for row in waiting if row[0] <= closed]
        if not due:
            return
        rest = waiting[len(due) :]
        state = tuple(self.folded.get())[1:] if self.folded.exists() else None
        for row in due:
            state = self.step(state, row[1:])
            yield self._row(key, row[0], state, False)
        self.folded.update((due[-1][0], *state))
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(milliseconds(rest[0][0]))
        else:
            self.waiting.clear()

    def close(self) -> None:
        pass

    def _row(self, key: tuple, day: dt.date, values: tuple, late: bool) -> Row:
        return Row(**dict(zip(["code", "load_date", *self.outputs, "late"], [key[0], day, *values, late])))


def stateful_fold(df: DataFrame, inputs: list[str], needed: list[str], step: Step, outputs: list[str], wait: str = WAIT) -> DataFrame:
    """One output row per input row that has all of `needed`: code, load_date, outputs, late. Start its query inside `state_store`.

    Rows marked late have no outputs. Rows of a code with the same date are folded in the order of their values.
    """
    # the clock goes before the fold: Spark would drop late rows unseen if it were still there
    stamped = df.withColumn("_clock", F.col("load_date").cast("timestamp")).withWatermark("_clock", wait)
    fields = [T.StructField("code", df.schema["code"].dataType), T.StructField("load_date", T.DateType())]
    fields += [T.StructField(c, T.LongType()) for c in outputs]
    out = T.StructType([*fields, T.StructField("late", T.BooleanType())])
    rows = stamped.select("code", "load_date", *inputs).groupBy("code")
    return rows.transformWithState(OrderedFold(inputs, needed, step, outputs), out, "Append", "EventTime")


def _thousandths(bars: DataFrame, *prices: str) -> DataFrame:
    return bars.select("code", "load_date", *[thousandths(F.col(c)).cast("long").alias(f"_{c}") for c in prices])


def stream_candles(bars: DataFrame, wait: str = WAIT) -> DataFrame:
    """Smoothed candles of a stream of bars; those without a close are heartbeats."""
    prices = ("open", "high", "low", "close")
    fold = stateful_fold(_thousandths(bars, *prices), [f"_{c}" for c in prices], ["_close"], candle_step, ["o", "h", "l", "c"], wait)
    return fold.select("code", "load_date", *[from_thousandths(a).alias(b) for a, b in zip("ohlc", prices, strict=True)], "late")


def stream_sar(bars: DataFrame, step: float = 0.05, cap: float = 0.5, wait: str = WAIT) -> DataFrame:
    """Parabolic stop-and-reverse of a stream of bars; those without a high or low are heartbeats."""
    names = ["_high", "_low"]
    fold = stateful_fold(_thousandths(bars, "high", "low"), names, names, sar_step(round(step * 100), round(cap * 100)), ["e", "up", "a", "s", "n"], wait)
    return sar_columns(fold, extra=("late",))


def run_fold(fold: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str | None = None) -> StreamingQuery:
    """`run_available` with the state store that the fold needs."""
    with state_store(fold.sparkSession):
        return run_available(fold, sink, checkpoint=checkpoint)
