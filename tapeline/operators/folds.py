"""State carried along each code's ordered rows.

Rows are hash-partitioned by code and sorted inside the partition (a spillable sort), then
read as a stream of Arrow batches. Only the state of the current code and one batch are in
memory, so the length of a history does not matter. The step functions are plain and are
shared with the streaming twins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeline.functions.numeric import thousandths

Step = Callable[[tuple | None, tuple], tuple]


def ordered_fold(df: DataFrame, key: str, order: str, inputs: list[str], step: Step, outputs: list[str]) -> DataFrame:
    """Run `step(state, row) -> state` over each key's rows in order; one output row per input row.

    `inputs` and `outputs` are whole-number columns; the state tuple is what is returned.
    """
    fields = df.select(key, order).schema
    schema = f"{key} {fields[0].dataType.simpleString()}, {order} {fields[1].dataType.simpleString()}, " + ", ".join(
        f"{c} bigint" for c in outputs
    )
    width = len(inputs)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, started = None, None, False
        for batch in batches:
            keys = batch.column(0).to_pylist()
            rows = zip(*(batch.column(2 + i).to_pylist() for i in range(width)), strict=True)
            out = []
            for k, row in zip(keys, rows, strict=True):
                if not started or k != current:
                    current, state, started = k, None, True
                state = step(state, row)
                out.append(state)
            columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [
                pa.array([], pa.int64()) for _ in outputs
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], [key, order, *outputs])

    rows = df.select(key, order, *inputs).repartition(key).sortWithinPartitions(key, order)
    return rows.mapInArrow(scan, schema)


def half_up(n: int, d: int) -> int:
    """n / d rounded half away from zero (d > 0)."""
    return (2 * n + d) // (2 * d) if n >= 0 else -((-2 * n + d) // (2 * d))


def candle_step(state: tuple | None, row: tuple) -> tuple:
    """Smoothed candle (open, high, low, close) in thousandths.

    close is the mean of the bar; open is the mean of the previous smoothed open and close,
    seeded with the mean of the bar's own open and close. Every value is rounded as stored.
    """
    close = row[3]
    o, h, low = (close if x is None else x for x in row[:3])
    h_close = half_up(o + h + low + close, 4)
    h_open = half_up(o + close, 2) if state is None else half_up(state[0] + state[3], 2)
    return h_open, max(h, h_open, h_close), min(low, h_open, h_close), h_close


def smoothed_candles(bars: DataFrame, key: str = "code", order: str = "load_date") -> DataFrame:
    """Smoothed (Heikin-Ashi) candles for every bar; bars without a close are left out."""
    whole = bars.where("close IS NOT NULL").select(
        key, order, *[thousandths(F.col(c)).alias(f"_{c}") for c in ("open", "high", "low", "close")]
    )
    folded = ordered_fold(whole, key, order, ["_open", "_high", "_low", "_close"], candle_step, ["o", "h", "l", "c"])
    return folded.select(key, order, *[from_thousandths(a).alias(b) for a, b in zip("ohlc", ("open", "high", "low", "close"))])


def from_thousandths(name: str):
    return (F.col(name).cast("decimal(15,0)") / 1000).cast("decimal(12,3)")


def sar_step(step: int, cap: int) -> Step:
    """Stop-and-reverse step: state (extreme, up, af, sar, n_sar), row (high, low).

    Prices in thousandths, acceleration in hundredths. Four branches: an up or down trend is
    kept while the next stop is not crossed, else it reverses at the extreme point. A reversal
    to up starts at min(extreme, high) and its next stop is drawn to the low.
    """

    def next_stop(sar: int, af: int, target: int) -> int:
        return half_up(sar * 100 + af * (target - sar), 100)

    def run(state: tuple | None, row: tuple) -> tuple:
        high, low = row
        if state is None:
            return high, 1, step, low, next_stop(low, step, high)
        extreme, up, af, _, stop = state
        if up and stop <= low:
            af = min(cap, af + step) if extreme < high else af
            return max(extreme, high), 1, af, stop, next_stop(stop, af, high)
        if up:
            sar = max(extreme, high)
            return sar, 0, step, sar, next_stop(sar, step, low)
        if stop >= high:
            af = min(cap, af + step) if extreme > low else af
            return min(extreme, low), 0, af, stop, next_stop(stop, af, low)
        sar = min(extreme, high)
        return min(extreme, low), 1, step, sar, next_stop(sar, step, low)

    return run


def parabolic_sar(bars: DataFrame, step: float = 0.05, cap: float = 0.5, suffix: str = "") -> DataFrame:
    """Parabolic stop-and-reverse state after every bar; column names end in `suffix`."""
    whole = bars.where("high IS NOT NULL AND low IS NOT NULL").select(
        "code", "load_date", thousandths(F.col("high")).alias("_high"), thousandths(F.col("low")).alias("_low")
    )
    fold = ordered_fold(
        whole, "code", "load_date", ["_high", "_low"], sar_step(round(step * 100), round(cap * 100)), ["e", "up", "a", "s", "n"]
    )
    return sar_columns(fold, suffix)


def together(steps: list[Step], width: int) -> Step:
    """One step for several machines over the same rows: the state is theirs side by side, `width` values each."""

    def run(state: tuple | None, row: tuple) -> tuple:
        parts = [None] * len(steps) if state is None else [state[i * width : (i + 1) * width] for i in range(len(steps))]
        return tuple(value for step, part in zip(steps, parts, strict=True) for value in step(part, row))

    return run


def parabolic_sars(bars: DataFrame, settings: dict[str, tuple[float, float]]) -> DataFrame:
    """Parabolic stops of several settings {suffix: (step, cap)} from one shuffle and one sort of the bars."""
    whole = bars.where("high IS NOT NULL AND low IS NOT NULL").select(
        "code", "load_date", thousandths(F.col("high")).alias("_high"), thousandths(F.col("low")).alias("_low")
    )
    steps = [sar_step(round(step * 100), round(cap * 100)) for step, cap in settings.values()]
    names = [f"{c}{suffix}" for suffix in settings for c in ("e", "up", "a", "s", "n")]
    fold = ordered_fold(whole, "code", "load_date", ["_high", "_low"], together(steps, 5), names)
    columns = [c for suffix in settings for c in _sar_columns(suffix, suffix)]
    return fold.select("code", "load_date", *columns)


def sar_columns(fold: DataFrame, suffix: str = "", extra: tuple[str, ...] = ()) -> DataFrame:
    return fold.select("code", "load_date", *_sar_columns("", suffix), *extra)


def _sar_columns(of: str, suffix: str) -> list[Column]:
    return [
        from_thousandths(f"e{of}").alias(f"extreme{suffix}"),
        F.when(F.col(f"up{of}") == 1, "up").otherwise("down").alias(f"ud_trend{suffix}"),
        (F.col(f"a{of}").cast("decimal(5,0)") / 100).cast("decimal(5,3)").alias(f"af{suffix}"),
        from_thousandths(f"s{of}").alias(f"sar{suffix}"),
        from_thousandths(f"n{of}").alias(f"n_sar{suffix}"),
    ]


def streaks(df: DataFrame, key: str, order: str, direction: str, out: str) -> DataFrame:
    """Length of the current run of `direction` (1, -1 or NULL), as gaps and islands.

    A run counts 1, 2, ...; a run that follows nothing (first row, or after a NULL) and points
    down starts at -1 and goes on 0, 1, .... Every window has the same order, so one sort
    serves any number of streaks.
    """
    w = W.partitionBy(key).orderBy(order)
    so_far = w.rowsBetween(W.unboundedPreceding, 0)
    d = F.col(direction)
    before = F.lag(d).over(w)
    rows = df.withColumns({"_n": F.row_number().over(w), "_starts": ~d.eqNullSafe(before) | (F.row_number().over(w) == 1), "_fresh": before.isNull()})
    start = F.max(F.when(F.col("_starts"), F.col("_n"))).over(so_far)
    # What stood before the run is known on its first row.
    fresh = F.last(F.when(F.col("_starts"), F.col("_fresh")), ignorenulls=True).over(so_far)
    runs = rows.withColumns({"_place": F.col("_n") - start + 1, "_after_nothing": fresh})
    value = F.when(d.isNotNull(), F.when(F.col("_after_nothing") & (d == -1), F.col("_place") - 2).otherwise(F.col("_place")))
    return runs.withColumn(out, value).drop("_n", "_starts", "_fresh", "_place", "_after_nothing")
