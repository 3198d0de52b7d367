from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tapeline.operators import folds
from tapeline.plans import daily

DAY = dt.date(2020, 1, 1)


def bars(spark, *prices, code="a"):
    data = [(code, DAY + dt.timedelta(i), *[None if x is None else Decimal(str(x)) for x in p]) for i, p in enumerate(prices)]
    return spark.createDataFrame(data, "code string, load_date date, open decimal(12,3), high decimal(12,3), low decimal(12,3), close decimal(12,3)")


def test_half_up():
    assert [folds.half_up(n, 2) for n in (1, 2, 3, -1, -3)] == [1, 1, 2, -1, -2]
    assert [folds.half_up(n, 4) for n in (1, 2, 3, 6)] == [0, 1, 1, 2]


def test_candles_by_hand(spark):
    got = rows(folds.smoothed_candles(bars(spark, (10, 12, 9, 11), (11, 13, 10, 12), (12, 12, 8, 9))).drop("code", "load_date"))
    d = Decimal
    # open: (10+11)/2; then the mean of the previous smoothed open and close.
    assert sorted(got) == sorted([(d("10.500"), d("12.000"), d("9.000"), d("10.500")), (d("10.500"), d("13.000"), d("10.000"), d("11.500")), (d("11.000"), d("12.000"), d("8.000"), d("10.250"))])


def test_candles_round_at_every_step(spark):
    got = folds.smoothed_candles(bars(spark, ("1.001", "1.002", "1.000", "1.002"), ("1.001", "1.002", "1.000", "1.001"))).orderBy("load_date").collect()
    assert got[0]["open"] == Decimal("1.002")  # 1.0015 rounds away from zero
    assert got[0]["close"] == Decimal("1.001")  # 1.00125
    assert got[1]["open"] == Decimal("1.002")  # (1.002 + 1.001) / 2 = 1.0015


def test_missing_prices_read_as_close(spark):
    got = folds.smoothed_candles(bars(spark, (None, None, None, 4))).first()
    assert (got["open"], got["high"], got["low"], got["close"]) == tuple([Decimal("4.000")] * 4)


def test_candle_bounds(spark, sf):
    from tapeline.sources.panels import quotes

    c = folds.smoothed_candles(quotes(spark, sf))
    assert c.where("high < open OR high < close OR low > open OR low > close").count() == 0


def test_sar_by_hand():
    step = folds.sar_step(5, 50)
    s = step(None, (10000, 9000))
    assert s == (10000, 1, 5, 9000, 9050)  # starts up, stop drawn from the low to the high
    s = step(s, (11000, 9500))
    assert s == (11000, 1, 10, 9050, 9245)  # kept, new extreme, acceleration up
    s = step(s, (10000, 9200))
    assert s == (11000, 0, 5, 11000, 10910)  # stop above the low: down from the extreme
    s = step(s, (10500, 9100))
    assert s == (9100, 0, 10, 10910, 10729)  # kept down, new low
    s = step(s, (12000, 9000))
    assert s == (9000, 1, 5, 9100, 9095)  # crossed: up from min(extreme, high), next stop drawn to the low


def test_settings_share_one_shuffle_and_equal_single_folds(spark, sf):
    from tapeline.sources.panels import quotes_table

    bars = quotes_table(spark, sf)
    both = folds.parabolic_sars(bars, {"2": (0.02, 0.2), "3": (0.03, 0.3), "": (0.05, 0.5)})
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("MapInArrow") == 1
    for suffix, setting in (("2", (0.02, 0.2)), ("3", (0.03, 0.3)), ("", (0.05, 0.5))):
        one = folds.parabolic_sar(bars, *setting, suffix)
        assert rows(both.select(*one.columns)) == rows(one)


def test_sar_flips_only_on_breach(spark, sf):
    from pyspark.sql import Window as W

    from tapeline.sources.panels import quotes

    q = quotes(spark, sf).select("code", "load_date", "high", "low")
    w = W.partitionBy("code").orderBy("load_date")
    s = folds.parabolic_sar(q).join(q, ["code", "load_date"]).withColumns({"p": F.lag("ud_trend").over(w), "stop": F.lag("n_sar").over(w)})
    assert s.where("p = 'up' AND ud_trend = 'down' AND stop <= low").count() == 0
    assert s.where("p = 'down' AND ud_trend = 'up' AND stop >= high").count() == 0
    assert s.where("p = 'up' AND ud_trend = 'up' AND stop > low").count() == 0


def test_fold_keeps_state_across_batches_and_keys(spark):
    n = 500
    data = [(k, DAY + dt.timedelta(i), 1) for k in ("a", "b") for i in range(n)]
    df = spark.createDataFrame(data, "code string, load_date date, x long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        out = folds.ordered_fold(df, "code", "load_date", ["x"], lambda s, r: ((s[0] if s else 0) + r[0],), ["total"])
        assert rows(out.groupBy("code").agg(F.max("total"), F.count("*"))) == [("a", n, n), ("b", n, n)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")


def test_fold_of_no_rows(spark):
    df = bars(spark, (1, 1, 1, 1)).where("code = 'none'")
    assert folds.smoothed_candles(df).count() == 0


@pytest.mark.parametrize(
    ("signs", "expected"),
    [
        ([1, 1, -1, -1, 1], [1, 2, 1, 2, 1]),
        ([-1, -1, -1, 1, -1], [-1, 0, 1, 1, 1]),  # a first run downwards starts at -1
        ([1, None, -1, -1], [1, None, -1, 0]),  # so does a run after a gap
        ([1, None, 1, 1], [1, None, 1, 2]),
    ],
)
def test_streaks(spark, signs, expected):
    df = spark.createDataFrame([("a", i, s) for i, s in enumerate(signs)], "code string, load_date int, d int")
    got = folds.streaks(df, "code", "load_date", "d", "run").orderBy("load_date").collect()
    assert [r["run"] for r in got] == expected


def test_trend_columns_of_short_history_are_empty(spark):
    assert daily.moving_averages(bars(spark, *[(1, 1, 1, 1)] * 39)).count() == 0
    assert daily.moving_averages(bars(spark, *[(1, 1, 1, 1)] * 41)).count() == 2
