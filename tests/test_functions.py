from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tapeline.functions import numeric, series, text


def one(spark, expr_of, *values, type_="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {type_}")
    return [r[0] for r in df.select(expr_of(F.col("x"))).collect()]


def test_blank_and_sentinels(spark):
    assert one(spark, lambda c: text.blank(c, "Infinity", "-"), "", "Infinity", "-", "5", None) == [None, None, None, "5", None]


@pytest.mark.parametrize(
    ("raw", "keep_zero", "plain"),
    [("12.3m", 12300000, 12300000), ("4bn", 4 * 10**9, 4 * 10**9), ("7k", 7000, 7000), ("1.5tr", 1500 * 10**9, 1500 * 10**9), ("-2k", -2000, -2000), ("15", 15, 15), ("-", None, None), ("0", 0, None), ("8", None, None), ("junk", None, None)],
)
def test_magnitude(spark, raw, keep_zero, plain):
    def value(x):
        return None if x is None else Decimal(x)

    assert one(spark, lambda c: text.magnitude(c, keep_zero=True), raw) == [value(keep_zero)]
    assert one(spark, text.magnitude, raw) == [value(plain)]


def test_between_key_and_comma(spark):
    info = "instrument:EUR_USD,time:2020-01-01 10:00:00,closeoutBid:1.1,closeoutAsk:1.2,"
    assert one(spark, lambda c: text.between(c, "closeoutBid"), info) == ["1.1"]
    assert one(spark, lambda c: text.between(c, "time"), info) == ["2020-01-01 10:00:00"]


def test_json_repair(spark):
    raw = '{"a":NaN,"b":-Infinity,"c": Infinity,"d":1.5}'
    fixed = one(spark, text.quote_bare_numbers, raw)[0]
    got = spark.createDataFrame([(fixed,)], "x string").select(F.from_json("x", "a string, b string, c string, d string").alias("j"))
    assert [tuple(r) for r in got.select(*[text.finite(F.col(f"j.{k}")) for k in "abcd"]).collect()] == [(None, None, None, 1.5)]


def test_first_filled_skips_blanks(spark):
    df = spark.createDataFrame([("", "2.5"), ("1", "9"), ("", ""), ("bad", "1")], "a string, b string")
    assert [r[0] for r in df.select(text.first_filled("decimal(5,2)", F.col("a"), F.col("b"))).collect()] == [Decimal("2.50"), Decimal("1.00"), None, None]


def test_squash_modes(spark):
    got = spark.range(1).select(*[numeric.squash(F.lit(0.0), mode=m) for m in ("unit", "signed", "inverse")]).first()
    assert tuple(got) == (0.5, 0.0, 0.5)


def test_first_and_last_by_break_ties_by_value(spark):
    df = spark.createDataFrame([(5, 30), (5, 20), (9, 10), (9, 40), (7, 99)], "s long, v long")
    got = df.agg(numeric.first_by(F.col("s"), F.col("v")), numeric.last_by(F.col("s"), F.col("v"))).first()
    assert tuple(got) == (20, 40)


def test_hash_aggregate_for_first_by(spark, capsys):
    df = spark.range(10).groupBy((F.col("id") % 2).alias("k")).agg(numeric.first_by(F.col("id"), F.col("id")))
    df.explain()
    assert "SortAggregate" not in capsys.readouterr().out


def test_weights_sum_to_one():
    assert sum(series.EMA15) == 1 and len(series.EMA15) == 15
    assert sum(series.EMA40) == 1 and len(series.EMA40) == 40


def test_weighted_last_needs_full_history(spark):
    df = spark.createDataFrame([("a", i, Decimal(i)) for i in range(1, 5)], "code string, load_date int, x decimal(10,3)")
    got = rows(df.select("load_date", series.weighted_last(F.col("x"), series.by(), [Decimal("0.7"), Decimal("0.3")]).alias("m")))
    assert got[0] == (1, None)
    assert [float(v) for _, v in got[1:]] == [pytest.approx(0.7 * i + 0.3 * (i - 1)) for i in (2, 3, 4)]


def test_slope_matches_regression(spark):
    values = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0]
    df = spark.createDataFrame([(values,)], "v array<double>")
    closed = df.select(series.slope_of(F.col("v"), 6)).first()[0]
    points = spark.createDataFrame(list(enumerate(values)), "x int, y double")
    assert closed == pytest.approx(points.select(F.regr_slope("y", "x")).first()[0])


def test_kth_smallest_is_null_when_short(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, None), ("a", 3, 1), ("a", 4, 7)], "code string, load_date int, x int")
    got = rows(df.select("load_date", series.kth_smallest(F.col("x"), series.by(), 3, 2).alias("m")))
    assert got == [(1, None), (2, None), (3, 5), (4, 7)]


def test_first_and_last_of_large_and_negative_values(spark):
    from tapeline.functions.numeric import first_by, last_by

    rows = [("a", 1, -5), ("a", 2, 5 * 10**12 + 7), ("b", 3, 4 * 10**18), ("b", 3, 9), ("b", 2, -(10**18))]
    df = spark.createDataFrame(rows, "k string, s long, v long")
    got = df.groupBy("k").agg(first_by(F.col("s"), F.col("v")).alias("f"), last_by(F.col("s"), F.col("v")).alias("l")).orderBy("k").collect()
    assert [tuple(r) for r in got] == [("a", -5, 5 * 10**12 + 7), ("b", -(10**18), 4 * 10**18)]


def test_weighted_last_of_large_prices(spark):
    from decimal import Decimal

    from pyspark.sql import Window

    from tapeline.functions.series import weighted_last

    rows = [(1, i, Decimal(10**9 + i)) for i in range(3)]
    df = spark.createDataFrame(rows, "k int, t int, p decimal(18,6)")
    w = Window.partitionBy("k").orderBy("t")
    half = [Decimal("0.5"), Decimal("0.5")]
    got = df.select(weighted_last(F.col("p"), w, half, 6).alias("x")).collect()
    assert [r["x"] for r in got] == [None, Decimal(10**9) + Decimal("0.5"), Decimal(10**9) + Decimal("1.5")]


def test_rank_keeps_rows_without_a_value(spark):
    from tapeline.operators.windows import rank_all

    df = spark.createDataFrame([(1, 5), (2, None), (3, 7), (4, None), (5, 5)], "i int, v int")
    rank = lambda **kw: {r["i"]: r["rank"] for r in rank_all(df, "v", **kw).collect()}
    assert rank() == {3: 1, 1: 2, 5: 2, 2: 4, 4: 4}
    assert rank(nulls_first=True) == {2: 1, 4: 1, 3: 3, 1: 4, 5: 4}


def test_training_set_is_one_scan_and_three_shuffles(spark, sf):
    from tapeline.catalog.features import panel
    from tapeline.plans import features
    from tapeline.staging import stage

    tx = stage(panel(spark, sf))
    raw, values, ratios, diffs = features.all_families(tx)
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("FileScan"), plan.count("Exchange hashpartitioning")) == (1, 3)
    assert plan.count("hashpartitioning(date_index") == 2 and plan.count("hashpartitioning(code") == 1
    together = features.scale_features(raw, values, ratios, diffs)
    for name in features.FAMILIES:
        one = features.family(tx, name)
        both = together.select(*features.KEYS, *[f"{name}_{c}" for c in one.columns[3:]])
        assert rows(both) == rows(one), name


def test_periods_share_one_pass_and_do_not_meet(spark, sf):
    from tapeline.catalog.features import panel
    from tapeline.plans import features
    from tapeline.staging import stage

    tx = stage(panel(spark, sf))
    periods = {"a": ("1995-01-01", "1996-06-01"), "b": ("1996-01-01", "1997-01-01")}  # overlapping
    stacked = stage(features.in_periods(tx, periods))
    both = features.period_chain(stacked, 25)
    apart = {p: features.two_periods(tx, {p: span}, lambda x: x).drop("period") for p, span in periods.items()}
    for name, make in both.items():
        together = features.by_period(make())
        columns = [c for c in together.columns if c != "period"]
        for period in periods:
            one = features.period_chain(apart[period].withColumn("period", F.lit(period)), 25)[name]()
            assert rows(together.where(F.col("period") == period).select(*columns)) == rows(one.select(*columns)), (name, period)
    assert both["ask_bid"]()._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
