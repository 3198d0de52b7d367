from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tapeline.operators import aggregates, joins, windows
from tapeline.plans import evaluation
from tapeline.sources.html import page_tables

DAY = dt.date(2020, 1, 1)


def day(n):
    return DAY + dt.timedelta(n)


def test_rank_all_against_brute_force_with_a_hot_value(spark):
    rng = random.Random(7)
    values = [5] * 400 + [rng.randint(-1000, 1000) for _ in range(500)] + [10**9]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v long").repartition(5)
    for desc in (True, False):
        expected = {i: 1 + sum((x > v) if desc else (x < v) for x in values) for i, v in enumerate(values)}
        got = {r["id"]: r["rank"] for r in windows.rank_all(df, "v", descending=desc, buckets=16).collect()}
        assert got == expected


def test_rank_all_of_one_value(spark):
    df = spark.createDataFrame([(1, 3), (2, 3)], "id int, v long")
    assert {r["rank"] for r in windows.rank_all(df, "v").collect()} == {1}


def test_range_join_against_brute_force_with_a_hot_key(spark):
    rng = random.Random(3)
    left = [("hot" if rng.random() < 0.6 else f"k{rng.randint(0, 5)}", day(rng.randint(0, 400))) for _ in range(60)]
    right = [("hot" if rng.random() < 0.6 else f"k{rng.randint(0, 5)}", day(rng.randint(0, 400)), i) for i in range(600)]
    a = spark.createDataFrame([(k, d, d - dt.timedelta(84)) for k, d in left], "code string, hi date, lo date")
    b = spark.createDataFrame(right, "code string, day date, i int")
    got = joins.range_join(a, b, "code", "day", "lo", "hi", 30)
    expected = sum(k == k2 and d - dt.timedelta(84) <= d2 <= d for k, d in left for k2, d2, _ in right)
    assert got.count() == expected


def test_range_join_measures_its_buckets_and_spreads_long_spans(spark):
    rng = random.Random(11)
    spans = [(rng.choice("ab"), day(s), day(s + rng.choice([0, 1, 3, 3, 5, 90, 2500, -2]))) for s in (rng.randint(0, 900) for _ in range(80))]
    points = [(rng.choice("abc"), day(rng.randint(-50, 3500)), i) for i in range(900)]
    a = spark.createDataFrame([*spans, ("a", None, day(3)), ("a", day(3), None)], "code string, lo date, hi date")
    b = spark.createDataFrame([*points, ("a", None, -1)], "code string, day date, i int")
    got = joins.range_join(a, b, "code", "day", "lo", "hi")
    assert got.columns == ["code", "lo", "hi", "day", "i"]
    want = sorted((k, lo, hi, i) for k, lo, hi in spans for k2, d, i in points if k == k2 and lo <= d <= hi)
    assert sorted((r["code"], r["lo"], r["hi"], r["i"]) for r in got.collect()) == want
    assert joins.range_join(a.limit(0), b, "code", "day", "lo", "hi").count() == 0


def test_lag_by_offset_over_the_whole_history(spark):
    rng = random.Random(5)
    data = []
    for code, n in (("a", 900), ("b", 256), ("c", 1)):
        data += [(code, i, None if i % 9 == 0 else i * 7, rng.choice([0, 1, i, i + 1, rng.randint(0, 900), -1, None])) for i in range(n)]
    df = spark.createDataFrame(data, "code string, i int, x int, back int").repartition(3)
    value = {(c, i): x for c, i, x, _ in data}
    got = {(r["code"], r["i"]): r["then"] for r in windows.lag_by_offset(df, "code", "i", "x", "back", "then").collect()}
    assert got == {(c, i): value.get((c, i - b)) if b is not None and b >= 0 else None for c, i, _, b in data}


def test_rank_all_spreads_missing_and_heavy_values(spark):
    rng = random.Random(9)
    values = [None] * 9000 + [7] * 500 + [rng.randint(0, 10**6) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v long").repartition(6)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = windows.rank_all(df, "v").withColumn("p", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    known = [v for v in values if v is not None]
    order = {v: 1 + sum(x > v for x in known) for v in set(known)} | {None: len(known) + 1}
    assert {r["id"]: r["rank"] for r in out} == {i: order[v] for i, v in enumerate(values)}
    sizes = [sum(r["p"] == p for r in out) for p in {r["p"] for r in out}]
    assert len(sizes) == 4 and max(sizes) < 3500  # of 10,000 rows over four tasks


def test_lag_by_column(spark):
    df = spark.createDataFrame([("a", i, i * 10, o) for i, o in enumerate([0, 1, 5, 2])], "code string, load_date int, x int, o int")
    got = windows.lag_by_column(df, "code", "load_date", "x", "o", 5, "y").orderBy("load_date").collect()
    assert [r["y"] for r in got] == [0, 0, None, 10]


def test_lag_by_column_keeps_nulls_in_place(spark):
    df = spark.createDataFrame([("a", 0, 1, 0), ("a", 1, None, 0), ("a", 2, 3, 1)], "code string, load_date int, x int, o int")
    got = windows.lag_by_column(df, "code", "load_date", "x", "o", 3, "y").orderBy("load_date").collect()
    assert [r["y"] for r in got] == [1, None, None]


def test_gapless_rows_only(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in (1, 2, 3, 5, 6, 7, 8)], "code string, date_index int, x double")
    assert [r["date_index"] for r in joins.with_last_n(df, "code", "date_index", ["x"], 3).orderBy("date_index").collect()] == [3, 7, 8]
    tri = windows.triangular_mean(df, "code", "date_index", "x", 3, "t").where("t IS NOT NULL").orderBy("date_index").collect()
    assert [r["t"] for r in tri] == [pytest.approx((3 * i + 2 * (i - 1) + i - 2) / 6) for i in (3, 7, 8)]


def test_forward_return_does_not_pair_across_gaps(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("a", 4, 4.0)], "code string, i int, p double")
    assert rows(joins.forward_return(df, "code", "i", 2, "p", "p")) == [("a", 2, 2.0, 4.0)]


def test_fill_from_next(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 3, None), ("a", 4, 7), ("a", 5, None)], "code string, d int, x int")
    assert rows(joins.fill_from_next(df, "code", "d", ["x"], F.col("x").isNotNull())) == [("a", 1, 5), ("a", 2, 5), ("a", 3, 7), ("a", 4, 7)]


def test_half_empty_rows_neither_fill_nor_take(spark):
    df = spark.createDataFrame([("a", 1, None, None), ("a", 2, 5, None), ("a", 3, 6, 7), ("a", 4, None, None)], "code string, d int, o int, c int")
    o, c = F.col("o").isNotNull(), F.col("c").isNotNull()
    got = joins.fill_from_next(df, "code", "d", ["o", "c"], o & c, ~o & ~c)
    assert rows(got) == [("a", 1, 6, 7), ("a", 2, 5, None), ("a", 3, 6, 7)]


def test_look_back_equals_the_range_join(spark):
    days = [("a", f"2001-01-{d:02d}", d % 5) for d in range(1, 29, 2)] + [("b", "2001-01-03", 1)]
    df = spark.createDataFrame(days, "code string, day string, x int").withColumn("day", F.col("day").cast("date"))
    spans = df.select("code", F.col("day").alias("hi"), F.date_sub("day", 6).alias("lo"))
    joined = joins.range_join(spans, df, "code", "day", "lo", "hi", 7).groupBy("code", "hi").agg(F.count("*"), F.sum("x"))
    assert rows(joins.look_back(df, "code", "day", 6, n=F.count("*"), s=F.sum("x")).drop("x")) == rows(joined)


def test_pair_next_is_strictly_later(spark):
    # A one-row swing is entry and exit at once; its partner is the exit of the next swing.
    df = spark.createDataFrame([("a", d, e, x) for d, e, x in [(1, True, True), (2, False, False), (3, True, False), (4, False, True), (5, True, False)]], "code string, d int, e boolean, x boolean")
    assert rows(joins.pair_next(df, "code", "d", F.col("e"), F.col("x"))) == [("a", 1, 4), ("a", 3, 4)]


def test_densify(spark):
    days = spark.createDataFrame([(day(i),) for i in range(3)], "d date")
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    assert joins.densify(keys, days, "d").count() == 6


def test_compare_lists(spark):
    t = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "code string, category string, r int")
    y = spark.createDataFrame([("b", "y", 5), ("c", "z", 6)], t.schema)
    assert rows(joins.compare_lists(t, y, "code", ["category"], ["r"])) == [("a", "x", 1, None), ("b", "y", 2, 5), ("c", "z", None, 6)]


def test_refresh_periods(spark):
    days = spark.createDataFrame([(day(i), i + 1) for i in range(10)], "d date, i int")
    refresh = spark.createDataFrame([(day(0),), (day(4),), (day(9),)], "d date")
    assert rows(joins.refresh_periods(refresh, days, "d", "i")) == [(1, day(0), day(3)), (2, day(4), day(8))]


def test_product_table(spark):
    t = joins.product_table(spark, 20)
    got = {(r["src"], r["wgt"]): r["rst"] for r in t.collect()}
    assert len(got) == 41 * 21
    assert all(got[20 + a, b] == a * b and got[20 - a, b] == -a * b for a in range(21) for b in range(21))


def test_scalar_attach_has_no_join(spark, capsys):
    df = spark.range(5)
    joins.attach_scalar(df, df.agg(F.max("id").alias("m"))).explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_with_total(spark):
    df = spark.createDataFrame([("x", day(0), 1), ("y", day(1), 2)], "category string, d date, v long")
    assert rows(aggregates.with_total(df, "category", "ALL", ["v"], "d")) == [("ALL", day(1), 3), ("x", day(0), 1), ("y", day(1), 2)]


def test_list_slope_pads_the_shorter_list(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0, 3.0], [0.0, 1.0])], "k string, y array<double>, x array<double>")
    assert aggregates.list_slope(df, ["k"], "y", "x").first()["slope"] == pytest.approx(1.0)


# The one literal data set: 27 sales, of which 26 and 27 point at no product and no retailer.
PRODUCTS = [(1, 80, 120), (2, 20, 45), (3, 15, 25), (4, 90, 150), (5, 40, 60)]
RETAILERS = [(1,), (2,), (3,), (4,)]
SALES = [
    (1, 1, 1, "2021-01-01"), (2, 2, 2, "2021-01-01"), (3, 3, 3, "2021-01-02"), (4, 2, 4, "2021-01-02"), (5, 4, 5, "2021-02-01"), (6, 2, 2, "2021-02-20"),
    (7, 3, 1, "2021-03-10"), (8, 1, 3, "2021-03-25"), (9, 4, 2, "2021-03-30"), (10, 2, 4, "2021-04-01"), (11, 1, 5, "2021-05-01"), (12, 1, 1, "2021-05-11"),
    (13, 4, 1, "2021-05-21"), (14, 2, 5, "2021-06-09"), (15, 3, 2, "2021-06-12"), (16, 4, 3, "2021-07-21"), (17, 1, 4, "2021-07-22"), (18, 2, 5, "2021-07-31"),
    (19, 1, 2, "2021-08-11"), (20, 3, 3, "2021-08-22"), (21, 1, 2, "2021-08-30"), (22, 4, 3, "2021-09-11"), (23, 1, 2, "2021-09-21"), (24, 3, 4, "2021-09-22"),
    (25, 1, 5, "2021-09-23"), (26, 5, 6, "2021-09-23"), (27, 6, 7, "2021-09-23"),
]


def test_star_schema_golden_case(spark):
    fact = spark.createDataFrame(SALES, "transaction_id int, r int, p int, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    products = spark.createDataFrame(PRODUCTS, "product_id int, org_price int, rtl_price int")
    retailers = spark.createDataFrame(RETAILERS, "retailer_id int")
    dims = [(products, "p", "product_id"), (retailers, "r", "retailer_id")]
    assert sorted(r["transaction_id"] for r in joins.orphans(fact, dims).collect()) == [26, 27]
    monthly = evaluation.revenue_monthly(joins.star_join(fact, dims), "t", F.col("rtl_price") - F.col("org_price"))
    assert rows(monthly)[0] == (2021, 1, 40 + 25 + 10 + 60)
    assert sum(r["margin"] for r in monthly.collect()) == sum(dict((p, b - a) for p, a, b in PRODUCTS)[s[2]] for s in SALES[:25])


def test_page_tables(spark):
    def cells(n, cls="data_data"):
        return "".join(f'<td class="{cls}">{i}</td>' for i in range(n))

    consensus = f'<table class="cr_dataTable"><thead><tr><th></th><th>3 Months Ago</th><th>1 Month Ago</th></tr></thead>{cells(15)}</table>'
    value = f'<table class="x cr_dataTable">{cells(5, "data_lbl")}{cells(5)}</table>'
    other = f'<table class="cr_dataTable">{cells(4)}</table>'
    df = spark.createDataFrame([(1, f"<html>{other}{consensus}{value}</html>"), (2, "<p>none</p>")], "page_id long, html string")
    got = {r["page_id"]: tuple(r)[1:] for r in page_tables(df).collect()}
    assert got[1] == ("2", "5", "8", "11", "14", "0", "1", "2", "3", "4")
    assert got[2] == ("",) * 10
