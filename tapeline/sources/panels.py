"""Market panels derived from the given tables.

A code is a part brand. One aggregation over `lineitem` gives every daily figure, so each
panel below is a projection of `daily_totals` and unused figures are pruned from the scan.
A hot brand costs nothing extra: rows collapse to one per brand and day before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.functions.numeric import dec, first_by, hundredths, last_by, money, ratio
from tapeline.functions.series import by
from tapeline.sources.files import table
from tapeline.staging import stage

# Ticks are moved back so that the newest one falls on 2001-07-02, and their
# text is UTC while the market clock is UTC+11.
TICK_SHIFT_DAYS = 8247
MARKET_UTC_HOURS = 11
EXCHANGE_SUFFIX = ".AX"


def daily_totals(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """Whole-number figures per (code, load_date): prices in cents, volume in units."""
    line = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    day = F.col("l_shipdate").cast("date")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    seq = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    qty = F.col("l_quantity").cast("long")
    rating = F.round(F.col("l_discount") * 100).cast("int") % 5
    rows = line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("code"),
        (F.trunc(day, "week") if grain == "week" else day).alias("load_date"),
        cents.alias("cents"),
        seq.alias("seq"),
        qty.alias("qty"),
        rating.alias("rating"),
        F.round(F.col("p_retailprice") * 100).cast("long").alias("list_cents"),
        "l_returnflag",
    )
    ratings = [
        F.sum(F.when(F.col("rating") == i, F.col("qty")).otherwise(0)).alias(f"r{i}") for i in range(5)
    ]
    return rows.groupBy("code", "load_date").agg(
        first_by(F.col("seq"), F.col("cents")).alias("o"),
        F.max("cents").alias("h"),
        F.min("cents").alias("l"),
        last_by(F.col("seq"), F.col("cents")).alias("c"),
        F.sum("qty").alias("v"),
        F.sum("cents").alias("t"),
        F.max("list_cents").alias("p"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("qty")).otherwise(0)).alias("s"),
        *ratings,
    )


def quotes(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """Typed bars, unique by (code, load_date)."""
    return quotes_of(daily_totals(spark, sf_dir, grain))


def totals_table(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """`daily_totals` written once. For plans that read it more than once: the large scan runs one time."""
    return stage(daily_totals(spark, sf_dir, grain))


def quotes_table(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """`quotes` written once, for plans with several branches."""
    return stage(quotes(spark, sf_dir, grain))


def quotes_of(totals: DataFrame) -> DataFrame:
    w = by()
    bars = totals.select(
        "code",
        "load_date",
        hundredths(F.col("o")).alias("open"),
        hundredths(F.col("l")).alias("low"),
        hundredths(F.col("h")).alias("high"),
        hundredths(F.col("c")).alias("close"),
        hundredths(F.lag("c").over(w)).alias("pclose"),
        F.col("v").alias("volume"),
        dec(F.col("t").cast("decimal(18,0)") / 100, 3, 20).alias("turnover"),
        dec((F.col("p") * F.col("v")).cast("decimal(18,0)") / 100, 2, 22).alias("market_cap"),
        hundredths(F.col("h")).alias("ask"),
        hundredths(F.col("l")).alias("bid"),
    )
    return with_typical(bars)


def with_typical(bars: DataFrame) -> DataFrame:
    """Add daily_change, typ3 = (H+L+C)/3 and typ4 = (H+L+O+C)/4; a missing price reads as close."""
    high, low, open_ = (F.coalesce(F.col(x), F.col("close")) for x in ("high", "low", "open"))
    close = F.col("close")
    return bars.select(
        "*",
        dec(ratio(close, F.col("pclose")), 4, 12).alias("daily_change"),
        dec((high + low + close) / 3, 3, 12).alias("typ3"),
        dec((high + low + open_ + close) / 4, 3, 12).alias("typ4"),
    )


def categories(codes: DataFrame) -> DataFrame:
    """code -> category, from the brand number; one row per code."""
    number = F.regexp_extract("code", r"(\d+)$", 1).cast("int")
    return codes.select("code").distinct().select(
        "code", F.concat(F.lit("Sector "), (number % 5).cast("string")).alias("category")
    )


def transactions(spark: SparkSession, sf_dir: str, grain: str = "week") -> DataFrame:
    """Wide panel of the feature engine: prices, targets, ratings, earnings, short positions."""
    t = daily_totals(spark, sf_dir, grain)
    analysts = F.col("r0") + F.col("r1") + F.col("r2") + F.col("r3") + F.col("r4")
    weighted = F.col("r0") + 2 * F.col("r1") + 3 * F.col("r2") + 4 * F.col("r3") + 5 * F.col("r4")
    pe = (F.col("o") + F.col("h")) % 900
    return t.select(
        "code",
        "load_date",
        hundredths(F.col("o")).alias("market_open"),
        hundredths(F.lag("c").over(by())).alias("market_previous_close"),
        hundredths(F.col("h")).alias("market_day_high"),
        hundredths(F.col("l")).alias("market_day_low"),
        hundredths(F.col("c")).alias("market_price"),
        F.col("v").alias("market_volume"),
        hundredths(F.col("l")).alias("target_low_price"),
        hundredths(F.col("h")).alias("target_high_price"),
        hundredths(F.col("c")).alias("target_median_price"),
        (analysts % 12).alias("number_of_analyst"),
        F.when(F.col("v") % 23 != 0, dec(ratio(weighted, analysts), 3, 5)).alias("recommendation_mean"),
        F.when(F.col("v") % 11 != 0, dec(pe.cast("decimal(6,0)") / 10, 1, 8)).alias("forward_pe"),
        (F.col("v") * 1000).alias("average_volume"),
        (F.col("s") * 100 + 1).alias("short_position"),
        (F.col("v") * 100).alias("total_in_issue"),
        dec(ratio(F.col("s"), F.col("v")) * 100, 3, 8).alias("reported_position"),
        hundredths(F.col("h")).alias("ask"),
        hundredths(F.col("l")).alias("bid"),
        F.when(F.col("v") % 3 == 0, (F.col("r0") % 4).cast("int")).alias("mi_buy"),
        F.when(F.col("v") % 3 == 0, (F.col("r1") % 4).cast("int")).alias("mi_hold"),
        F.when(F.col("v") % 3 == 0, (F.col("r2") % 4).cast("int")).alias("mi_sell"),
    )


def _tick_ts() -> Column:
    return F.col("ts") - F.expr(f"INTERVAL '{TICK_SHIFT_DAYS}' DAY")


def _tick_code() -> Column:
    return F.concat(F.lit("Brand#"), (F.col("user_id") % 25 + 1).cast("string"))


def web_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text ticks: code, tick_price, tick_time (UTC, whole seconds)."""
    return web_ticker_of(table(spark, sf_dir, "events"))


def web_ticker_of(events: DataFrame) -> DataFrame:
    utc = _tick_ts() - F.expr(f"INTERVAL '{MARKET_UTC_HOURS}' HOUR")
    return events.select(
        _tick_code().alias("code"),
        (F.round(F.col("value") * 100).cast("long") * 10).cast("decimal(12,2)").cast("string").alias("tick_price"),
        F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("tick_time"),
    )


def web_announcement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text announcements with a 12-hour clock and a price-sensitivity flag."""
    return table(spark, sf_dir, "events").select(
        _tick_code().alias("code"),
        F.date_format(_tick_ts(), "dd/MM/yyyy hh:mm a").alias("pub_time"),
        F.when(F.col("value") > 30, "true").otherwise("false").alias("is_price_sens"),
        _tick_ts().alias("sys_load_time"),
    )


def forex_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat `key:value,` text of currency quotes."""
    return forex_snapshot_of(table(spark, sf_dir, "events"))


def forex_snapshot_of(events: DataFrame) -> DataFrame:
    pairs = F.array(*[F.lit(x) for x in ("EUR_USD", "USD_JPY", "AUD_USD", "GBP_USD")])
    bid = F.round(F.col("value") * 100).cast("long").cast("decimal(10,0)")
    info = F.concat(
        F.lit("instrument:"),
        F.get(pairs, (F.col("user_id") % 4).cast("int")),
        F.lit(",time:"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.lit(",closeoutBid:"),
        bid.cast("string"),
        F.lit(",closeoutAsk:"),
        (bid + 3).cast("decimal(10,0)").cast("string"),
        F.lit(","),
    )
    return events.select(
        F.col("event_type").alias("batch"), info.alias("info"), F.col("ts").alias("sys_dt")
    )


def _text(c: Column, scale: int = 2) -> Column:
    return c.cast(f"decimal(14,{scale})").cast("string")


def _price(name: str) -> Column:
    return _text(hundredths(F.col(name)))


def _sum(name: str) -> Column:
    return _text(money(F.col(name)))


def _dirty(pred: Column, text: Column, marker: str = "") -> Column:
    return F.when(pred, F.lit(marker)).otherwise(text)


def _loaded_at(hour: Column) -> Column:
    return F.col("load_date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour)


def web_quote(totals: DataFrame) -> DataFrame:
    """All-text quote rows with blanks; one load per code and day."""
    v = F.col("v")
    return totals.select(
        F.concat(F.lit("b"), F.date_format("load_date", "yyyyMM")).alias("batch_id"),
        "code",
        _dirty(v % 13 == 0, _price("o")).alias("open_price"),
        _dirty(v % 17 == 0, _price("h")).alias("high_price"),
        _dirty(v % 19 == 0, _price("l")).alias("low_price"),
        _price("c").alias("close_price"),
        _dirty(v % 29 == 0, _price("o")).alias("previous_close"),
        v.cast("string").alias("volume"),
        _sum("t").alias("turnover"),
        _price("p").alias("market_cap"),
        _price("h").alias("ask"),
        _price("l").alias("bid"),
        _loaded_at(F.lit(18)).alias("sys_load_time"),
    )


def web_quote_ticks(totals: DataFrame) -> DataFrame:
    """One closing tick per quote; every ninth volume is stale by a day."""
    stale = F.when(F.col("v") % 9 == 0, 24).otherwise(0)
    at = _loaded_at(F.lit(16 - MARKET_UTC_HOURS) - stale)
    return totals.select(
        "code",
        _price("c").alias("tick_price"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("tick_time"),
        _loaded_at(F.lit(18)).alias("sys_load_time"),
    )


def web_finance(totals: DataFrame) -> DataFrame:
    """All-text statements; every fifth volume was loaded twice on its day (09:00 and 17:00)."""
    v = F.col("v")
    hours = F.when(v % 5 == 0, F.array(F.lit(9), F.lit(17))).otherwise(F.array(F.lit(17)))
    rows = totals.withColumn("hour", F.explode(hours))
    last = F.when(F.col("hour") == 9, _price("o")).otherwise(_price("c"))
    pe = _text(((F.col("o") + F.col("h")) % 900).cast("decimal(6,0)") / 10, 1)
    pe = F.when(v % 11 == 0, "").when(v % 13 == 0, "Infinity").otherwise(pe)
    return rows.select(
        "code",
        _dirty(v % 7 == 0, _price("o")).alias("market_open"),
        _dirty(v % 49 == 0, _price("o")).alias("regular_market_open"),
        _dirty(v % 7 == 1, _price("l")).alias("market_previous_close"),
        _price("l").alias("regular_market_previous_close"),
        _dirty(v % 7 == 2, last).alias("market_price"),
        last.alias("current_price"),
        _dirty(v % 7 == 3, v.cast("string")).alias("market_volume"),
        v.cast("string").alias("regular_market_volume"),
        _price("h").alias("market_day_high"),
        _price("l").alias("market_day_low"),
        _dirty(v % 31 == 0, _price("l")).alias("target_low_price"),
        _price("h").alias("target_high_price"),
        _price("c").alias("target_median_price"),
        pe.alias("forward_pe"),
        (v * 2000).cast("string").alias("average_volume"),
        (F.col("r0") % 9).cast("string").alias("number_of_analyst"),
        _text((F.col("o") % 41 + 10).cast("decimal(6,0)") / 10, 1).alias("recommendation_mean"),
        _loaded_at(F.col("hour")).alias("sys_load_time"),
    )


def web_consensus(totals: DataFrame) -> DataFrame:
    """All-text ratings and `$` price targets, loaded twice on every fourth volume."""
    v = F.col("v")
    hours = F.when(v % 4 == 0, F.array(F.lit(9), F.lit(17))).otherwise(F.array(F.lit(17)))
    rows = totals.withColumn("hour", F.explode(hours))
    bump = F.when(F.col("hour") == 9, 1).otherwise(0)
    return rows.select(
        F.concat(F.lit(" "), F.col("code"), F.lit(" ")).alias("code"),
        _dirty(v % 17 == 0, (F.col("r0") + bump).cast("string")).alias("buy"),
        F.col("r1").cast("string").alias("overweight"),
        F.col("r2").cast("string").alias("hold"),
        F.col("r3").cast("string").alias("underweight"),
        F.col("r4").cast("string").alias("sell"),
        F.concat(F.lit("$"), _price("h")).alias("high"),
        F.concat(F.lit("$"), _price("c")).alias("median"),
        _dirty(v % 19 == 0, F.concat(F.lit("$"), _price("l")), "-").alias("low"),
        F.concat(F.lit("$"), _price("o")).alias("average"),
        _loaded_at(F.col("hour")).alias("sys_load_time"),
    )


def web_short(totals: DataFrame) -> DataFrame:
    v = F.col("v")
    hours = F.when(v % 6 == 0, F.array(F.lit(9), F.lit(17))).otherwise(F.array(F.lit(17)))
    rows = totals.withColumn("hour", F.explode(hours))
    return rows.select(
        F.concat(F.col("code"), F.lit("  ")).alias("product_code"),
        _dirty(v % 21 == 0, (F.col("s") + F.col("hour")).cast("string")).alias("short_position"),
        (v * 100).cast("string").alias("total_in_issue"),
        _text(ratio(F.col("s"), v), 4).alias("reported_position"),
        _loaded_at(F.col("hour")).alias("sys_load"),
    )


def web_analysis(totals: DataFrame) -> DataFrame:
    """Fundamentals with magnitude suffixes, dashes and thousands commas."""
    v = F.col("v")
    k = v % 6
    money = F.concat(
        _text((F.col("o") % 5000).cast("decimal(8,0)") / 10, 1),
        F.when(k == 0, "m").when(k == 1, "k").when(k == 2, "bn").when(k == 3, "tr").otherwise(""),
    )
    signed = F.concat(F.when(F.col("l") % 2 == 0, "-").otherwise(""), money)
    return totals.select(
        "code",
        F.when(k == 4, "-").when(v % 30 == 5, "0").otherwise(money).alias("revenue"),
        F.when(k == 5, "-").otherwise(signed).alias("net_income"),
        F.when(v % 10 == 0, "-").otherwise(F.concat(F.lit("1,"), (F.col("h") % 900 + 100).cast("string"), F.lit(".5"))).alias("net_profit_margin"),
        F.when(v % 8 == 0, "-").otherwise(signed).alias("ebitda"),
        F.when(v % 11 == 0, "-").when(v % 13 == 0, "").otherwise(_text((F.col("h") % 700).cast("decimal(6,0)") / 10, 1)).alias("forward_pe"),
        F.when(v % 15 == 0, "").otherwise(_price("h")).alias("reco_price_target"),
        F.when(F.col("c") % 3 == 0, "Buy").when(F.col("c") % 3 == 1, "Hold").otherwise("Sell").alias("average_recommendation"),
        _loaded_at(F.lit(19)).alias("sys_load_time"),
    )
