"""End-of-day indicators. `d` is the as-of date (a literal or a Column); most results cover all dates."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeline.functions.numeric import cases, dec, flag, ratio
from tapeline.functions.series import EMA15, EMA40, by, last_rows, list_last, newest_of, weighted_last, weighted_of, wholes
from tapeline.operators.folds import streaks

DateLike = dt.date | str | Column


def as_date(d: DateLike) -> Column:
    return d if isinstance(d, Column) else F.lit(str(d)).cast("date")


def calendar(df: DataFrame, date: str = "load_date") -> DataFrame:
    """Distinct dates numbered from the newest (rnum) and from the oldest (date_index).

    One row per trading day, so one task is enough.
    """
    days = df.select(date).distinct()
    return days.select(
        date,
        F.row_number().over(W.orderBy(F.desc(date))).cast("long").alias("rnum"),
        F.row_number().over(W.orderBy(date)).cast("long").alias("date_index"),
    )


def active_on(df: DataFrame, d: DateLike, key: str = "code", date: str = "load_date") -> DataFrame:
    """Keys whose newest row up to d is exactly on d."""
    return df.where(F.col(date) <= as_date(d)).groupBy(key).agg(F.max(date).alias("_last")).where(F.col("_last") == as_date(d)).select(key)


# Popularity thresholds (volume, price) and (volume, volume x price) per class.
POPULARITY = {
    "wide": [(2_000_000, "0.2", 1_000_000, 4_000_000), (1_000_000, "0.1", 500_000, 1_500_000), (500_000, "0.05", 250_000, 500_000)],
    "narrow": [(2_000_000, "0.5", 1_000_000, 4_000_000), (1_000_000, "0.25", 500_000, 1_500_000), (500_000, "0.125", 250_000, 500_000)],
}


def actionable_list(
    bars: DataFrame, d: DateLike | None, months: int = 4, turnover_cuts: tuple[int, int, int] = (100, 200, 500), style: str = "wide", rows: int = 14
) -> DataFrame:
    """Turnover and popularity classes 1..4 from the lowest volume and close of the last 14 rows.

    Only rows of the last `months` months count. With d = None every date is classified.
    """
    since = bars
    if d is not None:
        day = as_date(d)
        since = bars.where((F.col("load_date") > F.add_months(day, -months)) & (F.col("load_date") <= day))
    frame = last_rows(by(), rows)
    low = since.select(
        "code", "load_date", F.min("volume").over(frame).alias("min_volume"), F.min("close").over(frame).alias("min_close")
    )
    if d is not None:
        low = low.where(F.col("load_date") == as_date(d))
    value = F.col("min_volume").cast("decimal(14,0)") * F.col("min_close")
    ranked = low.withColumn("_value", value).withColumn(
        "_rank", F.row_number().over(W.partitionBy("load_date").orderBy(F.desc("_value"), "code"))
    )
    a, b, c = turnover_cuts
    classes = [
        ((F.col("min_volume") > v) & (F.col("min_close") > Decimal(p)) | (F.col("min_volume") > v2) & (F.col("_value") > pv), i)
        for i, (v, p, v2, pv) in enumerate(POPULARITY[style], start=1)
    ]
    return ranked.select(
        "code",
        "load_date",
        cases([(F.col("_rank") <= a, 1), (F.col("_rank") <= b, 2), (F.col("_rank") <= c, 3)], 4).alias("turnover"),
        cases(classes, 4).alias("popularity"),
    )


def weighted_ma(series: DataFrame, value: str, weights: list[Decimal], out: str, scale: int = 3) -> DataFrame:
    """Weighted mean of the newest rows at every date; rows without a full history are left out."""
    ma = dec(weighted_last(F.col(value), by(), weights, scale), 4, 14)
    return series.withColumn(out, ma).where(F.col(out).isNotNull())


def moving_averages(bars: DataFrame, short: list[Decimal] = EMA15, long: list[Decimal] = EMA40, keep: tuple[str, ...] = ()) -> DataFrame:
    """code, load_date, price, ema15, ema40 and the columns `keep`, where both means have a full history."""
    n = max(len(short), len(long))
    # a row counts only if all its closes are there, so the newest ones of the long list are the short list
    closes = bars.select("code", "load_date", *keep, F.col("close").alias("price"), list_last(wholes(F.col("close")), by(), n).alias("_h"))
    full = closes.where(F.size("_h") == n)
    return full.select(
        "code",
        "load_date",
        *keep,
        "price",
        dec(weighted_of(newest_of(F.col("_h"), len(short)), short), 4, 14).alias("ema15"),
        dec(weighted_of(newest_of(F.col("_h"), len(long)), long), 4, 14).alias("ema40"),
    )


def weighted_ma_on(bars: DataFrame, d: DateLike) -> DataFrame:
    """Moving averages of the codes that trade on d."""
    upto = bars.where(F.col("load_date") <= as_date(d))
    return moving_averages(upto).where(F.col("load_date") == as_date(d))


def weighted_ma_rolling(bars: DataFrame, newest: int = 11) -> DataFrame:
    """Moving averages on each code's newest dates; only the rows they need are averaged."""
    newest_first = W.partitionBy("code").orderBy(F.desc("load_date"))
    reach = newest + max(len(EMA15), len(EMA40)) - 1
    rows = bars.select("code", "load_date", "close", F.row_number().over(newest_first).alias("_n")).where(F.col("_n") <= reach)
    return moving_averages(rows, keep=("_n",)).where(F.col("_n") <= newest).drop("_n")


def match_point(bars: DataFrame, weights: list[Decimal] = EMA40) -> DataFrame:
    """Price at which the next close would equal its own weighted mean.

    With w0 the newest weight, p = w0 p + sum(w[i] c[t+1-i]), hence the sum over (1 - w0).
    """
    rest = weighted_last(F.col("close"), by(), weights[1:])
    price = dec(ratio(rest, F.lit(float(1 - weights[0]))), 4, 14)
    return bars.select("code", "load_date", price.alias("match_point")).where("match_point IS NOT NULL")


def price_area(ema: DataFrame, weights: list[Decimal] = EMA15) -> DataFrame:
    """Weighted mean of price / ema40 (1 where the mean is zero), four decimals."""
    distance = F.when(F.col("ema40") == 0, F.lit(1.0)).otherwise(ratio(F.col("price"), F.col("ema40")))
    rows = ema.select("code", "load_date", dec(distance, 6, 14).alias("_distance"))
    return weighted_ma(rows, "_distance", weights, "area", scale=6).select("code", "load_date", "area")


def ema_trend(ema: DataFrame) -> DataFrame:
    """Direction and run length of price/ema15, price/ema40 and ema15/ema40 for every date."""
    pairs = {"prc_e10": ("price", "ema15"), "prc_e25": ("price", "ema40"), "e10_e25": ("ema15", "ema40")}
    out = ema.select(
        "code", "load_date", *[F.when(F.col(a) >= F.col(b), 1).when(F.col(a) < F.col(b), -1).alias(f"{n}_direction") for n, (a, b) in pairs.items()]
    )
    for n in pairs:
        out = streaks(out, "code", "load_date", f"{n}_direction", f"{n}_trend")
    return out


def ema_cross_period(ema: DataFrame, days: DataFrame) -> DataFrame:
    """Trading days since the newest up-cross, 0 when a down-cross came later."""
    w = by()
    before15, before40 = F.lag("ema15").over(w), F.lag("ema40").over(w)
    crosses = ema.select(
        "code",
        F.when((F.col("ema15") > F.col("ema40")) & (before15 <= before40), F.col("load_date")).alias("up"),
        F.when((F.col("ema15") < F.col("ema40")) & (before15 >= before40), F.col("load_date")).alias("down"),
    )
    newest = crosses.groupBy("code").agg(F.max("up").alias("up"), F.max("down").alias("down")).where("up IS NOT NULL AND down IS NOT NULL")
    today = days.agg(F.max("load_date")).scalar()
    return newest.join(days.withColumnRenamed("load_date", "up"), "up").select(
        "code", today.alias("load_date"), F.when(F.col("up") > F.col("down"), F.col("rnum")).otherwise(F.lit(0)).alias("trend_period")
    )


def macd(ema: DataFrame, weights: list[Decimal] = EMA15) -> DataFrame:
    """diff = ema15 - ema40, dea = weighted mean of diff."""
    diff = ema.select("code", "load_date", dec(F.col("ema15") - F.col("ema40"), 4, 14).alias("diff"))
    return weighted_ma(diff, "diff", weights, "dea", scale=4)


def moving_range(bars: DataFrame, d: DateLike, n: int = 60, cut: int = 6) -> DataFrame:
    """Mean and deviation of the daily range and change (percent), extremes trimmed on both sides.

    Codes that trade on d with n rows up to d; `cut` rows are dropped at either end.
    """
    pclose = F.coalesce(F.col("pclose"), F.lag("close").over(by()))
    newest = W.partitionBy("code").orderBy(F.desc("load_date"))
    rows = (
        bars.where(F.col("load_date") <= as_date(d))
        .select("code", "load_date", "high", "low", "close", pclose.alias("pclose"), F.row_number().over(newest).alias("_n"))
        .where(F.col("_n") <= n)
    )

    def gap(a: str, b: str) -> Column:
        return F.abs(F.lit(1.0) - ratio(F.col(a), F.col(b)))

    shaped = rows.select(
        "code",
        "load_date",
        dec(F.greatest(gap("high", "pclose"), gap("low", "pclose"), gap("high", "close"), gap("low", "close")) * 100, 3, 12).alias("range"),
        dec(gap("close", "pclose") * 100, 3, 12).alias("diff"),
    )
    trimmed = trimmed_stats(shaped, "code", ["range", "diff"], cut, n - cut + 1)
    full = n - 2 * cut
    return (
        trimmed.where((F.col("load_date") == as_date(d)) & (F.col("range_count") == full) & (F.col("diff_count") == full))
        .select("code", "load_date", "avg_range", "std_range", "avg_diff", "std_diff")
    )


def recent_range(bars: DataFrame, actionable: DataFrame, n: int = 39, low: int = 5, high: int = 36) -> DataFrame:
    """The shorter variant: newest n rows of every code, ranks between low and high, liquid codes only."""
    newest = W.partitionBy("code").orderBy(F.desc("load_date"))
    before = F.lag("close").over(by())
    rows = bars.select(
        "code", "load_date", "high", "low", "close", "pclose", before.alias("_before"), F.row_number().over(newest).alias("_n")
    ).where(F.col("_n") <= n)

    def gap(a: str, b: str) -> Column:
        return F.abs(F.lit(1.0) - ratio(F.col(a), F.col(b))) * 100

    widest = F.greatest(gap("high", "pclose"), gap("low", "pclose"), gap("high", "close"), gap("low", "close"))
    shaped = rows.select("code", "load_date", widest.alias("range"), F.coalesce(gap("close", "pclose"), gap("close", "_before")).alias("diff"))
    stats = trimmed_stats(shaped, "code", ["range", "diff"], low, high)
    liquid = actionable.where("turnover <> 4 OR popularity <> 4").select("code", "load_date")
    return stats.join(liquid, ["code", "load_date"], "left_semi").select(
        "code", F.col("load_date").alias("latest_date"), *[dec(F.col(c), 3, 9).alias(c) for c in ("avg_range", "std_range", "avg_diff", "std_diff")]
    )


def trimmed_stats(df: DataFrame, key: str, cols: list[str], low: int, high: int, date: str = "load_date") -> DataFrame:
    """Mean, deviation and count per key over the rows ranked strictly between low and high, per column.

    One shuffle serves all columns: every ranking is partitioned by the same key.
    """
    ranks = {f"_{c}": F.row_number().over(W.partitionBy(key).orderBy(F.asc_nulls_last(c), date)) for c in cols}
    kept = df.withColumns(ranks)
    aggs = [F.max(date).alias(date)]
    for c in cols:
        inside = (F.col(f"_{c}") > low) & (F.col(f"_{c}") < high)
        value = F.when(inside, F.col(c).cast("double"))
        aggs += [
            F.avg(value).alias(f"avg_{c}"),
            F.stddev_samp(value).alias(f"std_{c}"),
            F.sum(flag(inside)).alias(f"{c}_count"),
        ]
    return kept.groupBy(key).agg(*aggs)


def volume_bands(bars: DataFrame, d: DateLike, n: int = 60, cut: int = 6) -> DataFrame:
    """Trimmed mean and deviation of volume; benchmark = mean + 3 deviations, flag where exceeded."""
    newest = W.partitionBy("code").orderBy(F.desc("load_date"))
    rows = (
        bars.where(F.col("load_date") <= as_date(d))
        .select("code", "load_date", "volume", F.row_number().over(newest).alias("_n"))
        .where(F.col("_n") <= n)
    )
    today = rows.where(F.col("load_date") == as_date(d)).select("code", "load_date", "volume")
    stats = trimmed_stats(rows.drop("load_date").withColumn("load_date", F.col("_n")), "code", ["volume"], cut, n - cut + 1).select(
        "code", F.round("avg_volume").cast("long").alias("avg_volume"), F.round("std_volume").cast("long").alias("std_volume")
    )
    bench = F.col("avg_volume") + F.col("std_volume") * 3
    return today.join(stats, "code").select(
        "code", "load_date", "volume", "avg_volume", "std_volume", bench.alias("benchmark"), flag(F.col("volume") > bench).alias("flag")
    )


# Look-back lengths in days.
SEMESTER, QUARTER, MONTH = 168, 84, 28


def trading_days(bars: DataFrame, d: DateLike) -> DataFrame:
    """Largest number of rows of any code in the last 168, 84 and 28 days up to d; one row."""
    day = as_date(d)
    rows = bars.where((F.col("load_date") <= day) & (F.col("load_date") > F.date_sub(day, SEMESTER)))
    counts = rows.groupBy("code").agg(
        F.max("load_date").alias("load_date"),
        F.count("*").alias("s"),
        F.sum(flag(F.col("load_date") > F.date_sub(day, QUARTER))).alias("q"),
        F.sum(flag(F.col("load_date") > F.date_sub(day, MONTH))).alias("m"),
    )
    return counts.agg(
        F.max("load_date").alias("load_date"),
        F.max("s").alias("semester_trading_days"),
        F.max("q").alias("quarterly_trading_days"),
        F.max("m").alias("monthly_trading_days"),
    )
