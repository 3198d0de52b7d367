"""Current-state views: the newest row per code with its signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeline.functions.numeric import cases, dec, ratio, sign_of
from tapeline.functions.series import by, last_rows
from tapeline.functions.text import joined
from tapeline.operators.windows import latest_per_key
from tapeline.plans.daily import DateLike, as_date, calendar


def newest(df: DataFrame) -> DataFrame:
    return latest_per_key(df, ["code"], [F.desc("load_date")])


def ema_current(ema: DataFrame) -> DataFrame:
    """BUY / SELL and the gap of both means to the price, in percent."""

    def gap(c: str) -> Column:
        return joined(dec((F.lit(1.0) - ratio(F.col(c), F.col("price"))) * 100, 3, 9), "%")

    return newest(ema).select(
        "code",
        "load_date",
        F.when(F.col("ema15") >= F.col("ema40"), "BUY").otherwise("SELL").alias("indicator"),
        "price",
        joined(gap("ema15"), " ~ ", gap("ema40")).alias("ema"),
    )


def sar_current(sar: DataFrame) -> DataFrame:
    return newest(sar.select("code", "load_date", "ud_trend", "n_sar"))


def volume_current(bands: DataFrame) -> DataFrame:
    """Volume over its trimmed mean, and how many deviations above (0 to 3)."""
    v, mean, std = (F.col(c) for c in ("volume", "avg_volume", "std_volume"))
    bucket = cases([(v >= mean + std * k, k) for k in (3, 2, 1)], 0)
    return newest(bands).select("code", "load_date", "volume", "avg_volume", "std_volume", dec(ratio(v, mean), 3, 9).alias("ratio"), bucket.alias("range"))


def candle_status() -> Column:
    """Positive / Negative: no shadow against the move; Long / Short otherwise."""
    o, h, low, c = (F.col(x) for x in ("open", "high", "low", "close"))
    return (
        F.when((c >= o) & (o == low), "Positive")
        .when((c < o) & (o == h), "Negative")
        .when(c >= o, "Long")
        .when(c < o, "Short")
    )


def candle_current(candles: DataFrame) -> DataFrame:
    """Status of the newest candle and whether it turned."""
    w = by()
    up = F.col("close") >= F.col("open")
    before = F.lag("close").over(w) >= F.lag("open").over(w)
    rows = candles.select("code", "load_date", candle_status().alias("status"), (up != before).alias("_turned"))
    trend = F.when(F.col("_turned"), "Reverse").otherwise("Continuously")
    return newest(rows).select("code", "load_date", "status", trend.alias("trend"))


def candle_sequence(candles: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """Trading days since each code's last colour change, for codes with a candle on the newest day."""
    w = by()
    up, before = F.col("open") <= F.col("close"), F.lag("open").over(w) <= F.lag("close").over(w)
    turns = candles.select("code", "load_date", (up != before).alias("_turn")).where("_turn").groupBy("code").agg(F.max("load_date").alias("_day"))
    placed = (days if days is not None else calendar(candles)).select(F.col("load_date").alias("_day"), F.col("rnum").alias("sequence"))
    current = candles.where(F.col("load_date") == candles.agg(F.max("load_date")).scalar()).select("code", "load_date", candle_status().alias("status"))
    return current.join(turns.join(placed, "_day"), "code").select("code", "load_date", "sequence", "status")


def short_breaks(bars: DataFrame, shorts: DataFrame, days: DataFrame, width: float = 1.28, n: int = 20) -> DataFrame:
    """Days on which the short value left its 20-row band, newest first (rnum), with trading-day distance."""
    rows = bars.where("market_cap IS NOT NULL").select("code", "load_date", "typ3").join(shorts.select("code", "load_date", "short_position"), ["code", "load_date"])
    value = F.sum(F.col("typ3") * F.col("short_position").cast("decimal(18,0)")).cast("double")
    short = rows.groupBy("code", "load_date").agg(value.alias("short"))
    frame = last_rows(by(), n)
    banded = short.withColumns({"_avg": F.avg("short").over(frame), "_std": F.stddev_samp("short").over(frame)})
    hi, lo = F.col("_avg") + F.col("_std") * width, F.col("_avg") - F.col("_std") * width
    out = banded.where("_avg IS NOT NULL AND _std IS NOT NULL").where((F.col("short") >= hi) | (F.col("short") < lo))
    return out.join(days.select("load_date", F.col("rnum").alias("cal_dist")), "load_date").select(
        "code",
        "load_date",
        "short",
        (F.col("_avg") + F.col("_std") * 2).alias("up_band"),
        (F.col("_avg") - F.col("_std") * 2).alias("down_band"),
        F.when(F.col("short") >= hi, 1).when(F.col("short") < lo, -1).otherwise(0).alias("short_amount"),
        F.row_number().over(W.partitionBy("code").orderBy(F.desc("load_date"))).alias("rnum"),
        "cal_dist",
    )


def short_current(breaks: DataFrame) -> DataFrame:
    """The newest two breaks per code side by side; codes with only one drop out."""

    def at(k: int, c: str) -> Column:
        return F.max(F.when(F.col("rnum") == k, F.col(c)))

    out = breaks.where("rnum <= 2").groupBy("code").agg(
        at(1, "short_amount").alias("nearest_break"),
        at(2, "short_amount").alias("previous_break"),
        at(1, "cal_dist").alias("nearest_distance"),
        at(2, "cal_dist").alias("previous_distance"),
    )
    return out.where("previous_break IS NOT NULL")


def announcement_age(announcements: DataFrame, days: DataFrame, d: DateLike) -> DataFrame:
    """Trading days since the newest announcement; 0 when one came before 10:00 on d."""
    day = as_date(d)
    early = (F.col("pub_datetime").cast("date") == day) & (F.col("pub_datetime") < day.cast("timestamp_ntz") + F.expr("INTERVAL '10' HOUR"))
    today = announcements.where(early).select("code", F.lit(0).cast("long").alias("last_anc"))
    aged = announcements.select("code", F.col("pub_datetime").cast("date").alias("load_date")).join(days.select("load_date", "rnum"), "load_date")
    return today.unionByName(aged.select("code", F.col("rnum").alias("last_anc"))).groupBy("code").agg(F.min("last_anc").alias("last_anc"))


FUNDAMENTALS = ("revenue", "net_income", "net_profit_margin", "ebitda")


def analysis_current(analysis: DataFrame, cats: DataFrame, d: DateLike, as_text: bool = False, max_age: int = 14) -> DataFrame:
    """Health of the newest fundamentals and the position of the earnings ratio in its category.

    Health is (sum of four signs + 4) / 8, or the four signs as P, N and / text. The earnings
    position runs from 1 (largest) to 0; a missing ratio counts as -999.
    """
    day = as_date(d)
    # the newest row of a code counts if it is recent, so older rows need not be ranked
    rows = newest(analysis.where((F.col("load_date") <= day) & (F.col("load_date") > F.date_sub(day, max_age)))).join(cats, "code")
    if as_text:
        parts: list = []
        for c in FUNDAMENTALS:
            parts += [" ~ ", sign_of(F.col(c), ("P", "/", "N"))]
        health = joined(*parts[1:])
    else:
        health = dec(sum((sign_of(F.col(c)) for c in FUNDAMENTALS), F.lit(4)) / 8.0, 2, 3)
    pe = F.coalesce(F.col("fpe").cast("double"), F.lit(-999.0))
    per = W.partitionBy("category")
    placed = rows.withColumn("_fpe", pe).withColumns({"_pe": F.row_number().over(per.orderBy(F.desc("_fpe"), "code")), "_cnt": F.count("*").over(per)})
    position = dec(F.lit(1.0) - ratio(F.col("_pe") - 1, F.col("_cnt") - 1), 3, 4)
    return placed.select(
        "category", "code", "load_date", F.col("average_recommendation").alias("rec"), health.alias("financial_healthy"), position.alias("pe_ranking")
    )


def at_newest(df: DataFrame, date: str = "load_date") -> DataFrame:
    return df.where(F.col(date) == df.agg(F.max(date)).scalar())


def current_actionable(actionable: DataFrame) -> DataFrame:
    """Newest classification of the codes that are liquid by either class."""
    return at_newest(actionable).where("turnover <> 4 OR popularity <> 4")


def compare_recent(history: DataFrame, today: DataFrame, cols: list[str], d: DateLike, back: int = 28) -> DataFrame:
    """Today's values with those of the two rows before, per code (current_, last_, previous_)."""
    day = as_date(d)
    recent = history.where((F.col("load_date") < day) & (F.col("load_date") > F.date_sub(day, back)))
    rows = recent.select("code", "load_date", *cols).unionByName(today.where(F.col("load_date") == day).select("code", "load_date", *cols))
    w = by()
    out = rows.select(
        "code",
        "load_date",
        *[F.col(c).alias(f"current_{c}") for c in cols],
        *[F.lag(c, 1).over(w).alias(f"last_{c}") for c in cols],
        *[F.lag(c, 2).over(w).alias(f"previous_{c}") for c in cols],
    )
    return out.where(F.col("load_date") == day)


def flags_text(a: Column, b: Column) -> Column:
    """BOTH / HA / MACD / '' of a candle flag and a convergence flag."""
    return F.when(a & b, "BOTH").when(a, "HA").when(b, "MACD").otherwise("")
