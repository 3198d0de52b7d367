"""Look-back rankings: how steady was the trend before its newest turn.

Every ranking reads the same look-back: rows of the last 168 (semester) and 84 (quarter) days
before a code's newest turn, if the turn is within 28 days and the code traded on more than a
given share of the trading days. Look-back rows meet one turn row per code, so the joins never
multiply rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeline.functions.numeric import dec, flag, ratio
from tapeline.operators.joins import densify
from tapeline.plans.daily import MONTH, QUARTER, SEMESTER, DateLike, active_on, as_date

SIDES = ("long_end", "short_end")


def candle_state(candles: DataFrame) -> DataFrame:
    """up = the candle closes at or above its open."""
    return candles.select("code", "load_date", (F.col("close") >= F.col("open")).alias("up"))


def sar_state(sar: DataFrame) -> DataFrame:
    return sar.select("code", "load_date", (F.col("ud_trend") == "up").alias("up"))


def turn_dates(state: DataFrame, d: DateLike, side: str) -> DataFrame:
    """Newest date per active code whose state flips on the next bar (up to down for the long end)."""
    rows = state.where(F.col("load_date") <= as_date(d))
    following = F.lead("up").over(W.partitionBy("code").orderBy("load_date"))
    flips = rows.withColumn("_next", following).where(F.col("up") & ~F.col("_next") if side == "long_end" else ~F.col("up") & F.col("_next"))
    newest = flips.groupBy("code").agg(F.max("load_date").alias("cal_date"))
    return newest.join(active_on(state, d), "code", "left_semi")


def trading_days_series(bars: DataFrame, d: DateLike, back: int = MONTH) -> DataFrame:
    """Largest row count of any code in the 168 and 84 days up to each of the last `back` days."""
    day = as_date(d)
    rows = bars.where((F.col("load_date") <= day) & (F.col("load_date") > F.date_sub(day, SEMESTER + back))).select("code", "load_date")
    grid = densify(rows.select("code").distinct(), rows, "load_date").join(rows.withColumn("_here", F.lit(1)), ["code", "load_date"], "left")
    at = W.partitionBy("code").orderBy(F.unix_date("load_date"))
    counts = grid.select(
        "load_date",
        F.count("_here").over(at.rangeBetween(-(SEMESTER - 1), 0)).alias("s"),
        F.count("_here").over(at.rangeBetween(-(QUARTER - 1), 0)).alias("q"),
    )
    return (
        counts.where(F.col("load_date") > F.date_sub(day, back))
        .groupBy("load_date")
        .agg(F.max("s").alias("semester_trading_days"), F.max("q").alias("quarterly_trading_days"))
    )


def lookback_window(state: DataFrame, trading: DataFrame, d: DateLike, side: str, min_share: float = 0.95) -> DataFrame:
    """Look-back rows with in_semester / in_quarter flags; a flag is off where coverage is too thin.

    `trading` is the frame of `trading_days_series`.
    """
    day = as_date(d)
    turns = turn_dates(state, d, side).where(F.col("cal_date") > F.date_sub(day, MONTH))
    days = trading.withColumnRenamed("load_date", "cal_date")
    rows = state.join(turns, "code").where((F.col("load_date") > F.date_sub("cal_date", SEMESTER)) & (F.col("load_date") <= F.col("cal_date")))
    recent = F.col("load_date") > F.date_sub("cal_date", QUARTER)
    per_code = W.partitionBy("code")
    sized = rows.withColumns({"_s": F.count("*").over(per_code), "_recent": recent, "_q": F.sum(flag(recent)).over(per_code)})
    covered = sized.join(days, "cal_date")
    return covered.select(
        "code",
        "load_date",
        "cal_date",
        "up",
        (F.col("_s") > F.col("semester_trading_days") * min_share).alias("in_semester"),
        (F.col("_recent") & (F.col("_q") > F.col("quarterly_trading_days") * min_share)).alias("in_quarter"),
    )


def share_ranking(rows: DataFrame, hit: Column, side: str) -> DataFrame:
    """Share of look-back rows where `hit` holds, per code."""

    def share(inside: str) -> Column:
        return dec(ratio(F.sum(flag(F.col(inside) & hit)), F.sum(flag(F.col(inside)))), 4, 5)

    out = rows.groupBy("code", F.col("cal_date").alias("load_date")).agg(
        share("in_semester").alias("semester_ratio"), share("in_quarter").alias("quarter_ratio")
    )
    return _kept(out, side)


def _kept(out: DataFrame, side: str) -> DataFrame:
    kept = out.where("semester_ratio IS NOT NULL OR quarter_ratio IS NOT NULL")
    return kept.select("code", "load_date", F.lit(side).alias("usage_direction"), "semester_ratio", "quarter_ratio")


def trend_share_ranking(rows: DataFrame, trend: DataFrame, side: str) -> DataFrame:
    """Share of look-back rows with the short mean above the long one (rows without a mean drop out)."""
    joined = rows.join(trend.select("code", "load_date", "e10_e25_direction"), ["code", "load_date"])
    return share_ranking(joined, F.col("e10_e25_direction") == 1, side)


def state_share_ranking(rows: DataFrame, side: str) -> DataFrame:
    """Share of look-back rows in the up state (green candles, up trend)."""
    return share_ranking(rows, F.col("up"), side)


def stability_ranking(rows: DataFrame, bars: DataFrame, side: str) -> DataFrame:
    """Mean distance between a row's place by price and its place by date."""
    priced = rows.join(bars.select("code", "load_date", F.col("close").alias("price")), ["code", "load_date"])

    def distance(inside: str) -> Column:
        part = W.partitionBy("code", inside)
        gap = F.row_number().over(part.orderBy("price", "load_date")) - F.row_number().over(part.orderBy("load_date"))
        return F.when(F.col(inside), F.abs(gap))

    gaps = priced.withColumns({"_s": distance("in_semester"), "_q": distance("in_quarter")})
    out = gaps.groupBy("code", F.col("cal_date").alias("load_date")).agg(
        dec(F.avg("_s"), 3, 12).alias("semester_ratio"), dec(F.avg("_q"), 3, 12).alias("quarter_ratio")
    )
    return _kept(out, side)


def price_stability(bars: DataFrame, d: DateLike, months: int, min_rows: int, below: float) -> DataFrame:
    """code, load_date, ratio of codes whose price order follows the calendar over some months."""
    day = as_date(d)
    rows = bars.where((F.col("load_date") > F.add_months(day, -months)) & (F.col("load_date") <= day))
    part = W.partitionBy("code")
    gap = F.row_number().over(part.orderBy("load_date")) - F.row_number().over(part.orderBy("close", "load_date"))
    gaps = rows.select("code", "load_date", F.abs(gap).alias("gap"))
    out = gaps.groupBy("code").agg(F.max("load_date").alias("load_date"), F.count("*").alias("records"), dec(F.avg("gap"), 3, 12).alias("ratio"))
    return out.where((F.col("records") > min_rows) & (F.col("ratio") < below)).select("code", "load_date", "ratio")


def trend_stability_list(
    bars: DataFrame, actionable: DataFrame, cats: DataFrame, d: DateLike, months: int, min_rows: int, below: float
) -> DataFrame:
    """Stable codes that are liquid enough today, with their category."""
    steady = price_stability(bars, d, months, min_rows, below)
    liquid = actionable.where((F.col("load_date") == as_date(d)) & (F.col("turnover") != 4) & (F.col("popularity") != 4)).select("code")
    return steady.join(liquid, "code", "left_semi").join(cats, "code").select("category", "code", "load_date", "ratio")


def trend_direction(
    sar: DataFrame, ema: DataFrame, actionable: DataFrame, cats: DataFrame, d: DateLike, months: int, min_rows: int, since_months: int = 2, above: float = 0.65
) -> DataFrame:
    """For every up-to-down flip of either stop setting: shares of price > ema15, price > ema40 and
    ema15 > ema40 over the months before, where one share exceeds `above`.

    The look-back is a range frame over the averages' own rows; no join fans out.
    """
    day = as_date(d)
    w = W.partitionBy("code").orderBy("load_date")
    fell = [(F.col(c) == "down") & (F.lag(c).over(w) == "up") for c in ("ud_trend2", "ud_trend3")]
    flips = sar.select("code", "load_date", (fell[0] | fell[1]).alias("_flip")).where(
        F.col("_flip") & (F.col("load_date") > F.add_months(day, -since_months)) & (F.col("load_date") <= day)
    )
    recent = ema.where((F.col("load_date") > F.add_months(day, -(months + since_months + 1))) & (F.col("load_date") <= day))
    frame = f"OVER (PARTITION BY code ORDER BY load_date RANGE BETWEEN INTERVAL '{months}' MONTH PRECEDING AND CURRENT ROW)"
    # The frame's far edge counts as outside: the row exactly that many months back is taken out again.
    tests = {"rec": "1", "pe2": "int(price > ema15)", "pe5": "int(price > ema40)", "e2e5": "int(ema15 > ema40)"}
    edge = F.add_months("load_date", -months)
    sums = recent.selectExpr("code", "load_date", *[f"sum({e}) {frame} AS {n}" for n, e in tests.items()])
    far = recent.selectExpr("code", "load_date AS edge_date", *[f"{e} AS edge_{n}" for n, e in tests.items()])
    counted = flips.join(sums, ["code", "load_date"]).withColumn("edge_date", edge).join(far, ["code", "edge_date"], "left")
    net = {n: F.col(n) - F.coalesce(F.col(f"edge_{n}"), F.lit(0)) for n in tests}
    shares = counted.select("code", "load_date", net["rec"].alias("rec"), *[dec(ratio(net[n], net["rec"]), 3, 5).alias(n) for n in ("pe2", "pe5", "e2e5")])
    strong = shares.where((F.col("rec") > min_rows) & ((F.col("pe2") > above) | (F.col("pe5") > above) | (F.col("e2e5") > above)))
    return strong.join(actionable, ["code", "load_date"]).join(cats, "code").select(
        "category", "code", "load_date", "rec", "pe2", "pe5", "e2e5", "turnover", "popularity"
    )


def trend_direction_list(source: DataFrame, d: DateLike, months: int = 2, min_flips: int = 1) -> DataFrame:
    """Mean of the three shares per code over the last two months; more than one flip, liquid on average."""
    day = as_date(d)
    liquid = F.floor((F.col("popularity") + F.col("turnover")) / 2)
    shares = F.sum(F.col("pe2") + F.col("pe5") + F.col("e2e5"))
    out = (
        source.where((F.col("load_date") > F.add_months(day, -months)) & (F.col("load_date") <= day))
        .groupBy("category", "code")
        .agg(
            F.max("load_date").alias("recent_calculation_date"),
            dec(ratio(shares, F.count("*") * 3), 4, 5).alias("trend"),
            F.avg(liquid).alias("_liquid"),
            F.count("*").alias("_n"),
        )
    )
    return out.where((F.col("_n") > min_flips) & (F.col("_liquid") < 3)).select(
        "category", "code", "recent_calculation_date", "trend", dec(F.col("_liquid"), 1, 3).alias("popularity")
    )


def current_ranking(ranking: DataFrame, actionable: DataFrame, cats: DataFrame, d: DateLike, side: str, descending: bool) -> DataFrame:
    """Newest ranking row per code, liquid on its date, placed by 2 x semester + quarter position.

    One row per listed code is ranked here.
    """
    per_code = W.partitionBy("code", "usage_direction").orderBy(F.desc("load_date"))
    newest = (
        ranking.where("semester_ratio IS NOT NULL AND quarter_ratio IS NOT NULL")
        .withColumn("_n", F.row_number().over(per_code))
        .where((F.col("_n") == 1) & (F.col("usage_direction") == side))
    )
    liquid = actionable.where("turnover <> 4 AND popularity <> 4").select("code", "load_date")
    rows = newest.join(liquid, ["code", "load_date"], "left_semi").join(cats, "code")

    def place(c: str) -> Column:
        return F.row_number().over(W.orderBy(F.desc(c) if descending else F.asc(c), "code"))

    scored = rows.withColumns({"_sr": place("semester_ratio"), "_qr": place("quarter_ratio")}).withColumn("_score", F.col("_sr") * 2 + F.col("_qr"))
    fresh = scored.where(F.col("load_date") > F.date_sub(as_date(d), MONTH))
    return fresh.select(
        "category",
        "code",
        "load_date",
        F.rank().over(W.orderBy("_score")).alias("total_ranking"),
        F.rank().over(W.partitionBy("category").orderBy("_score")).alias("category_ranking"),
    )


def full_list(lists: list[DataFrame]) -> DataFrame:
    """Codes on all four rankings, placed again by the sums of their positions."""
    out = None
    for i, df in enumerate(lists):
        kept = {f"d{i}": "load_date", f"t{i}": "total_ranking", f"c{i}": "category_ranking"}
        cols = df.select("code", *(["category"] if i == 0 else []), *[F.col(c).alias(n) for n, c in kept.items()])
        out = cols if out is None else out.join(cols, "code")
    n = len(lists)
    sums = out.select(
        "category",
        "code",
        F.greatest(*[F.col(f"d{i}") for i in range(n)]).alias("last_update_date"),
        sum((F.col(f"t{i}") for i in range(1, n)), F.col("t0")).alias("_t"),
        sum((F.col(f"c{i}") for i in range(1, n)), F.col("c0")).alias("_c"),
    )
    return sums.select(
        "category",
        "code",
        "last_update_date",
        F.row_number().over(W.orderBy("_t", "code")).alias("total_ranking"),
        F.row_number().over(W.partitionBy("category").orderBy("_c", "code")).alias("category_ranking"),
    )
