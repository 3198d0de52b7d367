"""Provisional day: bars up to a cut-off laid over the stored history.

The cut-offs 12:30, 13:45 and 15:00 differ in nothing but the time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeline.functions.numeric import dec, first_by, last_by
from tapeline.functions.series import EMA15, EMA40, by, weighted_last
from tapeline.functions.text import joined
from tapeline.operators.joins import pair_next
from tapeline.operators.rows import trading_time, up_to
from tapeline.operators.tables import overlay
from tapeline.operators.windows import latest_per_key
from tapeline.plans import daily, market_index, views
from tapeline.plans.daily import DateLike, as_date
from tapeline.plans.reports import DailyRun, short_text
from tapeline.staging import stage

# The three cut-offs of a day.
CUTOFFS = ("12:30:00", "13:45:00", "15:00:00")
PRICE4 = "decimal(14,4)"


def wall_seconds(ts: str) -> Column:
    """Whole seconds on the market clock, for ordering; the session time zone plays no part."""
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.unix_date(F.col(ts).cast("date")).cast("long") * 86400 + clock


def tick_bars(ticks: DataFrame, *keys: Column | str) -> DataFrame:
    """open, high, low, close of typed ticks per group; partial sums run before the shuffle."""
    seconds = wall_seconds("tick_ts")
    whole = (F.col("tick_price") * 10000).cast("long")

    def price(c: Column) -> Column:
        return (c.cast("decimal(14,0)") / 10000).cast(PRICE4)

    return ticks.groupBy(*keys).agg(
        F.max("tick_price").cast(PRICE4).alias("high"),
        F.min("tick_price").cast(PRICE4).alias("low"),
        price(first_by(seconds, whole)).alias("open"),
        price(last_by(seconds, whole)).alias("close"),
    )


def intraday_bars(ticks: DataFrame, cutoff: str) -> DataFrame:
    """Bars of the newest weekday from ticks up to the cut-off."""
    return bars_by_cutoff(ticks, (cutoff,)).drop("cutoff")


def bars_by_cutoff(ticks: DataFrame, cutoffs: Sequence[str]) -> DataFrame:
    """Bars of the newest weekday from ticks up to each cut-off, all in one grouping.

    A tick counts for every cut-off it is not later than; partial sums take it up in its own task.
    """
    day = F.col("tick_ts").cast("date")
    newest = trading_time(ticks, "tick_ts").agg(F.max(day)).scalar()
    rows = trading_time(ticks, "tick_ts").where(day == newest)
    reached = F.array_compact(F.array(*[F.when(up_to(F.col("tick_ts"), c), F.lit(c)) for c in cutoffs]))
    bars = tick_bars(rows.withColumn("cutoff", F.explode(reached)), "cutoff", "code", day.alias("load_date"))
    high, low, open_, close = (F.col(c) for c in ("high", "low", "open", "close"))
    return bars.select(
        "*", dec((high + low + close) / 3, 4, 14).alias("typ3"), dec((high + low + open_ + close) / 4, 4, 14).alias("typ4")
    )


def provisional_candles(today: DataFrame, candles: DataFrame, d: DateLike) -> DataFrame:
    """Candle of the provisional bar from the code's last stored candle; codes without one drop out."""
    last = latest_per_key(candles.where(F.col("load_date") < as_date(d)), ["code"], [F.desc("load_date")])
    rows = today.join(last.select("code", F.col("open").alias("_po"), F.col("close").alias("_pc")), "code")
    h_open = (F.col("_po") + F.col("_pc")) / 2
    h_close = (F.col("open") + F.col("high") + F.col("low") + F.col("close")) / 4
    return rows.select(
        "code",
        "load_date",
        dec(h_open, 4, 14).alias("open"),
        dec(F.greatest(F.col("high"), h_open, h_close), 4, 14).alias("high"),
        dec(F.least(F.col("low"), h_open, h_close), 4, 14).alias("low"),
        dec(h_close, 4, 14).alias("close"),
    )


def provisional_averages(history: DataFrame, today: DataFrame, d: DateLike) -> DataFrame:
    """Weighted means at d over the history before d and today's provisional close."""
    cols = ("code", "load_date", "close")
    rows = overlay(history.select(*cols), today.select(*cols), "load_date", as_date(d))
    w = by()
    out = rows.select(
        "code",
        "load_date",
        F.col("close").cast(PRICE4).alias("price"),
        dec(weighted_last(F.col("close"), w, EMA15, 4), 4, 14).alias("ema15"),
        dec(weighted_last(F.col("close"), w, EMA40, 4), 4, 14).alias("ema40"),
    )
    return out.where((F.col("load_date") == as_date(d)) & F.col("ema15").isNotNull() & F.col("ema40").isNotNull())


def provisional_macd(history_ema: DataFrame, today_ema: DataFrame, d: DateLike) -> DataFrame:
    """diff and dea at d from stored and provisional means."""
    cols = ("code", "load_date", "ema15", "ema40")
    rows = overlay(history_ema.select(*cols), today_ema.select(*cols), "load_date", as_date(d))
    return daily.macd(rows).where(F.col("load_date") == as_date(d))


def swing_trend(candles: DataFrame, today: DataFrame, d: DateLike, weeks: int = 48) -> DataFrame:
    """'i' where the last two green highs and red lows both rose, 'd' where both fell.

    A swing runs from a candle that turned colour to the next candle before the colour turns
    back. Windows find the swings; only each code's newest two are joined to their rows.
    """
    day = as_date(d)
    cols = ("code", "load_date", "open", "close")
    recent = candles.where(F.col("load_date") > F.date_sub(day, weeks * 7))
    rows = overlay(recent.select(*cols), today.select(*cols), "load_date", day)
    w = by()
    green = F.col("open") <= F.col("close")
    marked = rows.select("code", "load_date", "close", green.alias("green"), F.lag(green).over(w).alias("before"), F.lead(green).over(w).alias("next"))

    def swing_points(up: bool) -> DataFrame:
        inside = F.col("green") if up else ~F.col("green")
        was_other = ~F.col("before") if up else F.col("before")
        turns = ~F.col("next") if up else F.col("next")
        pairs = pair_next(marked, "code", "load_date", inside & was_other, inside & turns)
        place = F.row_number().over(W.partitionBy("code").orderBy(F.desc("exit_date"), F.desc("entry_date")))
        newest = pairs.withColumn("_n", place).where("_n <= 2")
        spans = newest.join(marked.select("code", "load_date", "close"), "code").where(
            (F.col("load_date") >= F.col("entry_date")) & (F.col("load_date") <= F.col("exit_date"))
        )
        point = F.max if up else F.min
        return spans.groupBy("code").agg(
            point(F.when(F.col("_n") == 1, F.col("close"))).alias("p1"), point(F.when(F.col("_n") == 2, F.col("close"))).alias("p2")
        )

    highs, lows = swing_points(True), swing_points(False)
    both = highs.select("code", F.col("p1").alias("h1"), F.col("p2").alias("h2")).join(lows.select("code", F.col("p1").alias("l1"), F.col("p2").alias("l2")), "code")
    trend = F.when((F.col("h1") > F.col("h2")) & (F.col("l1") > F.col("l2")), "i").when((F.col("h1") < F.col("h2")) & (F.col("l1") < F.col("l2")), "d")
    return both.select("code", day.alias("load_date"), trend.alias("trend")).where("trend IS NOT NULL")


def break_list(run: DailyRun, long_list: DataFrame, today: DataFrame, d: DateLike) -> DataFrame:
    """Listed codes whose provisional high crossed a falling stop, with age of news and expected range."""
    sar = views.at_newest(run.sar_pair).where("ud_trend2 = 'down' OR ud_trend3 = 'down'").drop("load_date")
    over2 = (F.col("high") > F.col("n_sar2")) & (F.col("ud_trend2") == "down")
    over3 = (F.col("high") > F.col("n_sar3")) & (F.col("ud_trend3") == "down")
    text = (
        F.when(over2 & over3, joined("$", F.col("n_sar2"), "~", "$", F.col("n_sar3")))
        .when(over2, joined("$", F.col("n_sar2"), "~", "-"))
        .otherwise(joined("-", "~", "$", F.col("n_sar3")))
    )
    liquid = views.current_actionable(run.actionable).select("code", dec((F.col("turnover") + F.col("popularity")) / 2.0, 1, 2).alias("popularity"))
    day = as_date(d)
    early = run.announcements.where(
        (F.col("pub_datetime").cast("date") == day) & (F.col("pub_datetime") < day.cast("timestamp_ntz") + F.expr("INTERVAL '10' HOUR"))
    )
    early = early.select("code").distinct().withColumn("_early", F.lit(True))
    aged = run.announcements.select("code", F.col("pub_datetime").cast("date").alias("load_date")).join(run.days, "load_date")
    aged = aged.groupBy("code").agg(F.min("rnum").alias("last_anc"))
    age = F.when(F.col("_early"), F.lit(0).cast("long")).when(F.col("last_anc") < 10, F.col("last_anc")).otherwise(F.lit(-1).cast("long"))
    tech = today.join(sar, "code").where(over2 | over3).join(liquid, "code").join(early, "code", "left").join(aged, "code", "left")
    tech = tech.select("code", "load_date", "popularity", text.alias("sar"), age.alias("reporting_date"))
    recent = long_list.join(run.days.where("rnum < 6").select("load_date"), "load_date", "left_semi")
    listed = views.newest(recent).where("quarterly_direction <> 0 OR semester_direction <> 0")
    c = F.col
    trend = joined("(", c("quarterly_direction"), "~", c("semester_direction"), ",", c("quarterly_stability"), "~", c("semester_stability"), ")")
    out = tech.join(listed.select("code", trend.alias("trend")), "code").join(run.cats, "code")
    out = out.join(run.analysis.select("code", "rec", "financial_healthy", "pe_ranking"), "code", "left")
    out = out.join(run.ranges.select("code", "avg_diff", "std_diff"), "code")
    expect = joined(
        dec(c("avg_diff") * 2 - c("std_diff"), 2, 9), "%", "~", dec(c("avg_diff") * 2, 2, 9), "%", "~", dec(c("avg_diff") * 2 + c("std_diff"), 2, 9), "%"
    )
    return out.select(
        "category", "code", "load_date", "popularity", "sar", "trend", "reporting_date", expect.alias("expect_ratio"), "rec", "financial_healthy", "pe_ranking"
    )


class IntradayRun:
    """Provisional tables of one cut-off over the end-of-day history."""

    def __init__(self, run: DailyRun, ticks: DataFrame, d: DateLike, cutoff: str):
        self.run, self.d, self.day = run, d, as_date(d)
        self.bars = stage(intraday_bars(ticks, cutoff))

    @cached_property
    def _candles(self) -> DataFrame:
        return stage(provisional_candles(self.bars, self.run.candles, self.d))

    @cached_property
    def _index(self) -> DataFrame:
        s = self.run.settings
        comp = stage(market_index.provisional_components(self.run.components, self.bars, self.d))
        return stage(market_index.index_direction(comp, self.run.cats, s.index_days, s.index_label))

    def candles(self) -> DataFrame:
        return self._candles

    def index(self) -> DataFrame:
        return self._index

    def index_report(self) -> DataFrame:
        return market_index.index_flags(self.index(), self.run.index)

    def ema(self) -> DataFrame:
        return provisional_averages(self.run.bars, self.bars, self.d)

    def candle_ema(self) -> DataFrame:
        return provisional_averages(self.run.candles, self.candles(), self.d)

    @cached_property
    def _macd(self) -> DataFrame:
        return stage(provisional_macd(self.run.candle_ema, self.candle_ema(), self.d))

    def macd(self) -> DataFrame:
        return self._macd

    def trend(self) -> DataFrame:
        return swing_trend(self.run.candles, self.candles(), self.d)

    def candle_comparison(self) -> DataFrame:
        return views.compare_recent(self.run.candles, self.candles(), ["open", "close"], self.d)

    def macd_comparison(self) -> DataFrame:
        return views.compare_recent(self.run.macd, self.macd(), ["diff", "dea"], self.d)

    def all_candles(self) -> DataFrame:
        cols = ("code", "load_date", "open", "high", "low", "close")
        return overlay(self.run.candles.select(*cols), self.candles().select(*cols), "load_date", self.day)

    def stop_marks(self, rising: str = "+", falling: str = "-") -> Column:
        """Trend sign before and after today's range: '-+' is a falling stop that was crossed."""
        down, up = F.col("ud_trend") == "down", F.col("ud_trend") == "up"
        return (
            F.when(down & (F.col("n_sar") <= F.col("high")), falling + rising)
            .when(down & (F.col("n_sar") > F.col("high")), falling * 2)
            .when(up & (F.col("n_sar") > F.col("low")), rising + falling)
            .when(up & (F.col("n_sar") <= F.col("low")), rising * 2)
            .otherwise("")
        )

    def report(self, side: str, most: int = 40, per_category: int = 4) -> DataFrame:
        """The best of the full list with every provisional signal."""
        run = self.run
        listed = run.full_list(side).where((F.col("total_ranking") <= most) & (F.col("category_ranking") <= per_category))
        out = listed.join(self.bars.select("code", "load_date", "high", "low"), "code")
        parts = [
            self.ema().select("code", "price", F.when(F.col("ema15") >= F.col("ema40"), "BUY").otherwise("SELL").alias("option")),
            views.candle_sequence(self.all_candles()).select("code", "status", "sequence"),
            views.sar_current(run.sar).drop("load_date"),
            short_text(run.breaks),
            run.announcement_age,
        ]
        out = out.join(self.index_report().drop("load_date"), "category", "left")
        for p in parts:
            out = out.join(p, "code", "left")
        return out.select(
            joined(F.col("category"), "(", F.col("daily_perf"), ",", F.col("ema"), ",", F.col("ha"), ")").alias("category"),
            joined(F.col("code"), "(", F.date_format("last_update_date", "MM-dd"), ")").alias("code"),
            joined(F.col("total_ranking"), "(", F.col("category_ranking"), ")").alias("ranking"),
            F.col("price").alias("current_price"),
            "option",
            joined(F.col("status"), "(", F.col("sequence"), ")").alias("status"),
            self.stop_marks().alias("sar"),
            "short_indicator",
            "last_anc",
            "load_date",
        )

    def conversion_report(self, side: str, most: int = 40, per_category: int = 4) -> DataFrame:
        """Listed codes whose candle or mean convergence turned today; BOTH, HA or MACD per kind of turn."""
        run, c = self.run, F.col
        rising = side == "long_end"
        listed = run.full_list(side).where((F.col("total_ranking") <= most) & (F.col("category_ranking") <= per_category))
        signs = self.index().select(
            "category",
            F.when(c("h_close") >= c("h_open"), "+").otherwise("-").alias("index_ha"),
            F.when(c("ema10") >= c("ema25"), "+").otherwise("-").alias("index_ema"),
        )
        rows = listed.join(self.bars.select("code", "high", "low"), "code").join(signs, "category")
        rows = rows.join(self.macd_comparison().drop("load_date"), "code").join(self.candle_comparison().drop("load_date"), "code").join(run.breaks, "code")

        def above(a: Column, b: Column) -> Column:
            return a >= b if rising else a < b

        gap = {k: c(f"{k}_diff") - c(f"{k}_dea") for k in ("current", "last", "previous")}
        close = {k: c(f"{k}_close") for k in gap}
        open_ = {k: c(f"{k}_open") for k in gap}
        macd_turn = above(c("current_diff"), c("current_dea")) & ~above(c("last_diff"), c("last_dea"))
        macd_trend = above(gap["current"], gap["last"]) & above(gap["last"], gap["previous"])
        macd_edge = above(gap["current"], gap["last"]) & ~above(gap["last"], gap["previous"])
        ha_turn = above(close["current"], open_["current"]) & ~above(close["last"], open_["last"])
        steps = (close["previous"] < close["last"]) & (close["last"] < close["current"]) if rising else (close["previous"] >= close["last"]) & (close["last"] >= close["current"])
        ha_trend = steps & (~above(close["previous"], open_["previous"]) | ~above(close["last"], open_["last"])) & above(close["current"], open_["current"])
        ha_edge = above(close["current"], close["last"]) & ~above(close["last"], close["previous"])
        place = F.row_number().over(W.partitionBy("category").orderBy("category_ranking"))
        flagged = rows.withColumns(
            {n: F.coalesce(x, F.lit(False)) for n, x in (("mt", macd_turn), ("mr", macd_trend), ("me", macd_edge), ("ht", ha_turn), ("hr", ha_trend), ("he", ha_edge))}
        ).where("ht OR mt")
        out = flagged.withColumn("_p", place).join(views.sar_current(run.sar).drop("load_date"), "code", "left")
        out = out.join(run.announcement_age, "code", "left")
        return out.select(
            joined(c("category"), "(", c("index_ha"), ",", c("index_ema"), ")").alias("category"),
            joined(c("code"), "(", F.date_format("last_update_date", "MM-dd"), ")").alias("code"),
            joined(c("_p"), "(", c("category_ranking"), ", ", c("total_ranking"), ")").alias("ranking"),
            views.flags_text(c("ht"), c("mt")).alias("conversion_type"),
            views.flags_text(c("hr"), c("mr")).alias("trend_type"),
            views.flags_text(c("he"), c("me")).alias("edge_type"),
            joined(c("nearest_break"), "(", c("nearest_distance"), ")/", c("previous_break"), "(", c("previous_distance"), ")").alias("short_indicator"),
            # The report's rising and falling marks.
            self.stop_marks(chr(1784), chr(1783)).alias("sar"),
            "last_anc",
        )
