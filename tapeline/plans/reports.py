"""The end-of-day run and the reports built on it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeline.functions.numeric import dec, ratio
from tapeline.functions.text import joined, or_null_text
from tapeline.operators.folds import parabolic_sar, parabolic_sars, smoothed_candles
from tapeline.operators.joins import compare_lists
from tapeline.operators.tables import backup_snapshot, insert_ignore, overwrite_snapshot
from tapeline.plans import daily, market_index, rankings, views
from tapeline.plans.daily import DateLike, as_date
from tapeline.staging import stage


@dataclass(frozen=True)
class Settings:
    """Gates of a run; the defaults suit a full market, small panels need lower ones."""

    min_share: float = 0.95
    popularity: str | tuple = "wide"
    turnover_cuts: tuple[int, int, int] = (100, 200, 500)
    index_days: int = 40
    index_min_rows: int = 36
    index_top: int = 300
    index_label: str = "ASX300"
    semester_rows: int = 115
    quarter_rows: int = 60
    semester_steady: tuple[int, float] = (100, 25)
    quarter_steady: tuple[int, float] = (50, 10)
    direction_share: float = 0.65
    direction_flips: int = 1


class DailyRun:
    """All end-of-day tables up to d. Each is computed on first use and written once."""

    def __init__(
        self,
        bars: DataFrame,
        categorise: Callable[[DataFrame], DataFrame],
        d: DateLike,
        settings: Settings = Settings(),
        shorts: DataFrame | None = None,
        announcements: DataFrame | None = None,
        analysis: DataFrame | None = None,
        later: DailyRun | None = None,
    ):
        self._later = later
        self.d, self.day, self.settings = d, as_date(d), settings
        self._bars, self._categorise = bars, categorise
        self.shorts, self.announcements, self._analysis = shorts, announcements, analysis
        self._lookbacks: dict[tuple[str, str], DataFrame] = {}
        self._full_lists: dict[str, DataFrame] = {}
        self._rankings: dict[tuple[str, str, str], DataFrame] = {}
        self._steady: dict[str, DataFrame] = {}
        self._direction_lists: dict[str, DataFrame] = {}

    def day_before(self) -> DailyRun:
        """The run of the previous trading day; what each row has from earlier days only is taken from this run.

        On the first day there is none before it: the run of the calendar day before has no rows.
        """
        before = self.bars.where(F.col("load_date") < self.day)
        last = before.agg(F.coalesce(F.max("load_date"), F.date_sub(self.day, 1))).first()[0]
        return DailyRun(self._bars, self._categorise, str(last), self.settings, self.shorts, self.announcements, self._analysis, self)

    def _up_to(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A frame of which each row depends on earlier days only: that of the later run, cut at this day."""
        if self._later is not None:
            return getattr(self._later, name).where(F.col("load_date") <= self.day)
        return stage(make())

    @cached_property
    def bars(self) -> DataFrame:
        return self._up_to("bars", lambda: self._bars.where(F.col("load_date") <= self.day))

    @cached_property
    def cats(self) -> DataFrame:
        return self._categorise(self.bars)

    @cached_property
    def days(self) -> DataFrame:
        return daily.calendar(self.bars)

    @cached_property
    def actionable(self) -> DataFrame:
        s = self.settings
        return self._up_to("actionable", lambda: daily.actionable_list(self.bars, None, turnover_cuts=s.turnover_cuts, style=s.popularity))

    @cached_property
    def candles(self) -> DataFrame:
        return self._up_to("candles", lambda: smoothed_candles(self.bars))

    @cached_property
    def ema(self) -> DataFrame:
        return self._up_to("ema", lambda: daily.moving_averages(self.bars))

    @cached_property
    def candle_ema(self) -> DataFrame:
        return self._up_to("candle_ema", lambda: daily.moving_averages(self.candles))

    @cached_property
    def macd(self) -> DataFrame:
        return self._up_to("macd", lambda: daily.macd(self.candle_ema))

    @cached_property
    def trend(self) -> DataFrame:
        return self._up_to("trend", lambda: daily.ema_trend(self.ema))

    @cached_property
    def sar(self) -> DataFrame:
        return self._up_to("sar", lambda: parabolic_sar(self.bars))

    @cached_property
    def sar_pair(self) -> DataFrame:
        def both() -> DataFrame:
            stops = parabolic_sars(self.bars, {"2": (0.02, 0.2), "3": (0.03, 0.3)})
            return stops.select("code", "load_date", "ud_trend2", "n_sar2", "ud_trend3", "n_sar3")

        return self._up_to("sar_pair", both)

    @cached_property
    def volume(self) -> DataFrame:
        return daily.volume_bands(self.bars, self.d)

    @cached_property
    def ranges(self) -> DataFrame:
        return daily.moving_range(self.bars, self.d)

    @cached_property
    def components(self) -> DataFrame:
        s = self.settings
        return stage(market_index.index_components(self.bars, self.d, s.index_days, s.index_min_rows, s.index_top))

    @cached_property
    def index(self) -> DataFrame:
        return stage(market_index.index_direction(self.components, self.cats, self.settings.index_days, self.settings.index_label))

    @cached_property
    def analysis(self) -> DataFrame:
        return views.analysis_current(self._analysis, self.cats, self.d)

    def state(self, family: str) -> DataFrame:
        return rankings.candle_state(self.candles) if family == "ha" else rankings.sar_state(self.sar)

    @cached_property
    def trading(self) -> DataFrame:
        return stage(rankings.trading_days_series(self.bars, self.d))

    def lookback(self, family: str, side: str) -> DataFrame:
        key = (family, side)
        if key not in self._lookbacks:
            rows = rankings.lookback_window(self.state(family), self.trading, self.d, side, self.settings.min_share)
            self._lookbacks[key] = stage(rows)
        return self._lookbacks[key]

    def ranking(self, measure: str, family: str, side: str) -> DataFrame:
        """measure: 'ema', 'state' or 'stb'; family: 'ha' or 'sar'; side: 'long_end' or 'short_end'.

        Those that the current lists rest on too are written once.
        """
        rows = self.lookback(family, side)
        if measure not in ("ema", "stb"):
            return rankings.state_share_ranking(rows, side)
        key = (measure, family, side)
        if key not in self._rankings:
            ranked = rankings.trend_share_ranking(rows, self.trend, side) if measure == "ema" else rankings.stability_ranking(rows, self.bars, side)
            self._rankings[key] = stage(ranked)
        return self._rankings[key]

    def current(self, measure: str, family: str, side: str) -> DataFrame:
        """Steady-mean rankings are best when large on the long side, distances the other way round."""
        descending = (measure == "ema") == (side == "long_end")
        if measure == "stb":
            descending = side == "short_end"
        return rankings.current_ranking(self.ranking(measure, family, side), self.actionable, self.cats, self.d, side, descending)

    def full_list(self, side: str) -> DataFrame:
        """One row per listed code; written once, as several reports and snapshots rest on it."""
        if side not in self._full_lists:
            pairs = [("ema", "ha"), ("ema", "sar"), ("stb", "ha"), ("stb", "sar")]
            self._full_lists[side] = stage(rankings.full_list([self.current(m, f, side) for m, f in pairs]))
        return self._full_lists[side]

    @cached_property
    def breaks(self) -> DataFrame:
        """The newest two short breaks of each code."""
        return stage(views.short_current(views.short_breaks(self.bars, self.shorts, self.days)))

    @cached_property
    def announcement_age(self) -> DataFrame:
        return stage(views.announcement_age(self.announcements, self.days, self.d))

    def steady(self, span: str) -> DataFrame:
        """Written once, as the daily long list rests on it too."""
        if span not in self._steady:
            s = self.settings
            months, (rows, below) = (6, s.semester_steady) if span == "semester" else (3, s.quarter_steady)
            self._steady[span] = stage(rankings.trend_stability_list(self.bars, self.actionable, self.cats, self.d, months, rows, below))
        return self._steady[span]

    def directions(self, span: str) -> DataFrame:
        s = self.settings
        months, rows = (6, s.semester_rows) if span == "semester" else (3, s.quarter_rows)
        return rankings.trend_direction(self.sar_pair, self.ema, self.actionable, self.cats, self.d, months, rows, above=s.direction_share)

    def direction_list(self, span: str) -> DataFrame:
        """Written once, as the daily long list rests on it too."""
        if span not in self._direction_lists:
            self._direction_lists[span] = stage(rankings.trend_direction_list(self.directions(span), self.d, min_flips=self.settings.direction_flips))
        return self._direction_lists[span]

    def outputs(self) -> dict[str, Callable[[], DataFrame]]:
        """Tables of the run in order; the volume bands are written once."""
        day = F.col("load_date") == self.day

        def both(measure: str, family: str) -> DataFrame:
            a, b = (self.ranking(measure, family, side) for side in rankings.SIDES)
            return a.unionByName(b)

        return {
            "actionable_list": lambda: self.actionable.where(day),
            "volume_bands": lambda: self.volume,
            "trading_days": lambda: daily.trading_days(self.bars, self.d),
            "heikin_ashi": lambda: self.candles.where(day),
            "simple_moving_range": lambda: self.ranges,
            "ema": lambda: self.ema.where(day),
            "ema_trend": lambda: self.trend.where(day),
            "sar": lambda: self.sar.where(day),
            "index_direction": lambda: self.index.withColumnRenamed("category", "code"),
            "ema_on_ha_ranking": lambda: both("ema", "ha"),
            "ema_on_sar_ranking": lambda: both("ema", "sar"),
            "ha_ranking": lambda: both("state", "ha"),
            "sar_ranking": lambda: both("state", "sar"),
            "stb_on_ha_ranking": lambda: both("stb", "ha"),
            "stb_on_sar_ranking": lambda: both("stb", "sar"),
            "ha_ema": lambda: self.candle_ema.where(day),
            "macd": lambda: self.macd.where(day),
        }

    def write(self, spark: SparkSession, root: str) -> None:
        """Insert every output into its table; running a day twice adds nothing."""
        for name, make in self.outputs().items():
            keys = ["load_date"] if name == "trading_days" else ["code", "load_date"]
            if name.endswith("_ranking"):
                keys.append("usage_direction")
            insert_ignore(spark, f"{root}/{name}", make(), keys, by="load_date")
        overwrite_snapshot(self.components, f"{root}/index_component_snapshot")
        self.components.write.mode("append").parquet(f"{root}/index_component_history")
        insert_ignore(
            spark, f"{root}/index_component", self.components.where(F.col("load_date") == self.day).select("code", "load_date"), ["code", "load_date"]
        )

    def backup(self, root: str, stamp: Column | None = None) -> None:
        """Append the ten current lists with the snapshot time."""
        for side, word in zip(rankings.SIDES, ("long", "short"), strict=True):
            for m in ("ema", "stb"):
                for f in ("ha", "sar"):
                    backup_snapshot(self.current(m, f, side), f"{root}/{m}_on_{f}_{word}_snapshot", stamp)
            backup_snapshot(self.full_list(side), f"{root}/full_{word}_snapshot", stamp)

    def row_counts(self) -> DataFrame:
        """Rows each table of the run receives."""
        out = None
        for name, make in self.outputs().items():
            one = make().agg(F.lit(name).alias("table_name"), F.count("*").alias("rows"))
            out = one if out is None else out.unionByName(one)
        return out


def pct(c: Column, scale: int = 2) -> Column:
    return joined(dec(c, scale, 9), "%")


def scaled_score(c: Column, start: float, span: float) -> Column:
    """(c - start) / span * 100 as a whole number; 0 where missing or on the wrong side of start."""
    x = (c.cast("double") - F.lit(float(start))) / F.lit(float(span)) * 100
    return F.when(c.isNull() | (x < 0), F.lit(0)).otherwise(F.round(x).cast("int"))


def daily_long_list(run: DailyRun) -> DataFrame:
    """Codes that are steady and directed over three or six months, with four scores of 0 to 100.

    Only codes whose older of the two newest stop reversals to down is not after the direction
    was last confirmed.
    """
    q, s = run.direction_list("quarter"), run.direction_list("semester")
    qs, ss = run.steady("quarter"), run.steady("semester")
    cols = {
        "qd": q.select("code", F.col("recent_calculation_date").alias("qd_date"), F.col("trend").alias("qd_trend")),
        "sd": s.select("code", F.col("recent_calculation_date").alias("sd_date"), F.col("trend").alias("sd_trend")),
        "qs": qs.select("code", F.col("ratio").alias("qs_ratio")),
        "ss": ss.select("code", F.col("ratio").alias("ss_ratio")),
    }
    both = cols["qd"]
    for other in ("sd", "qs", "ss"):
        both = both.join(cols[other], "code", "full")
    both = both.where("(qs_ratio IS NOT NULL OR ss_ratio IS NOT NULL) AND (qd_trend IS NOT NULL OR sd_trend IS NOT NULL)")
    w = W.partitionBy("code").orderBy("load_date")

    def newest_fall(c: str) -> Column:
        return F.max(F.when(F.col(f"_{c}"), F.col("load_date")))

    falls = run.sar_pair.select(
        "code", "load_date", *[((F.lag(c).over(w) != F.col(c)) & (F.col(c) == "down")).alias(f"_{c}") for c in ("ud_trend2", "ud_trend3")]
    )
    recent = falls.groupBy("code").agg(newest_fall("ud_trend2").alias("_a"), newest_fall("ud_trend3").alias("_b"))
    recent = recent.where("_a IS NOT NULL AND _b IS NOT NULL").select("code", F.least("_a", "_b").alias("recent_date"))
    listed = both.join(recent, "code").where(F.col("recent_date") <= F.greatest("qd_date", "sd_date"))
    least, (_, half_year), (_, quarter) = run.settings.direction_share, run.settings.semester_steady, run.settings.quarter_steady
    return listed.join(run.cats, "code").select(
        "category",
        "code",
        run.day.alias("load_date"),
        scaled_score(F.col("qd_trend"), least, 1 - least).alias("quarterly_direction"),
        scaled_score(F.col("sd_trend"), least, 1 - least).alias("semester_direction"),
        scaled_score(-F.col("qs_ratio"), -quarter, quarter).alias("quarterly_stability"),
        scaled_score(-F.col("ss_ratio"), -half_year, half_year).alias("semester_stability"),
    )


def daily_summary(run: DailyRun, long_list: DataFrame, max_age: int = 6) -> DataFrame:
    """Summary of the listed codes: mean gap, stop buffer, trend text, fundamentals."""
    recent = long_list.join(run.days.where(F.col("rnum") < max_age).select("load_date"), "load_date", "left_semi")
    rows = views.newest(recent).where("quarterly_direction <> 0 OR semester_direction <> 0")
    today_ema, today_sar = views.at_newest(run.ema), views.at_newest(run.sar_pair)
    out = rows.withColumnRenamed("load_date", "report_date").join(run.analysis.select("code", "rec", "financial_healthy", "pe_ranking"), "code", "left")
    out = out.join(today_ema.drop("load_date"), "code").join(today_sar.drop("load_date"), "code")

    def buffer(c: str) -> Column:
        return dec((ratio(F.col(c), F.col("price")) - 1) * 100, 2, 9)

    down2, down3 = F.col("ud_trend2") == "down", F.col("ud_trend3") == "down"
    sar_buff = (
        F.when(down2 & down3, joined(F.least(buffer("n_sar2"), buffer("n_sar3")), "%"))
        .when(down2, joined(buffer("n_sar2"), "%"))
        .when(down3, joined(buffer("n_sar3"), "%"))
    )
    direction = joined(F.col("quarterly_direction"), "~", F.col("semester_direction"))
    stability = joined(F.col("quarterly_stability"), "~", F.col("semester_stability"))
    return out.select(
        "category",
        "code",
        "report_date",
        "price",
        pct((ratio(F.col("price"), F.col("ema40")) - 1) * 100).alias("ema25"),
        sar_buff.alias("sar_buff"),
        joined("(", direction, "),(", stability, ")").alias("trend"),
        "rec",
        "financial_healthy",
        "pe_ranking",
    )


def daily_mail(today: DataFrame, previous: DataFrame, ranges: DataFrame) -> DataFrame:
    """Newest summary as text: new rows and rows near their stop are watch points; watch points first."""
    limit = F.col("avg_diff") + F.col("std_diff")
    seen = previous.select("code").distinct().withColumn("_seen", F.lit(True))
    rows = today.join(seen, "code", "left").join(ranges.select("code", "avg_diff", "std_diff"), "code")
    buffer = F.expr("substring(sar_buff, 1, length(sar_buff) - 1)").cast("double")
    watch = F.col("_seen").isNull() | F.coalesce(buffer < limit, F.lit(False))
    sar = F.when(F.col("sar_buff").isNotNull(), joined(F.col("sar_buff"), "~", dec(limit, 2, 9), "%"))
    shaped = rows.select(
        "category", "code", "price", "ema25", sar.alias("sar_buff"), "trend", "rec", "financial_healthy", "pe_ranking", watch.alias("watch_point"), buffer.alias("_b")
    )
    text = shaped.select(*[or_null_text(F.col(c)).alias(c) for c in shaped.columns if c != "_b"], "_b")
    return text.orderBy(F.desc("watch_point"), "category", F.asc_nulls_last("_b")).drop("_b")


def summary_report(run: DailyRun, side: str, today: DataFrame, last: DataFrame) -> DataFrame:
    """One row per code on today's or the last list, with every current signal as text."""
    lists = compare_lists(today, last, "code", ["category"], ["total_ranking", "category_ranking"])
    marks = run.index.where(F.col("category") != "Unclassified").select(
        "category",
        F.when(F.col("s_open") <= F.col("s_close"), "-").otherwise("+").alias("c_direction"),
        F.when(F.col("h_open") <= F.col("h_close"), "+").otherwise("-").alias("c_status"),
        F.when(F.col("ema25") <= F.col("ema10"), "+").otherwise("-").alias("c_option"),
    )
    on_day = F.col("load_date") == run.day
    ema = views.ema_current(run.ema.where(on_day)).select("code", "price", "indicator")
    ha = views.candle_sequence(run.candles, run.days).select("code", "status", "sequence")
    vol = views.volume_current(run.volume).select("code", joined(F.col("range"), "(", F.col("ratio"), ")").alias("volume"))
    short = short_text(run.breaks)
    moving = run.ranges.select(
        "code",
        joined(
            dec(F.col("avg_diff") + F.col("std_diff") * 1.28, 2, 9), "(", dec(F.col("avg_range") + F.col("std_range") * 1.28, 2, 9), ")"
        ).alias("daily_range"),
    )
    age = run.announcement_age
    sar = views.sar_current(run.sar).select(
        "code", F.when(F.col("ud_trend") == "up", "+").when(F.col("ud_trend") == "down", "-").otherwise("").alias("_sar"), "n_sar"
    )
    out = lists.join(marks, "category", "left")
    for part in (ema, ha, vol, short, moving, age, sar):
        out = out.join(part, "code", "left")
    gap = ratio(F.col("n_sar"), F.col("price"))
    below = (F.lit(1.0) - gap) * 100 if side == "long_end" else (gap - 1) * 100
    stop = F.when(F.col("_sar") == "-", dec(below, 3, 9)).when(F.col("_sar") == "+", dec((gap - 1) * 100, 3, 9))
    return out.select(
        joined(F.col("category"), "(", F.col("c_option"), ", ", F.col("c_status"), ",", F.col("c_direction"), ")").alias("category"),
        "code",
        "price",
        joined(F.col("total_ranking"), "(", F.col("category_ranking"), ")/", F.col("last_total_ranking"), "(", F.col("last_category_ranking"), ")").alias("ranking"),
        F.col("indicator").alias("option"),
        "status",
        F.col("sequence").alias("trend"),
        "volume",
        "daily_range",
        "short_indicator",
        joined(F.col("_sar"), "(", stop, "%)").alias("sar"),
        "last_anc",
        F.col("total_ranking").alias("rnum"),
        F.col("category_ranking").alias("cnum"),
    )


def short_text(current: DataFrame) -> DataFrame:
    return current.select(
        "code",
        joined(F.col("nearest_break"), "(", F.col("nearest_distance"), ")/", F.col("previous_break"), "(", F.col("previous_distance"), ")").alias("short_indicator"),
    )


def summary_page(report: DataFrame, most: int = 70, per_category: int = 6) -> DataFrame:
    return report.where((F.col("rnum") <= most) & (F.col("cnum") <= per_category)).drop("rnum", "cnum")
