"""Cap-weighted category indices with smoothed candles and weighted means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeline.functions.numeric import dec, ratio
from tapeline.functions.series import EMA15, EMA40, weighted_last
from tapeline.operators.aggregates import with_total
from tapeline.operators.folds import smoothed_candles
from tapeline.operators.joins import densify, fill_from_next
from tapeline.plans.daily import DateLike, as_date

PRICES = ("open", "low", "high", "close", "typ3", "typ4")


def index_components(bars: DataFrame, d: DateLike, days: int = 40, min_rows: int = 36, top: int = 300) -> DataFrame:
    """Prices of the largest codes over the last days, rebased to today's close, with cap weights (%).

    A code needs `min_rows` rows in the period and a row today. Days without open and
    close take the next bar of the code that has both.
    """
    day = as_date(d)
    upto = bars.where(F.col("load_date") <= day)
    newest = upto.select("load_date").distinct().orderBy(F.desc("load_date")).limit(days)
    period = upto.join(newest, "load_date", "left_semi")
    steady = period.groupBy("code").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_rows)
    today = period.where(F.col("load_date") == day).join(steady, "code", "left_semi")
    largest = today.orderBy(F.desc("market_cap"), "code").limit(top).select("code", F.col("close").alias("match_price"), "market_cap")
    total = largest.agg(F.sum("market_cap")).scalar()
    weights = largest.select("code", "match_price", dec(ratio(F.col("market_cap"), total) * 100, 4, 9).alias("weight_ratio"))
    cols = [*PRICES, "volume", "turnover", "market_cap"]
    grid = densify(weights.select("code"), newest, "load_date").join(period.select("code", "load_date", *cols), ["code", "load_date"], "left")
    has_open, has_close = F.col("open").isNotNull(), F.col("close").isNotNull()
    whole = fill_from_next(grid, "code", "load_date", cols, has_open & has_close, ~has_open & ~has_close)
    out = whole.join(weights, "code")
    return out.select(
        "code",
        "load_date",
        *[dec(ratio(F.col(c), F.col("match_price")), 3, 12).alias(c) for c in PRICES],
        dec(ratio(F.col("turnover"), F.col("match_price")), 3, 24).alias("turnover"),
        "volume",
        "market_cap",
        "match_price",
        "weight_ratio",
    )


def index_bars(components: DataFrame, cats: DataFrame) -> DataFrame:
    """Weighted open, low, high, close per category and day."""
    rows = components.join(cats, "code")
    return rows.groupBy("category", "load_date").agg(
        F.count("*").alias("codes_count"),
        *[dec(F.sum(F.col(c) * F.col("weight_ratio")), 3, 12).alias(c) for c in ("open", "low", "high", "close")],
    )


def index_direction(components: DataFrame, cats: DataFrame, days: int = 40, label: str = "ASX300") -> DataFrame:
    """Newest index row per category, plus a total row, as ratios to the previous close.

    s_ columns are the index, h_ columns its smoothed candles; ema25 and ema10 are the 40- and
    15-term weighted means. A category needs all `days` rows.
    """
    base = index_bars(components, cats)
    w = W.partitionBy("category").orderBy("load_date")
    candles = smoothed_candles(base, key="category").select(
        "category", "load_date", *[F.col(c).alias(f"h_{c}") for c in ("open", "close", "high", "low")]
    )
    rows = base.join(candles, ["category", "load_date"]).select(
        "category",
        "load_date",
        F.row_number().over(w).alias("_n"),
        F.lag("close").over(w).alias("s_close_p"),
        F.lag("h_close").over(w).alias("h_close_p"),
        *[F.col(c).alias(f"s_{c}") for c in ("open", "close", "high", "low")],
        *[f"h_{c}" for c in ("open", "close", "high", "low")],
        weighted_last(F.col("close"), w, EMA40).cast("decimal(30,12)").alias("ema25"),
        weighted_last(F.col("close"), w, EMA15).cast("decimal(30,12)").alias("ema10"),
    )
    newest = rows.where(F.col("_n") == days).drop("_n")
    measures = [c for c in newest.columns if c not in ("category", "load_date")]
    # No total without a category.
    both = with_total(newest, "category", label, measures, "load_date").where("load_date IS NOT NULL")

    def over(prefix: str, names: list[str]) -> list[Column]:
        return [dec(ratio(F.col(n), F.col(f"{prefix}_close_p")), 3, 12).alias(n) for n in names]

    sides = ("open", "close", "high", "low")
    return both.select(
        "category", "load_date", *over("s", [f"s_{c}" for c in sides]), *over("h", [f"h_{c}" for c in sides]), *over("s", ["ema25", "ema10"])
    )


def index_flags(current: DataFrame, previous: DataFrame, drop: str = "Unclassified") -> DataFrame:
    """Plus and minus signs per category: daily move, candles (last, current), means (last, current)."""

    def sign(a: Column, b: Column) -> Column:
        return F.when(a >= b, "+").otherwise("-")

    c, p = current.alias("c"), previous.alias("p")
    out = c.join(p, F.col("c.category") == F.col("p.category"), "left")
    return out.where(F.col("c.category") != drop).select(
        "c.category",
        "c.load_date",
        sign(F.col("c.s_close"), F.col("p.s_close")).alias("daily_perf"),
        F.concat(sign(F.col("p.h_close"), F.col("p.h_open")), sign(F.col("c.h_close"), F.col("c.h_open"))).alias("ha"),
        F.concat(sign(F.col("p.ema10"), F.col("p.ema25")), sign(F.col("c.ema10"), F.col("c.ema25"))).alias("ema"),
    )


def provisional_components(snapshot: DataFrame, today: DataFrame, d: DateLike) -> DataFrame:
    """Component snapshot with provisional bars of d added and its oldest day dropped.

    A code without a provisional bar keeps its last rebased close.
    """
    newest, oldest = (snapshot.agg(f("load_date")).scalar() for f in (F.max, F.min))
    last = snapshot.where(F.col("load_date") == newest)
    live = today.select("code", *[F.col(c).alias(f"r_{c}") for c in ("open", "low", "high", "close")])
    filled = last.join(live, "code", "left").select(
        "code",
        as_date(d).alias("load_date"),
        *[F.coalesce(dec(ratio(F.col(f"r_{c}"), F.col("match_price")), 3, 12), F.col("close")).alias(c) for c in ("open", "low", "high", "close")],
        "match_price",
        "weight_ratio",
    )
    return filled.unionByName(snapshot.where(F.col("load_date") != oldest).select(*filled.columns))
