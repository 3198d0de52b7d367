"""Market-wide indicators: one row per date, so windows over the dates run in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeline.functions import series
from tapeline.functions.numeric import dec, ratio, sigmoid, squash
from tapeline.operators.joins import attach_scalar
from tapeline.plans.features import MEDIAN_PLACE, SPANS, span_pairs
from tapeline.staging import stage

GROUPS = {"full": "f", "pe": "p", "volume": "v"}
MEASURES = {"trading_strength": "ts", "short_size": "ss", "active_ts": "at", "over_value": "ov"}
# Short names: fts = full trading strength, pss = top-earnings short size, ...
SERIES = {f"{g}{m}": f"{group}_{measure}" for group, g in GROUPS.items() for measure, m in MEASURES.items()}


def market_sums(tx: DataFrame, cap: int = 50) -> DataFrame:
    """Trading strength, short size, activity and over-valuation per date: all codes, top earnings, top turnover."""
    pe_order = F.desc(F.coalesce(F.col("forward_pe"), F.lit(0).cast("decimal(8,1)")))
    turnover = F.col("market_price") * F.col("market_volume").cast("decimal(14,0)")
    day = W.partitionBy("load_date")
    rows = tx.withColumns(
        {
            "_rank_pe": F.row_number().over(day.orderBy(pe_order, "code")),
            "_rank_volume": F.row_number().over(day.orderBy(F.desc(F.coalesce(turnover, F.lit(0).cast("decimal(26,3)"))), "code")),
        }
    ).where("market_price IS NOT NULL AND market_open IS NOT NULL AND market_volume IS NOT NULL AND short_position IS NOT NULL")
    volume = F.col("market_volume").cast("decimal(14,0)")
    terms = {
        "trading_strength": (F.col("market_price") - F.col("market_open")) * volume,
        "short_size": F.col("market_price") * F.col("short_position").cast("decimal(14,0)"),
        "turnover": turnover,
        "over_value": F.col("forward_pe") * volume,
    }
    inside = {"full": F.lit(True), "pe": F.col("_rank_pe") <= cap, "volume": F.col("_rank_volume") <= cap}

    def total(group: str, measure: str) -> Column:
        value = terms[measure] if group == "full" else F.when(inside[group], terms[measure]).otherwise(F.lit(0))
        return F.sum(value).cast("decimal(24,2)").cast("double").alias(f"{group}_{measure}")

    sums = rows.groupBy("load_date", "date_index").agg(
        F.count("*").alias("record_number"), *[total(g, m) for g in GROUPS for m in terms]
    )
    cols = []
    for g in GROUPS:
        cols += [
            F.col(f"{g}_trading_strength"),
            F.col(f"{g}_short_size"),
            ratio(F.col(f"{g}_turnover"), F.col(f"{g}_short_size")).alias(f"{g}_active_ts"),
            F.col(f"{g}_over_value"),
        ]
    return sums.select("load_date", "date_index", "record_number", *cols)


def market_indicators(tx: DataFrame, cap: int = 50) -> DataFrame:
    """The twelve sums scaled by (x - min) / (mean - min)."""
    sums = market_sums(tx, cap)
    names = list(SERIES.values())
    params = sums.agg(*[F.min(c).alias(f"min_{c}") for c in names], *[F.avg(c).alias(f"avg_{c}") for c in names])
    out = attach_scalar(sums, params, "_p")

    def scaled(c: str) -> Column:
        lo, mean = F.col(f"_p.min_{c}"), F.col(f"_p.avg_{c}")
        return (F.col(c) - lo) / F.nullif(mean - lo, F.lit(0.0))

    return out.select("load_date", "date_index", *[scaled(c).alias(c) for c in names])


def market_windows(indicators: DataFrame) -> DataFrame:
    """Mean, positional median and slope of each series over 3, 5, 10 and 20 gapless dates."""
    w = W.orderBy("date_index")
    rows = indicators.select(
        "load_date",
        "date_index",
        *[series.list_last(F.col(c), w, 20).alias(s) for s, c in SERIES.items()],
        F.lag("date_index", 19).over(w).alias("_first"),
    ).where("date_index - _first = 19")

    def values(s: str, n: int) -> Column:
        return series.newest_of(F.col(s), n)

    def rounded(s: str, n: int) -> Column:
        return F.transform(values(s, n), lambda x: F.round(x, 7))

    return rows.select(
        "load_date",
        "date_index",
        *[(series.total_of(values(s, n)) / n).alias(f"avg_{s}_{n:02d}") for s in SERIES for n in SPANS],
        *[F.get(F.array_sort(rounded(s, n)), F.lit(MEDIAN_PLACE[n] - 1)).alias(f"mdn_{s}_{n:02d}") for s in SERIES for n in SPANS],
        *[series.slope_of(rounded(s, n), n).alias(f"slope_{s}_{n:02d}") for s in SERIES for n in SPANS],
    )


def _scaled_slopes(windows: DataFrame) -> DataFrame:
    names = [f"slope_{s}_{n:02d}" for s in SERIES for n in SPANS]
    params = windows.agg(F.struct(*[x for c in names for x in (F.min(c).alias(f"min_{c}"), F.avg(c).alias(f"avg_{c}"))]).alias("p")).scalar()
    out = windows.withColumn("_p", params)

    def scaled(c: str) -> Column:
        lo, mean = F.col(f"_p.min_{c}"), F.col(f"_p.avg_{c}")
        return (F.col(c) - lo) / F.nullif(mean - lo, F.lit(0.0))

    return out.withColumns({c: scaled(c) for c in names}).drop("_p")


def _signed(c: Column) -> Column:
    return dec(squash(c, mode="signed"), 3, 5)


def _quotient(a: str, b: str) -> Column:
    one = F.lit(1).cast("decimal(5,3)")
    return F.when(F.col(b) == 0, one).otherwise(_signed(ratio(F.col(a), F.col(b))))


def market_features(indicators: DataFrame) -> DataFrame:
    """Means, medians and slopes of the twelve series, squashed, with quotients between spans."""
    rows = stage(_scaled_slopes(stage(market_windows(indicators))))
    kinds = ("avg", "mdn", "slope")
    values = [f"{k}_{s}_{n:02d}" for k in kinds for s in SERIES for n in SPANS]
    pairs = [p for k in kinds for s in SERIES for p in span_pairs(f"{k}_{s}", f"divided_{k}_{s}", SPANS)]
    return rows.select(
        "load_date", "date_index", *[_signed(F.col(v)).alias(v) for v in values], *[_quotient(a, b).alias(n) for n, a, b in pairs]
    )


def market_features_draft(indicators: DataFrame) -> DataFrame:
    """The older set: means and slopes per group, slope gaps between spans and between groups."""
    rows = stage(_scaled_slopes(stage(market_windows(indicators))))

    def gap(a: str, b: str) -> Column:
        return dec(sigmoid(F.col(a) - F.col(b)), 3, 5)

    cols: list[Column] = []
    for s in SERIES:
        g, m = s[0], s[1:]
        cols += [_signed(F.col(f"avg_{s}_{n:02d}")).alias(f"{g}_a_{m}_{n:02d}") for n in SPANS]
        cols += [_signed(F.col(f"slope_{s}_{n:02d}")).alias(f"{g}_s_{m}_{n:02d}") for n in SPANS]
        cols += [_quotient(a, b).alias(n) for n, a, b in span_pairs(f"avg_{s}", f"divided_{g}_avg_{m}", SPANS)]
        cols += [gap(a, b).alias(n) for n, a, b in span_pairs(f"slope_{s}", f"divided_{g}_s_{m}", SPANS)]
        if g != "f":
            cols += [gap(f"slope_{s}_{n:02d}", f"slope_f{m}_{n:02d}").alias(f"divided_{g}_f_s_{m}_{n:02d}") for n in SPANS]
    return rows.select("load_date", "date_index", *cols)
