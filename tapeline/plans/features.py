"""Per-code feature families for training sets.

Input is the wide transactions panel with an ascending `date_index`. A family computes raw
values and their cross-sectional ranks, then `scale_features` maps every column to (-1, 1):
(x - min) / (mean - min) over the whole frame, squashed. All per-code windows share one
partitioning and one sort order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, fields

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeline.functions import series
from tapeline.functions.numeric import clamped, dec, ratio, sigmoid, squash
from tapeline.functions.series import by, kth_smallest, lagged, last_rows, mean_strict
from tapeline.operators.joins import feature_join, forward_return
from tapeline.operators.rows import position_in_range
from tapeline.staging import stage

KEYS = ("code", "load_date", "date_index")
SPANS = (3, 5, 10, 20)
# Which of the sorted values counts as the median of a span.
MEDIAN_PLACE = {3: 2, 5: 3, 10: 5, 20: 10}
MISSING_PE, MISSING_RATIO = -999, -100

Pair = tuple[str, str, str]


def order() -> WindowSpec:
    return by("code", "date_index")


#: What tells the dates of a panel apart, and of a panel that holds several periods.
DATE, PERIOD_DATE = ("date_index",), ("period", "date_index")


def rank_on_date(key: Column, date: tuple[str, ...] = DATE) -> Column:
    """Place of a row among its date's codes."""
    return F.row_number().over(W.partitionBy(*date).orderBy(key, "code"))


def span_pairs(stem: str, out: str, spans: tuple[int, ...], style: str = "{:02d}") -> list[Pair]:
    """(out, long, short) names for every pair of spans, longest first."""
    down = sorted(spans, reverse=True)
    name = style.format
    return [
        (f"{out}_{name(a)}_{name(b)}", f"{stem}_{name(a)}", f"{stem}_{name(b)}") for i, a in enumerate(down) for b in down[i + 1 :]
    ]


def scale_features(
    df: DataFrame, values: list[str], ratios: list[Pair] = (), diffs: list[Pair] = (), keys: tuple[str, ...] = KEYS, keep: Column | None = None
) -> DataFrame:
    """Scale and squash; the parameters are measured on all rows, those that `keep` holds for are returned.

    values: scaled columns. ratios: squashed quotient of two scaled columns, 1 where the
    divisor is 0. diffs: difference of two raw columns, scaled by its own minimum and mean,
    1 where those are equal. The parameters are one row, read by a scalar subquery.
    """
    raw = stage(df)
    gaps = {name: F.col(a).cast("double") - F.col(b).cast("double") for name, a, b in diffs}
    measured = {v: F.col(v).cast("double") for v in values} | gaps
    params = raw.agg(F.struct(*[x for n, c in measured.items() for x in (F.min(c).alias(f"min_{n}"), F.avg(c).alias(f"avg_{n}"))]).alias("p")).scalar()

    def scaled(n: str) -> Column:
        lo, mean = F.col(f"_p.min_{n}"), F.col(f"_p.avg_{n}")
        return (measured[n] - lo) / F.nullif(mean - lo, F.lit(0.0))

    # Dividing columns get a name first, so that no expression is written out twice.
    named = (raw if keep is None else raw.where(keep)).withColumn("_p", params).withColumns({f"_{v}": scaled(v) for v in values})

    def quotient(a: str, b: str) -> Column:
        return F.when(F.col(f"_{b}") == 0, F.lit(1).cast("decimal(5,3)")).otherwise(
            dec(squash(F.col(f"_{a}") / F.nullif(F.col(f"_{b}"), F.lit(0.0)), mode="signed"), 3, 5)
        )

    def gap(n: str) -> Column:
        flat = F.col(f"_p.min_{n}") == F.col(f"_p.avg_{n}")
        return F.when(flat, F.lit(1).cast("decimal(5,3)")).otherwise(dec(squash(scaled(n), mode="signed"), 3, 5))

    return named.select(
        *keys,
        *[dec(squash(F.col(f"_{v}"), mode="signed"), 3, 5).alias(v) for v in values],
        *[quotient(a, b).alias(n) for n, a, b in ratios],
        *[gap(n).alias(n) for n in gaps],
    )


def increase_ratio(tx: DataFrame, base: str = "market_open", date: tuple[str, ...] = DATE) -> DataFrame:
    """Daily change in percent against `base` (-100 without a base) and its rank on the date."""
    rows = tx.select(*dict.fromkeys((*KEYS, *date)), change_against(base).alias("irv"))
    return rows.withColumn("irr", rank_on_date(F.desc("irv"), date).cast("decimal(18,6)"))


def change_against(base: str) -> Column:
    """Daily change in percent against `base`, -100 without a base."""
    price, start = F.col("market_price"), F.col(base)
    return F.when(start > 0, dec(ratio((price - start) * 100, start), 6)).otherwise(F.lit(MISSING_RATIO).cast("decimal(18,6)"))


@dataclass
class Levels:
    """Columns of a family, level upon level. A level may name columns of the ones before it.

    Levels of several families are merged, so that all their windows of one level share a pass: whatever the families, the
    rows are dealt out by date, by code and by date again.
    """

    row: dict[str, Column] = field(default_factory=dict)
    date: dict[str, Column] = field(default_factory=dict)
    code: dict[str, Column] = field(default_factory=dict)
    row2: dict[str, Column] = field(default_factory=dict)
    code2: dict[str, Column] = field(default_factory=dict)
    row3: dict[str, Column] = field(default_factory=dict)
    code3: dict[str, Column] = field(default_factory=dict)
    out: dict[str, Column] = field(default_factory=dict)
    place: dict[str, Column] = field(default_factory=dict)


def add_levels(tx: DataFrame, *families: Levels) -> DataFrame:
    """`tx` with the columns of all families, from one scan and three shuffles of it."""
    for level in fields(Levels):
        merged: dict[str, Column] = {}
        for one in families:
            own = getattr(one, level.name)
            if clash := merged.keys() & own.keys():
                raise ValueError(f"two families make {sorted(clash)}")
            merged |= own
        if merged:
            tx = tx.withColumns(merged)
    return tx


def levels_ir() -> Levels:
    """Rolling means and positional medians of the change and of its rank, and their ranks."""
    w = order()
    cols = [(k, c, n) for k in ("avg", "mdn") for c in ("irv", "irr") for n in SPANS]

    def over(kind: str, c: str, n: int) -> Column:
        return mean_strict(F.col(c), w, n) if kind == "avg" else kth_smallest(F.col(c), w, n, MEDIAN_PLACE[n])

    def place(kind: str, c: str, n: int) -> Column:
        col = F.col(f"_{kind}_{c}_{n:02d}")
        if kind == "mdn":
            col = F.coalesce(col, F.lit(MISSING_RATIO).cast("decimal(18,6)"))
        return F.desc_nulls_first(col) if c == "irv" else F.asc_nulls_last(col)

    return Levels(
        row={"irv": change_against("market_open")},
        date={"irr": rank_on_date(F.desc("irv")).cast("decimal(18,6)")},
        code={f"_{k}_{c}_{n:02d}": over(k, c, n) for k, c, n in cols},
        out={f"{k}_{c}_vl_{n:02d}": dec(F.col(f"_{k}_{c}_{n:02d}"), 4, 12) for k, c, n in cols},
        place={f"{k}_{c}_rk_{n:02d}": rank_on_date(place(k, c, n)) for k, c, n in cols},
    )


def _ir_names() -> tuple[list[str], list[Pair], list[Pair]]:
    stems = [f"{k}_{c}" for k in ("avg", "mdn") for c in ("irv", "irr")]
    values = [f"{s}_{x}_{n:02d}" for s in stems for x in ("vl", "rk") for n in SPANS]
    ratios = [p for s in stems for p in span_pairs(f"{s}_vl", f"divided_{s}_vl", SPANS)]
    diffs = [p for s in stems for p in span_pairs(f"{s}_rk", f"diff_{s}_rk", SPANS)]
    return values, ratios, diffs


def _history(rows: DataFrame, col: str, n: int = 20) -> DataFrame:
    """Add the last n values (_h, NULL unless all are present) and their mean (_mean, NULL at 0)."""
    values = series.list_last(F.col(col).cast("double"), order(), n)
    wide = rows.withColumn("_h", values).withColumn("_h", F.when(F.size("_h") == n, F.col("_h")))
    return wide.withColumn("_mean", F.nullif(series.total_of(F.col("_h")) / n, F.lit(0.0)))


def rebased_slopes(rows: DataFrame, col: str, spans: tuple[int, ...] = (5, 10, 20), prefix: str = "") -> DataFrame:
    """Slope of the last n values, rebased to the oldest and divided by their 20-row mean."""

    def slope(n: int) -> Column:
        values = series.rebased(series.newest_of(F.col("_h"), n), F.col("_mean"), 7)
        return series.slope_of(values, n).alias(f"{prefix}slope_value_{n:02d}")

    keep = [c for c in rows.columns if c != col]
    return _history(rows, col).select(*keep, *[slope(n) for n in spans])


def levels_mp() -> Levels:
    """Slopes of the price, rebased to the oldest of the last n rows and divided by their 20-row mean, and their ranks."""
    spans = (5, 10, 20)

    def slope(n: int) -> Column:
        return series.slope_of(series.rebased(series.newest_of(F.col("_mp_whole"), n), F.col("_mp_mean"), 7), n)

    return Levels(
        code={"_mp_last": series.list_last(F.col("market_price").cast("double"), order(), 20)},
        row2={"_mp_whole": F.when(F.size("_mp_last") == 20, F.col("_mp_last"))},
        row3={"_mp_mean": F.nullif(series.total_of(F.col("_mp_whole")) / 20, F.lit(0.0))},
        out={f"slope_value_{n:02d}": slope(n) for n in spans},
        place={f"slope_rank_{n:02d}": rank_on_date(F.desc_nulls_first(F.round(f"slope_value_{n:02d}", 9))) for n in spans},
    )


def levels_pe() -> Levels:
    """Positional medians of the earnings ratio (missing = -999) and their ranks."""
    w = order()
    return Levels(
        row={"pe": F.coalesce(F.col("forward_pe"), F.lit(MISSING_PE).cast("decimal(8,1)"))},
        code={f"mdn_pe_vl_{n:02d}": kth_smallest(F.col("pe"), w, n, MEDIAN_PLACE[n]) for n in SPANS},
        place={f"mdn_pe_rk_{n:02d}": rank_on_date(F.desc_nulls_first(f"mdn_pe_vl_{n:02d}")) for n in SPANS},
    )


def place_in_range(recent: str, top: str, down: str) -> Column:
    """Position of a price between two others, 0 where they are not apart."""
    low, high = F.col(down), F.col(top)
    return F.when(high <= low, F.lit(0.0)).otherwise(ratio(F.col(recent) - low, high - low))


def stochastic(tx: DataFrame, n: int = 5, recent: str = "market_price", skip_today: bool = False) -> DataFrame:
    """Position of the price in the range of the last n rows (0 where the range is empty)."""
    w = order()
    frame = w.rowsBetween(-n, -1) if skip_today else last_rows(w, n)
    top, down = F.max("market_day_high").over(frame), F.min("market_day_low").over(frame)
    rows = tx.select(*KEYS, F.col(recent).alias("recent"), top.alias("top"), down.alias("down"))
    return rows.select(*KEYS, place_in_range("recent", "top", "down").alias("rsv"))


def k_total(position: Column, n: int = 5, factor: float = 1.09625) -> Column:
    """Geometric-weighted mean of the last n positions: weights 2^i / 3^(i+1), plus the tail 2^n / 3^(n+1)."""
    w = order()
    total = F.lit(2.0**n / 3.0 ** (n + 1))
    for i in range(n - 1, -1, -1):
        total = total + F.lit(2.0**i / 3.0 ** (i + 1)) * lagged(position, w, i)
    return total * factor


def k_line(rows: DataFrame, n: int = 5, factor: float = 1.09625) -> DataFrame:
    return rows.withColumn("kind", k_total(F.col("rsv"), n, factor))


def k_line_long(tx: DataFrame) -> DataFrame:
    """The ten-row variant: previous close in the range of the ten rows before, newest weight on lag 1."""
    w = order()
    rows = stochastic(tx, 10, "market_previous_close", skip_today=True).where("date_index > 10")
    # The tail weight is 2^10/3^10 halved; the oldest lag has 2^9/3^10.
    total = F.lit(0.5 * (2.0**10 / 3.0**10))
    for i in range(10, 0, -1):
        total = total + F.lit(2.0 ** (i - 1) / 3.0**i) * F.lag("rsv", i).over(w)
    return rows.withColumn("kind", total).where("kind IS NOT NULL")


def levels_rk() -> Levels:
    """Positional medians of the range position and of its K line, and their ranks."""
    w, spans = order(), (3, 5, 10)

    def capped(n: int) -> Column:
        c = F.col(f"_ki_{n:02d}")
        return F.when(c >= 1, F.lit("0.999").cast("decimal(5,3)")).otherwise(dec(c, 3, 9).cast("decimal(5,3)"))

    return Levels(
        code={"_rk_top": F.max("market_day_high").over(last_rows(w, 5)), "_rk_down": F.min("market_day_low").over(last_rows(w, 5))},
        row2={"_rk_place": place_in_range("market_price", "_rk_top", "_rk_down")},
        code2={"_rk_kind": k_total(F.col("_rk_place"))},
        row3={"rsv": dec(F.col("_rk_place"), 4, 10), "kind": dec(F.col("_rk_kind"), 4, 10)},
        code3={
            **{f"rsv_vl_mdn_{n:02d}": kth_smallest(F.col("rsv"), w, n, MEDIAN_PLACE[n]) for n in spans},
            **{f"_ki_{n:02d}": kth_smallest(F.col("kind"), w, n, MEDIAN_PLACE[n]) for n in spans},
        },
        out={f"ki_vl_mdn_{n:02d}": capped(n) for n in spans},
        place={
            **{f"rsv_rk_mdn_{n:02d}": rank_on_date(F.asc_nulls_last(f"rsv_vl_mdn_{n:02d}")) for n in spans},
            **{f"ki_rk_mdn_{n:02d}": rank_on_date(F.asc_nulls_last(f"_ki_{n:02d}")) for n in spans},
        },
    )


def short_strength(tx: DataFrame, scale: int = 3) -> DataFrame:
    return tx.select(*KEYS, dec(ratio(F.col("short_position"), F.col("average_volume")), scale, 12).alias("ss"), F.col("reported_position").alias("rp"))


def levels_st() -> Levels:
    """Ranks of the positional medians of short / volume and of the reported position."""
    w, cols = order(), [(c, n) for c in ("ss", "rp") for n in (3, 5, 10)]
    return Levels(
        row={"ss": dec(ratio(F.col("short_position"), F.col("average_volume")), 3, 12), "rp": F.col("reported_position")},
        code={f"_{c}_{n:02d}": kth_smallest(F.col(c), w, n, MEDIAN_PLACE[n]) for c, n in cols},
        place={f"mdn_{c}_rk_{n:02d}": rank_on_date(F.asc_nulls_last(f"_{c}_{n:02d}")) for c, n in cols},
    )


def strength(tx: DataFrame, base: str = "market_open", newest_heaviest: bool = True) -> DataFrame:
    """Volume x return, triangular-weighted over 5, 10 and 20 gapless rows, per average volume.

    The other variant weighs the oldest row most and starts at yesterday.
    """
    w = order()
    start = F.col(base).cast("double")
    value = F.col("market_volume").cast("double") * (F.col("market_price").cast("double") - start) / F.nullif(start, F.lit(0.0))
    rows = tx.where(F.col(base) != 0).select(*KEYS, F.col("average_volume").cast("double").alias("_vol"), value.alias("_s"))
    reach = 19 if newest_heaviest else 20
    rows = rows.withColumn("_first", F.lag("date_index", reach).over(w))
    col = F.col("_s") if newest_heaviest else F.lag("_s", 1).over(w)
    rows = rows.withColumn("_c", col)
    rows = rows.withColumns({f"strength{n:02d}": series.triangular(F.col("_c"), w, n, newest_heaviest) / F.col("_vol") for n in (5, 10, 20)})
    current = F.col("_s") / F.col("_vol") if newest_heaviest else F.col("_s")
    rows = rows.withColumn("strength00", current)
    return rows.where(F.col("date_index") - F.col("_first") == reach).drop("_first", "_vol", "_s", "_c")


def levels_sg() -> Levels:
    """Trading strength as in `strength` and its rank, of rows whose last twenty dates are without a gap and have an open price."""
    w, spans, start = order(), (5, 10, 20), F.col("market_open").cast("double")
    value = F.col("market_volume").cast("double") * (F.col("market_price").cast("double") - start) / F.nullif(start, F.lit(0.0))
    gapless = (F.col("date_index") - F.col("_sg_first") == 19) & (F.col("_sg_known") == 20)
    volume = F.col("average_volume").cast("double")

    def place(n: int) -> Column:
        whole = F.row_number().over(W.partitionBy("date_index").orderBy(F.desc("_sg_whole"), F.desc_nulls_first(f"_sg_{n:02d}"), "code"))
        return F.when(F.col("_sg_whole"), whole)

    return Levels(
        row={"_sg_value": value},
        code={
            "_sg_first": F.lag("date_index", 19).over(w),
            "_sg_known": F.count(F.when(F.col("market_open") != 0, 1)).over(last_rows(w, 20)),
            **{f"_sg_{n:02d}": series.triangular(F.col("_sg_value"), w, n) / volume for n in spans},
        },
        row2={"_sg_whole": F.coalesce(gapless, F.lit(False))},
        out={f"strength_{n:02d}": F.when(F.col("_sg_whole"), dec(F.col(f"_sg_{n:02d}"), 6, 12)) for n in spans},
        place={f"rank_{n:02d}": place(n) for n in spans},
    )


def change_extremes(tx: DataFrame) -> DataFrame:
    """Largest and smallest change and rank of the last 3, 5, 10 and 20 rows, and their means."""
    w = order()
    rows = increase_ratio(tx, "market_previous_close")
    cols = [f(c).over(last_rows(w, n)).alias(f"{c}_{word}{n:02d}") for c in ("irv", "irr") for n in SPANS for f, word in ((F.max, "grt"), (F.min, "lst"))]
    means = [mean_strict(F.col(c), w, n).alias(f"{c}_avg{n:02d}") for c in ("irv", "irr") for n in SPANS]
    return rows.select(*KEYS, *cols, *means).where("date_index > 20")


def _spans(stem: str, spans: tuple[int, ...]) -> list[str]:
    return [f"{stem}_{n:02d}" for n in spans]


FAMILIES: dict[str, tuple[Callable[[], Levels], list[str], list[Pair], list[Pair]]] = {
    "ir": (levels_ir, *_ir_names()),
    "mp": (
        levels_mp,
        _spans("slope_value", (5, 10, 20)) + _spans("slope_rank", (5, 10, 20)),
        span_pairs("slope_value", "divided_slope", (5, 10, 20)),
        span_pairs("slope_rank", "divided_rank", (5, 10, 20)),
    ),
    "pe": (
        levels_pe,
        _spans("mdn_pe_vl", SPANS) + _spans("mdn_pe_rk", SPANS),
        span_pairs("mdn_pe_vl", "divided_mdn_pe_vl", SPANS),
        span_pairs("mdn_pe_rk", "divided_mdn_pe_rk", SPANS),
    ),
    "rk": (
        levels_rk,
        [x for s in ("rsv_rk_mdn", "rsv_vl_mdn", "ki_rk_mdn", "ki_vl_mdn") for x in _spans(s, (10, 5, 3))],
        [p for s in ("rsv", "ki") for p in span_pairs(f"{s}_vl_mdn", f"divided_{s}_vl_mdn", (3, 5, 10))],
        [p for s in ("rsv", "ki") for p in span_pairs(f"{s}_rk_mdn", f"divided_{s}_rk_mdn", (3, 5, 10))],
    ),
    "st": (
        levels_st,
        [x for s in ("ss", "rp") for x in _spans(f"mdn_{s}_rk", (3, 5, 10))],
        [],
        [p for s in ("ss", "rp") for p in span_pairs(f"mdn_{s}_rk", f"divided_{s}_rk", (3, 5, 10))],
    ),
    "sg": (
        levels_sg,
        _spans("strength", (5, 10, 20)) + _spans("rank", (5, 10, 20)),
        span_pairs("strength", "divided_strength", (5, 10, 20)),
        span_pairs("rank", "divided_rank", (5, 10, 20)),
    ),
}


def family(tx: DataFrame, name: str) -> DataFrame:
    """One scaled feature family: ir, mp, pe, rk, st or sg."""
    levels, values, ratios, diffs = FAMILIES[name]
    return scale_features(add_levels(tx, levels()).select(*KEYS, *values), values, ratios, diffs)


def all_families(tx: DataFrame, *more: Levels) -> tuple[DataFrame, list[str], list[Pair], list[Pair]]:
    """The raw columns of all families, prefixed by the family's name, with what is to be scaled; `more` levels come along."""
    raw = add_levels(tx, *[levels() for levels, _, _, _ in FAMILIES.values()], *more)
    named: list[Column] = []
    values, ratios, diffs = [], [], []
    for name, (_, own, own_ratios, own_diffs) in FAMILIES.items():
        named += [F.col(v).alias(f"{name}_{v}") for v in own]
        values += [f"{name}_{v}" for v in own]
        ratios += [tuple(f"{name}_{x}" for x in pair) for pair in own_ratios]
        diffs += [tuple(f"{name}_{x}" for x in pair) for pair in own_diffs]
    kept = [c for one in more for level in fields(Levels) for c in getattr(one, level.name) if not c.startswith("_")]
    return raw.select(*KEYS, *kept, *named), values, ratios, diffs


# --- the older family, squashed with fixed scales ----------------------------------------


def _floor(c: Column) -> Column:
    """Three decimals; an exact zero becomes 0.001 so that it can divide."""
    x = dec(c, 3, 5)
    return F.when(x == 0, F.lit("0.001").cast("decimal(5,3)")).otherwise(x)


def _quotients(df: DataFrame, stem: str, out: str, spans: tuple, shape: Callable[[Column], Column]) -> DataFrame:
    pairs = [(a, b) for i, a in enumerate(spans) for b in spans[i + 1 :]]
    return df.withColumns({f"{out}_{a}{b}": dec(shape(ratio(F.col(f"{stem}{a}"), F.col(f"{stem}{b}"))), 3, 5) for a, b in pairs})


def _double(c: Column) -> Column:
    return sigmoid(c) * 2 - 1


def draft_increase(tx: DataFrame) -> DataFrame:
    w = order()
    rows = increase_ratio(tx, "market_previous_close")
    raw = rows.select(*KEYS, F.col("irv").alias("_m00"), *[mean_strict(F.col("irv"), w, n).alias(f"_m{n:02d}") for n in SPANS])
    out = raw.where("date_index >= 20").select("code", "date_index", *[_floor(squash(F.col(f"_m{n:02d}"), 0.3)).alias(f"inc{n:02d}") for n in (0, *SPANS)])
    return _quotients(out, "inc", "divided_inc", ("03", "05", "10", "20"), _double)


def draft_pe(tx: DataFrame) -> DataFrame:
    w = order()
    pe = F.coalesce(F.col("forward_pe"), F.lit(MISSING_PE).cast("decimal(8,1)"))
    rows = tx.select(*KEYS, pe.alias("pe"))
    raw = rows.select(
        "code",
        "date_index",
        _floor(squash(F.col("pe"), 0.1, 15)).alias("pe_cur"),
        *[_floor(squash(kth_smallest(F.col("pe"), w, n, MEDIAN_PLACE[n]), 0.1, 15)).alias(f"pe_mdn{n:02d}") for n in SPANS],
    )
    return _quotients(raw, "pe_mdn", "divided_pe", ("03", "05", "10", "20"), lambda c: squash(clamped(c, -10.0, 10.0), 80, 1))


def draft_slope(tx: DataFrame) -> DataFrame:
    rows = rebased_slopes(tx.select("code", "date_index", "market_price"), "market_price")
    out = rows.select("code", "date_index", *[_floor(squash(F.col(f"slope_value_{n:02d}"), 50)).alias(f"slope{n:02d}") for n in (5, 10, 20)])
    return _quotients(out, "slope", "divided_slope", ("05", "10", "20"), _double)


def price_position(tx: DataFrame, date: tuple[str, ...] = DATE) -> DataFrame:
    """(P - L) / (H - L) clamped to [0, 1], and its rank on the date."""
    rows = tx.select(*dict.fromkeys((*KEYS, *date)), position_in_range("market_day_low", "market_price", "market_day_high").alias("raw"))
    return rows.select(*KEYS, dec(clamped(F.col("raw"), 0.0, 1.0), 3, 5).alias("price_ratio"), rank_on_date(F.desc("raw"), date).alias("rank"))


def draft_price(tx: DataFrame) -> DataFrame:
    w = order()
    rows = price_position(tx)
    raw = rows.select(
        "code", "date_index", F.col("price_ratio").alias("pr00"), *[_floor(mean_strict(F.col("price_ratio"), w, n)).alias(f"pr{n:02d}") for n in SPANS]
    )
    return _quotients(raw, "pr", "divided_pr", ("03", "05", "10", "20"), lambda c: sigmoid(c * 5 - 5))


def draft_strength(tx: DataFrame) -> DataFrame:
    rows = strength(tx, "market_previous_close")
    out = rows.select("code", "date_index", *[_floor(squash(F.col(f"strength{n:02d}"), 50)).alias(f"strength{n:02d}") for n in (0, 5, 10, 20)])
    return _quotients(out, "strength", "divided_strength", ("00", "05", "10", "20"), _double)


def draft_k(tx: DataFrame) -> DataFrame:
    w = order()
    rows = k_line(stochastic(tx)).select(*KEYS, dec(F.col("kind"), 4, 10).alias("kind"))

    def capped(n: int) -> Column:
        c = kth_smallest(F.col("kind"), w, n, MEDIAN_PLACE[n])
        return F.when(c >= 1, F.lit("0.999").cast("decimal(5,3)")).otherwise(dec(c, 3, 9).cast("decimal(5,3)"))

    out = rows.select("code", "date_index", *[capped(n).alias(f"k{n:02d}") for n in (3, 5, 10)])
    return _quotients(out, "k", "divided_k", ("03", "05", "10"), lambda c: sigmoid(c * 5 - 5))


def short_slopes(tx: DataFrame) -> DataFrame:
    """Slopes of the short ratio and of the reported position over 5, 10 and 20 rows."""
    rows = short_strength(tx)
    a = rebased_slopes(rows.select("code", "date_index", "rp", "ss"), "ss", prefix="ss_")
    b = rebased_slopes(a, "rp", prefix="sp_")
    out = b.select(
        "code", "date_index", *[_floor(squash(F.col(f"{p}_slope_value_{n:02d}"), 50)).alias(f"{p}{n:02d}") for p in ("sp", "ss") for n in (5, 10, 20)]
    )
    for p in ("sp", "ss"):
        out = _quotients(out, p, f"divided_slope_{p}", ("05", "10", "20"), _double)
    return out


def short_strength_scaled(tx: DataFrame) -> DataFrame:
    """(sigmoid(0.1 r) - 0.5) x 2 of short / average volume."""
    rows = short_strength(tx, 2)
    return rows.select(*KEYS, dec((squash(F.col("ss"), 0.1) - 0.5) * 2, 2, 5).alias("short_strength"))


def ask_bid(tx: DataFrame) -> DataFrame:
    """Spread per price with fall-backs, and how far the ask stands above the price within the spread."""
    ask, bid, price = (F.col(c).cast("double") for c in ("ask", "bid", "market_price"))
    zero = F.lit(0).cast("decimal(10,5)")
    spread = F.when(price != 0, dec((ask - bid) / F.nullif(price, F.lit(0.0)), 5, 10)).when(
        ask - bid != 0, dec((ask - bid) / F.nullif(ask + bid, F.lit(0.0)) / 2, 5, 10)
    )
    above = F.when((ask < price) | (ask < bid), zero).when(bid - ask != 0, dec((ask - price) / F.nullif(ask - bid, F.lit(0.0)), 5, 10))
    rows = tx.select(*KEYS, F.coalesce(spread, zero).alias("split_ratio"), above.alias("ask_strength"))
    return rows.withColumn("split_ratio", F.when(F.col("split_ratio") < 0, zero).otherwise(F.col("split_ratio")))


def simple_ranks(tx: DataFrame, universe: int = 300, date: tuple[str, ...] = DATE) -> DataFrame:
    """Ranks of volume, earnings ratio and change; the earnings rank and its six-row mean per universe."""
    w = order()
    pe = F.coalesce(F.col("forward_pe"), F.lit(MISSING_PE).cast("decimal(8,1)"))
    change = increase_ratio(tx, "market_previous_close", date).select("code", "date_index", "irv", F.col("irr").cast("int").alias("increase_rank"))
    rows = tx.select(
        *KEYS,
        rank_on_date(F.desc_nulls_first("market_volume"), date).alias("volume_rank"),
        rank_on_date(F.desc(pe), date).alias("pe_rank"),
    ).join(change, ["code", "date_index"])
    return rows.select(
        *KEYS,
        "volume_rank",
        "pe_rank",
        "increase_rank",
        F.col("irv").alias("increase_ratio"),
        dec(ratio(F.col("pe_rank"), F.lit(universe)), 3, 5).alias("pe_share"),
        dec(ratio(F.when(F.count("pe_rank").over(last_rows(w, 6)) == 6, F.sum("pe_rank").over(last_rows(w, 6))), F.lit(universe * 5)), 3, 5).alias("avg_pe_share"),
    )


def older_training(tx: DataFrame, universe: int = 300, ahead: int = 14) -> DataFrame:
    """Forward return with the previous date's ranks, strengths and change (left joins)."""
    pairs = forward_return(tx, "code", "date_index", ahead, "market_open", "market_price").where("start_price <> 0")
    ranks = simple_ranks(tx, universe)
    s = strength(tx, "market_previous_close", newest_heaviest=False)
    strong = s.select(
        "code",
        "date_index",
        *[dec(squash(F.col(f"strength{n:02d}")), 3, 5).alias(f"strength_ratio_{n:02d}") for n in (5, 10, 20)],
        *[dec(ratio(F.lit(universe) - rank_on_date(F.desc(f"strength{n:02d}")), F.lit(universe)), 3, 5).alias(f"strength_rank_{n:02d}") for n in (5, 10, 20)],
    )
    change = ranks.select(
        "code",
        "date_index",
        "pe_share",
        "avg_pe_share",
        dec(squash(F.col("increase_ratio")), 3, 5).alias("increase_ratio"),
        dec(ratio(F.col("increase_rank"), F.lit(universe)), 3, 5).alias("increase_rank"),
    )
    rising = ranks.where("increase_ratio > 0").groupBy("date_index").agg(dec(ratio(F.max("increase_rank"), F.lit(universe)), 3, 5).alias("increase_filter"))

    def shifted(df: DataFrame) -> DataFrame:
        return df.withColumn("date_index", F.col("date_index") + 1)

    growth = dec(ratio(F.col("end_price").cast("double") - F.col("start_price").cast("double"), F.col("start_price")), 6)
    out = pairs.select("code", "date_index", growth.alias("performance"))
    return (
        out.join(shifted(change), ["code", "date_index"], "left")
        .join(shifted(strong), ["code", "date_index"], "left")
        .join(shifted(rising), "date_index", "left")
    )


def draft_training(tx: DataFrame, ahead: int = 25, first: int = 20) -> DataFrame:
    """The older training set: forward prices with the seven squashed families (inner joins)."""
    pairs = forward_return(tx, "code", "date_index", ahead, "market_open", "market_price").select("code", "date_index", "start_price", "end_price")
    frames = [pairs, draft_increase(tx), draft_pe(tx), draft_slope(tx), draft_price(tx), draft_strength(tx), draft_k(tx), short_slopes(tx)]
    return feature_join(frames, ["code", "date_index"]).where(F.col("date_index") >= first)


def training_set(
    tx: DataFrame,
    min_rated: int = 125,
    min_volume: int = 70_000,
    drop_codes: tuple[str, ...] = (),
    ahead: int = 24,
    first: int = 20,
    top: int = 20,
) -> DataFrame:
    """Candidates of well-rated dates, best scores per date, with all six families as whole thousandths.

    The score adds the earnings position (100 places) and the analyst rating; forward
    performance is the close `ahead` dates later against today's open, plus 1. All families and the
    candidates come from one scan of the panel and three shuffles (by date, by code, by date); the scaling
    parameters of all columns are one aggregate row, and only the chosen rows are scaled.
    """
    open_, later = F.col("market_open"), order().rangeBetween(ahead, ahead)
    growth = F.when(open_ != 0, dec(ratio(F.col("_later") - open_, open_), 3, 9)).otherwise(F.lit(0).cast("decimal(9,3)"))
    fit = (F.col("average_volume") > min_volume) & (position_in_range("target_low_price", "target_median_price", "target_high_price") > 0.4)
    if drop_codes:
        fit = fit & ~F.col("code").isin(*drop_codes)
    score = candidate_score(F.col("pe_rank"), F.col("number_of_analyst"), F.col("recommendation_mean"), 40)
    candidates = Levels(
        date={
            "pe_rank": rank_on_date(F.desc(F.coalesce(F.col("forward_pe"), F.lit(0).cast("decimal(8,1)")))),
            "_rated": F.count("recommendation_mean").over(W.partitionBy("date_index")),
        },
        code={"_later": F.max("market_price").over(later), "_pairs": F.count(F.lit(1)).over(later)},
        out={"performance": growth + 1, "candidate": F.coalesce(fit & (F.col("_rated") > min_rated) & (F.col("_pairs") > 0), F.lit(False)), "_score": score},
        place={"rec_rank": F.row_number().over(W.partitionBy("date_index").orderBy(F.desc("candidate"), F.desc("_score"), "code"))},
    )
    raw, values, ratios, diffs = all_families(tx, candidates)
    best = F.col("candidate") & (F.col("rec_rank") <= top) & (F.col("date_index") > first)
    scaled = scale_features(raw, values, ratios, diffs, (*KEYS, "performance", "rec_rank"), best)
    return scaled.select(*scaled.columns[:5], *[F.round(F.col(c) * 1000).cast("int").alias(c) for c in scaled.columns[5:]])


def candidate_score(pe_rank: Column, analysts: Column, rating: Column, divisor: int) -> Column:
    """(100 - place) / 100 within the first hundred places, plus (5 - rating) / divisor from four analysts on."""
    by_pe = F.when(pe_rank < 100, (F.lit(100) - pe_rank) / F.lit(100.0)).otherwise(F.lit(0.0))
    known = (analysts >= 4) & rating.isNotNull()
    return by_pe + F.when(known, (F.lit(5) - rating.cast("double")) / F.lit(float(divisor))).otherwise(F.lit(0.0))


def common_dates(individual: DataFrame, market: DataFrame, drop_index: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sets restricted to the dates they share, optionally without one date."""
    days = individual.select("load_date").distinct().join(market.select("load_date").distinct(), "load_date", "left_semi")
    a, b = (df.join(days, "load_date", "left_semi") for df in (individual, market))
    if drop_index is not None:
        a, b = (df.where(F.col("date_index") != drop_index) for df in (a, b))
    return a, b


def trends_long(df: DataFrame, keys: list[str], lists: list[str]) -> DataFrame:
    """List columns to long rows (attr, val)."""
    return df.unpivot(keys, lists, "attr", "val")


def rebased_lists(tx: DataFrame, col: str = "market_price", spans: tuple[int, ...] = (20, 10, 5)) -> DataFrame:
    """The rebased lists themselves, oldest first, from the 20th date on."""
    rows = _history(tx.select("code", "date_index", col), col).where(F.col("_h").isNotNull() & (F.col("date_index") >= 20))
    return rows.select("code", "date_index", *[series.rebased(series.newest_of(F.col("_h"), n), F.col("_mean")).alias(f"list{n:02d}") for n in spans])


def two_periods(tx: DataFrame, periods: dict[str, tuple[str, str]], make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a feature function on several date ranges, each with its own date index, and stack them."""
    from tapeline.plans.daily import calendar

    out = None
    for name, (start, end) in periods.items():
        part = tx.drop("date_index").where((F.col("load_date") >= F.lit(start).cast("date")) & (F.col("load_date") < F.lit(end).cast("date")))
        part = part.join(calendar(part).select("load_date", "date_index"), "load_date")
        one = make(part).select(F.lit(name).alias("period"), "*")
        out = one if out is None else out.unionByName(one)
    return out


#: Stands between a period and a code; no code holds it.
MARK = "\x1f"


def in_periods(tx: DataFrame, periods: dict[str, tuple[str, str]]) -> DataFrame:
    """The panel's rows once for each period they lie in, with the period's own date index.

    A code is named together with its period, so that every window and join by code keeps the periods apart; `period`
    does the same for windows by date (PERIOD_DATE). Whatever is made of this panel is one pass for all periods.
    """
    inside = [F.when((F.col("load_date") >= F.lit(a).cast("date")) & (F.col("load_date") < F.lit(b).cast("date")), F.lit(name)) for name, (a, b) in periods.items()]
    rows = tx.drop("date_index").withColumn("period", F.explode(F.array_compact(F.array(*inside))))
    days = rows.select("period", "load_date").distinct()
    days = days.withColumn("date_index", F.row_number().over(W.partitionBy("period").orderBy("load_date")))
    return rows.join(days, ["period", "load_date"]).withColumn("code", F.concat("period", F.lit(MARK), "code"))


def by_period(df: DataFrame) -> DataFrame:
    """Period and code as columns of their own again."""
    parts = F.split("code", MARK)
    return df.withColumns({"period": F.get(parts, F.lit(0)), "code": F.get(parts, F.lit(1))})


def period_chain(panel: DataFrame, universe: int = 300, ahead: int = 28) -> dict[str, Callable[[], DataFrame]]:
    """The tables made of a panel from `in_periods`, by name; each is computed for all periods at once."""
    keys = ["code", "date_index"]
    return {
        "performance": lambda: forward_return(panel, "code", "date_index", ahead, "market_open", "market_price").select(*keys, "start_price", "end_price"),
        "ranks": lambda: simple_ranks(panel, universe, PERIOD_DATE),
        "lists": lambda: trends_long(rebased_lists(panel), keys, ["list20", "list10", "list05"]),
        "strength": lambda: strength(panel, "market_previous_close", newest_heaviest=False),
        "k_line": lambda: k_line_long(panel),
        "short_strength": lambda: short_strength_scaled(panel),
        "ask_bid": lambda: ask_bid(panel),
        "price_ratio": lambda: price_position(panel, PERIOD_DATE),
    }
