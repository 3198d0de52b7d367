"""Window operators over a key's ordered rows and over one date's codes.

A per-key window holds one instrument's history and a per-date window one day's instruments,
both bounded by the panel's unique key (code, date). Raw rows are aggregated to the panel first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeline.functions import series
from tapeline.functions.series import by, last_rows
from tapeline.staging import stage

BUCKETS = 200
#: A value with more than 1/HOT of all rows is heavy.
HOT = 1000
#: Rows of one key that `lag_by_offset` looks up together.
BLOCK = 256


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key. The rank filter runs before the shuffle too, so a hot key sends one row per task."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top_k_per_group(df: DataFrame, part: list[str], order: list[Column], k: int, out: str | None = None) -> DataFrame:
    w = W.partitionBy(*part).orderBy(*order)
    name = out or "_rn"
    ranked = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
    return ranked if out else ranked.drop(name)


def rank_per_date(df: DataFrame, date: str, order: list[Column], out: str = "rank") -> DataFrame:
    """Cross-sectional position of each code on its date (ties broken by the given order)."""
    return df.withColumn(out, F.row_number().over(W.partitionBy(date).orderBy(*order)))


def rank_ties(df: DataFrame, part: str | list[str] | None, order: Column, out: str) -> DataFrame:
    """rank(): equal values share a position. Without a partition the frame must be one row per code."""
    w = (W.partitionBy(part) if part else W).orderBy(order)
    return df.withColumn(out, F.rank().over(w))


def rank_all(df: DataFrame, value: str, out: str = "rank", descending: bool = True, buckets: int = BUCKETS, nulls_first: bool = False) -> DataFrame:
    """rank() of every row over the whole frame without sorting it in one task.

    Rows without a value share one rank, behind all others or (`nulls_first`) before them.

    Rows collapse to (value, count) first, so ties cost nothing, however many rows share a
    value. The distinct values are cut at approximate quantiles into buckets of similar size;
    a running count over the buckets (at most `buckets` rows) gives each bucket its offset,
    and values are ranked inside their bucket in parallel. The cuts only balance the work:
    the ranks are exact wherever they fall.

    Ranks go back to the rows by a join on the value. Values of more than a thousandth of all rows
    (fewer than a thousand of them, by counting) are broadcast; their rows, and those without a value, carry a
    number of their own through the shuffle, so no task gets them together.
    """
    direction = -1 if descending else 1
    counts = stage(df.groupBy(value).agg(F.count("*").alias("_n")))
    known = counts.where(F.col(value).isNotNull())
    signed = F.col(value).cast("double") * direction
    cuts = known.agg(F.percentile_approx(signed, [i / buckets for i in range(1, buckets)])).first()[0] or []
    limits = F.array(*[F.lit(float(c)) for c in cuts]).cast("array<double>")
    keyed = known.withColumn("_v", signed).withColumn("_b", F.size(F.filter(limits, lambda c: c < F.col("_v"))))
    ahead = W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    sizes = keyed.groupBy("_b").agg(F.sum("_n").alias("_size"))
    offsets = sizes.select("_b", F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_offset"))
    # Order by the value itself: two large whole numbers may share a double.
    inside = W.partitionBy("_b").orderBy(F.desc(value) if descending else F.asc(value))
    before = inside.rowsBetween(W.unboundedPreceding, -1)
    placed = keyed.withColumn("_in", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(offsets, "_b")
    total, missing = (counts.where(c).agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar() for c in ("true", F.col(value).isNull()))
    ranks = stage(placed.select(F.col(value).alias("_value"), "_n", (F.col("_offset") + F.col("_in") + 1).alias("_rank"), total.alias("_total")))
    heavy = ranks.where(F.col("_n") * HOT > F.col("_total")).select(F.col("_value").alias("_heavy"), F.col("_rank").alias("_heavy_rank"))
    others = ranks.where(F.col("_n") * HOT <= F.col("_total")).select(F.col("_value").alias("_other"), (F.col("_n") * 0).alias("_zero"), F.col("_rank").alias("_other_rank"))
    # _zero is no literal: the optimizer would take it out of the join's keys
    apart = F.col("_heavy_rank").isNotNull() | F.col(value).isNull()
    spread = df.join(F.broadcast(heavy), F.col(value) == F.col("_heavy"), "left").withColumn("_own", F.when(apart, F.monotonically_increasing_id() + 1).otherwise(F.lit(0)))
    joined = spread.join(others, (F.col(value) == F.col("_other")) & (F.col("_own") == F.col("_zero")), "left")
    found = F.coalesce("_heavy_rank", "_other_rank")
    # the constant part is one row, read by a scalar subquery
    none = F.lit(1).cast("long") if nulls_first else (total - missing + 1).cast("long")
    rank = F.when(F.col(value).isNull(), none).otherwise(found + missing if nulls_first else found)
    return joined.select(*df.columns, rank.cast("long").alias(out))


def lags(df: DataFrame, key: str, order: str, col: str, ns: list[int]) -> DataFrame:
    w = by(key, order)
    return df.withColumns({f"{col}_lag{n}": F.lag(col, n).over(w) for n in ns})


def leads(df: DataFrame, key: str, order: str, col: str, ns: list[int], default: object = None) -> DataFrame:
    w = by(key, order)
    return df.withColumns({f"{col}_lead{n}": F.lead(col, n, default).over(w) for n in ns})


def lag_by_column(df: DataFrame, key: str, order: str, col: str, offset: str, most: int, out: str) -> DataFrame:
    """lag with an offset taken from each row (0..most); NULL beyond the history.

    The last most+1 values sit in one array per row, so no self join is needed.
    """
    w = by(key, order)
    boxed = F.collect_list(F.struct(F.col(col).alias("v"))).over(w.rowsBetween(-most, 0))
    at = F.size("_h") - 1 - F.col(offset)
    picked = F.when((at >= 0) & (F.col(offset) >= 0), F.get("_h", at.cast("int")).getField("v"))
    return df.withColumn("_h", boxed).withColumn(out, picked).drop("_h")


def lag_by_offset(df: DataFrame, key: str, order: str, col: str, offset: str, out: str) -> DataFrame:
    """lag with an offset taken from each row, over the whole history; NULL beyond it and for a negative or missing offset.

    A key's values stand in arrays of BLOCK rows, one row each, and a row looks its element up by (key, block).
    """
    placed = stage(df.withColumn("_place", (F.row_number().over(by(key, order)) - 1).cast("long")))
    blocks = placed.groupBy(key, F.floor(F.col("_place") / BLOCK).alias("_block")).agg(F.array_sort(F.collect_list(F.struct("_place", F.col(col).alias("v")))).alias("_values"))
    target = F.when(F.col(offset) >= 0, F.col("_place") - F.col(offset))
    aimed = placed.withColumn("_aim", F.when(target >= 0, target)).withColumn("_block", F.floor(F.col("_aim") / BLOCK))
    looked = aimed.join(blocks, [key, "_block"], "left")
    return looked.select(*df.columns, F.get("_values", (F.col("_aim") % BLOCK).cast("int")).getField("v").alias(out))


def rolling_min(df: DataFrame, key: str, order: str, col: str, n: int, out: str) -> DataFrame:
    """Minimum of the last n rows."""
    return df.withColumn(out, F.min(col).over(last_rows(by(key, order), n)))


def rolling_mean_std(df: DataFrame, key: str, order: str, col: str, n: int, mean: str = "avg", std: str = "std") -> DataFrame:
    frame = last_rows(by(key, order), n)
    value = F.col(col).cast("double")
    return df.withColumns({mean: F.avg(value).over(frame), std: F.stddev_samp(value).over(frame)})


def oscillator(df: DataFrame, key: str, order: str, col: str, short: int = 3, long: int = 5) -> DataFrame:
    """(mean of short - mean of long) / mean of long, in percent, over the newest rows."""
    w = by(key, order)
    value = F.col(col).cast("double")
    a, b = F.avg(value).over(last_rows(w, short)), F.avg(value).over(last_rows(w, long))
    out = df.withColumns({"short_avg": a, "long_avg": b})
    gap = (F.col("short_avg") - F.col("long_avg")) / F.nullif(F.col("long_avg"), F.lit(0.0)) * 100
    return out.withColumn("vos", gap)


def last_n_array(df: DataFrame, key: str, order: str, col: str, n: int, out: str) -> DataFrame:
    """Values of the newest n rows, oldest first."""
    return df.withColumn(out, series.list_last(F.col(col), by(key, order), n))


def rolling_high_low(df: DataFrame, key: str, order: str, hi: str, lo: str, n: int, skip_today: bool = False) -> DataFrame:
    """Largest `hi` and smallest `lo` of the last n rows (optionally not counting today)."""
    w = by(key, order)
    frame = w.rowsBetween(-n, -1) if skip_today else last_rows(w, n)
    return df.withColumns({"top": F.max(hi).over(frame), "down": F.min(lo).over(frame)})


def rolling_mean_strict(df: DataFrame, key: str, order: str, col: str, n: int, out: str) -> DataFrame:
    return df.withColumn(out, series.mean_strict(F.col(col), by(key, order), n))


def triangular_mean(df: DataFrame, key: str, idx: str, col: str, n: int, out: str, newest_heaviest: bool = True) -> DataFrame:
    """Triangular-weighted mean; only where the n date indexes have no gap."""
    w = by(key, idx)
    gapless = F.col(idx) - F.lag(idx, n - 1).over(w) == n - 1
    return df.withColumn(out, F.when(gapless, series.triangular(F.col(col), w, n, newest_heaviest)))


def fill_last(df: DataFrame, key: str, order: str, col: str, n: int, out: str) -> DataFrame:
    """Newest present value of today and the n rows before."""
    return df.withColumn(out, F.last(col, ignorenulls=True).over(by(key, order).rowsBetween(-n, 0)))


def renumber(df: DataFrame, keys: list[str], array_col: str, out: str = "val") -> DataFrame:
    """Explode an array and number its values in ascending order within each key."""
    long = df.select(*keys, F.explode(array_col).alias(out))
    return long.withColumn("ordinal", F.row_number().over(W.partitionBy(*keys).orderBy(out)))


def rank_offset(df: DataFrame, key: str, order: Column, base: int, out: str = "offset_count") -> DataFrame:
    """base minus the position of each row in its key's order."""
    return df.withColumn(out, (F.lit(base) - F.row_number().over(W.partitionBy(key).orderBy(order))).cast("int"))


def newest_dates(df: DataFrame, date: str, k: int) -> DataFrame:
    """Rows of the k newest dates."""
    days = df.select(date).distinct().orderBy(F.desc(date)).limit(k)
    return df.join(days, date, "left_semi")


def second_latest(df: DataFrame, date: str) -> DataFrame:
    """Rows of the newest date but one."""
    newest = df.agg(F.max(date)).scalar()
    return df.where(F.col(date) == df.where(F.col(date) < newest).agg(F.max(date)).scalar())
