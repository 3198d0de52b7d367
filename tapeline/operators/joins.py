"""Joins with panel semantics. Where a window gives the same rows, there is no join at all."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeline.functions.numeric import ratio
from tapeline.functions.series import by

#: Buckets that a span covers at most, before wider ones are taken.
WIDEST = 8


def enrich(df: DataFrame, other: DataFrame, keys: list[str], defaults: dict[str, object] | None = None) -> DataFrame:
    """Left join; missing values of the right side may get defaults."""
    out = df.join(other, keys, "left")
    return out.fillna(defaults) if defaults else out


def compare_lists(today: DataFrame, last: DataFrame, key: str, shared: list[str], ranks: list[str]) -> DataFrame:
    """Full outer join of two lists: key and shared columns from either side, each rank twice."""
    t, y = today.alias("t"), last.alias("y")
    return t.join(y, F.col(f"t.{key}") == F.col(f"y.{key}"), "full").select(
        *[F.coalesce(F.col(f"t.{c}"), F.col(f"y.{c}")).alias(c) for c in [key, *shared]],
        *[F.col(f"t.{c}").alias(c) for c in ranks],
        *[F.col(f"y.{c}").alias(f"last_{c}") for c in ranks],
    )


def attach_scalar(df: DataFrame, one_row: DataFrame, out: str = "p") -> DataFrame:
    """Add a one-row frame to every row as a struct. It is a scalar subquery: computed once, no join."""
    return df.withColumn(out, one_row.select(F.struct("*").alias("s")).scalar())


def forward_return(df: DataFrame, key: str, idx: str, k: int, start: str, end: str) -> DataFrame:
    """start at index i paired with end at index i + k of the same key; rows without that index drop out.

    An equi join on the shifted index: `lead` would silently pair across gaps.
    """
    later = df.select(F.col(key), (F.col(idx) - k).alias(idx), F.col(end).alias("end_price"))
    return df.select(key, idx, F.col(start).alias("start_price")).join(later, [key, idx])


def with_last_n(df: DataFrame, key: str, idx: str, cols: list[str], n: int) -> DataFrame:
    """Values at index i-1 .. i-(n-1) beside each row; rows with a gap among the n indexes drop out."""
    w = by(key, idx)
    wide = df.withColumns({f"{c}_{i:02d}": F.lag(c, i).over(w) for c in cols for i in range(1, n)})
    return wide.withColumn("_first", F.lag(idx, n - 1).over(w)).where(F.col(idx) - F.col("_first") == n - 1).drop("_first")


def range_join(left: DataFrame, right: DataFrame, key: str, date: str, lo: str, hi: str, bucket_days: int | None = None) -> DataFrame:
    """Rows of `right` whose date lies in [lo, hi] of a `left` row with the same key.

    Both sides carry a time bucket, so the join is an equi join on (key, bucket): a key with
    a long history is spread over many tasks and only overlapping buckets meet. `right` must
    not share column names with `left` other than the key.

    Buckets are as wide as nine of ten spans are long, if their width is not given. A span that would cover more than
    WIDEST buckets lies in buckets WIDEST times as wide, or that many times again, so it never covers more than WIDEST + 1;
    a row of `right` stands in one bucket of each width in use, which are few. Spans with a missing or reversed end match nothing.
    """
    spans = left.where(F.col(lo) <= F.col(hi))
    length = F.date_diff(hi, lo) + 1
    most, usual = spans.agg(F.max(length), F.percentile_approx(length, 0.9)).first()
    if most is None:
        return left.join(right, key).where(F.lit(False))
    widths = [bucket_days or max(1, usual)]
    while most > widths[-1] * WIDEST:
        widths.append(widths[-1] * WIDEST)

    def bucket(c: Column, width: Column | int) -> Column:
        return F.floor(F.unix_date(c) / width)

    width = F.lit(widths[-1])
    for w in reversed(widths[:-1]):
        width = F.when(length <= w * WIDEST, F.lit(w)).otherwise(width)
    spans = spans.withColumn("_w", width).withColumn("_b", F.explode(F.sequence(bucket(F.col(lo), F.col("_w")), bucket(F.col(hi), F.col("_w")))))
    points = right.where(F.col(date).isNotNull()).withColumn("_w", F.explode(F.array(*map(F.lit, widths))))
    points = points.withColumn("_b", bucket(F.col(date), F.col("_w")))
    return spans.join(points, [key, "_w", "_b"]).where((F.col(date) >= F.col(lo)) & (F.col(date) <= F.col(hi))).drop("_w", "_b")


def look_back(df: DataFrame, key: str, date: str, days: int, **aggs: Column) -> DataFrame:
    """Range join of a table with itself over the last `days` days: one range frame, no join."""
    frame = W.partitionBy(key).orderBy(F.unix_date(date)).rangeBetween(-days, 0)
    return df.select("*", *[agg.over(frame).alias(name) for name, agg in aggs.items()])


def fill_from_next(df: DataFrame, key: str, date: str, cols: list[str], fills: Column, missing: Column | None = None) -> DataFrame:
    """Rows where `missing` holds take all columns from the next row of the key where `fills` holds.

    By default a row is missing where it cannot fill. A row that is neither keeps its own values; a
    missing row without a later one that fills drops out. Read newest first, so the frame only
    grows and each key costs one pass.
    """
    back = W.partitionBy(key).orderBy(F.desc(date)).rowsBetween(W.unboundedPreceding, 0)
    lacks = ~F.coalesce(fills, F.lit(False)) if missing is None else missing
    found = F.last(F.when(fills, F.struct(*cols)), ignorenulls=True).over(back)
    out = df.withColumn("_found", found).withColumn("_box", F.when(lacks, F.col("_found")).otherwise(F.struct(*cols)))
    out = out.drop("_found").where("_box IS NOT NULL")
    return out.select(key, date, *[F.col(f"_box.{c}").alias(c) for c in cols], *[c for c in df.columns if c not in (key, date, *cols)])


def orphans(fact: DataFrame, dims: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """Facts that miss at least one of several dimensions [(dim, fact key, dim key)]."""
    out, missing = fact, F.lit(False)
    for i, (dim, fact_key, dim_key) in enumerate(dims):
        keys = dim.select(F.col(dim_key).alias(f"_k{i}")).distinct()
        out = out.join(keys, out[fact_key] == keys[f"_k{i}"], "left")
        missing = missing | F.col(f"_k{i}").isNull()
    return out.where(missing).select(*fact.columns)


def star_join(fact: DataFrame, dims: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """Inner joins of a fact with its dimensions; the planner broadcasts those it measures as small."""
    for dim, fact_key, dim_key in dims:
        fact = fact.join(dim, fact[fact_key] == dim[dim_key])
    return fact


def restrict_to(df: DataFrame, keys_df: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(keys_df, keys, "left_semi")


def delete_matching(df: DataFrame, keys_df: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(keys_df, keys, "left_anti")


def convolve(df: DataFrame, weights: DataFrame, key: str, date: str, col: str, n: int) -> DataFrame:
    """Weighted sum of each key's newest n rows against a weight table (orders 0..n-1), complete only."""
    place = F.row_number().over(W.partitionBy(key).orderBy(F.desc(date))) - 1
    rows = df.withColumn("orders", place).where(F.col("orders") < n)
    sums = rows.join(weights, "orders").groupBy(key).agg(
        F.max(date).alias(date), F.sum(F.col(col) * F.col("weight")).alias("value"), F.count("*").alias("_n")
    )
    return sums.where(F.col("_n") == n).drop("_n")


def convolve_at(df: DataFrame, weights: DataFrame, key: str, pos: str, col: str, last: int) -> DataFrame:
    """Weighted sum by position: row `pos` meets weight `last - pos` (a computed join key)."""
    rows = df.withColumn("orders", F.lit(last) - F.col(pos))
    return rows.join(weights, "orders").groupBy(key).agg(F.sum(F.col(col) * F.col("weight")).alias("value"))


def running_product(df: DataFrame, order: str, cols: list[str], part: list[str] | None = None) -> DataFrame:
    """Cumulative product of growth factors as exp(sum(ln x)) in one running window."""
    w = (W.partitionBy(*part) if part else W).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumns({c: F.exp(F.sum(F.ln(F.col(c).cast("double"))).over(w)) for c in cols})


def feature_join(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Inner join of several frames on one key; equal keys keep one partitioning throughout."""
    return reduce(lambda a, b: a.join(b, keys), frames)


def densify(keys: DataFrame, days: DataFrame, date: str) -> DataFrame:
    """Every key on every day. The days travel as one array and are exploded per key."""
    dates = days.agg(F.sort_array(F.collect_set(date))).scalar()
    return keys.withColumn(date, F.explode(dates))


def pivot_positions(df: DataFrame, date: str, rank: str, value: str, k: int, prefix: str) -> DataFrame:
    """One row per date with the values at rank 1..k side by side."""
    wanted = [F.max(F.when(F.col(rank) == i, F.col(value))).alias(f"{prefix}{i}") for i in range(1, k + 1)]
    return df.where(F.col(rank) <= k).groupBy(date).agg(*wanted)


def flag_new(cur: DataFrame, prev: DataFrame, key: str, out: str = "is_new") -> DataFrame:
    """True for rows whose key is not in the previous list."""
    seen = prev.select(key).distinct().withColumn("_seen", F.lit(True))
    return cur.join(seen, key, "left").withColumn(out, F.col("_seen").isNull()).drop("_seen")


def pair_next(df: DataFrame, key: str, date: str, entry: Column, exit_: Column) -> DataFrame:
    """Each entry row with the next exit strictly after it; one pass, read newest first."""
    later = W.partitionBy(key).orderBy(F.desc(date)).rowsBetween(W.unboundedPreceding, -1)
    marked = df.select(key, date, entry.alias("_in"), F.when(exit_, F.col(date)).alias("_out"))
    paired = marked.withColumn("exit_date", F.last("_out", ignorenulls=True).over(later))
    return paired.where("_in AND exit_date IS NOT NULL").select(key, F.col(date).alias("entry_date"), "exit_date")


def refresh_periods(dates: DataFrame, days: DataFrame, date: str, idx: str) -> DataFrame:
    """From one refresh date to the trading day before the next one, numbered in order.

    `dates` holds the refresh dates, `days` the calendar with an ascending index; both have
    one row per day.
    """
    order = W.orderBy(date)
    spans = dates.select(F.col(date).alias("start_date"), F.lead(date).over(order).alias(date), F.row_number().over(order).alias("period"))
    ends = spans.where(F.col(date).isNotNull()).join(days.select(date, idx), date)
    before = days.select((F.col(idx) + 1).alias(idx), F.col(date).alias("end_date"))
    return ends.join(before, idx).select("period", "start_date", "end_date")


def period_endpoints(df: DataFrame, periods: DataFrame, key: str, date: str, start_cols: dict[str, str], end_cols: dict[str, str]) -> DataFrame:
    """The start-date row and the end-date row of the same key, side by side, per period."""
    first = df.join(periods, df[date] == periods["start_date"]).select(
        key, "period", "start_date", "end_date", *[F.col(c).alias(n) for n, c in start_cols.items()]
    )
    last = df.select(F.col(key), F.col(date).alias("end_date"), *[F.col(c).alias(n) for n, c in end_cols.items()])
    return first.join(last, [key, "end_date"])


def product_table(spark, n: int) -> DataFrame:
    """src, wgt in 0..n with src * wgt, and the mirrored half with a negative sign."""
    side = n + 1
    grid = spark.range(side * side).select((F.col("id") / side).cast("long").alias("src"), (F.col("id") % side).alias("wgt"))
    grid = grid.withColumn("rst", F.col("src") * F.col("wgt"))
    upper = grid.select((F.col("src") + n).alias("src"), "wgt", "rst")
    lower = grid.select((n - F.col("src")).alias("src"), "wgt", (-F.col("rst")).alias("rst"))
    return upper.union(lower).distinct()


def growth(start: str = "start_price", end: str = "end_price") -> Column:
    """(end - start) / start."""
    return ratio(F.col(end) - F.col(start), F.col(start))
