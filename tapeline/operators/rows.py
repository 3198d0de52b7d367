"""Projections, filters and predicates over whole frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.functions.numeric import cases, clamped, sign_of
from tapeline.functions.text import blank, first_filled, or_null_text


def project(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """{new: old} projection; old names may hold spaces and dots."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in mapping.items()])


def blank_to_null(df: DataFrame, cols: list[str], sentinels: tuple[str, ...] = ("",)) -> DataFrame:
    return df.withColumns({c: blank(F.col(c), *sentinels) for c in cols})


def coalesce_pair(df: DataFrame, out: str, a: str, b: str, type_: str) -> DataFrame:
    """First non-blank of two text columns as `type_`."""
    return df.withColumn(out, first_filled(type_, F.col(a), F.col(b)))


def drop_sentinels(df: DataFrame, cols: list[str], sentinels: tuple[str, ...] = ("Infinity", "-")) -> DataFrame:
    """Missing-value marks and one-character text become NULL."""
    return df.withColumns({c: F.when(F.length(c) > 1, blank(F.col(c), *sentinels)) for c in cols})


def cast_text(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Typed columns from text; dirty text gives NULL instead of failing the load."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def bucketize(df: DataFrame, out: str, pairs: list[tuple[Column, object]], default: object) -> DataFrame:
    return df.withColumn(out, cases(pairs, default))


def monotone_filter(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows whose columns strictly fall from left to right (high > median > low)."""
    for a, b in zip(cols, cols[1:], strict=False):
        df = df.where(F.col(a) > F.col(b))
    return df


def clamp(df: DataFrame, col: str, lo: float | None, hi: float | None) -> DataFrame:
    return df.withColumn(col, clamped(F.col(col), lo, hi))


def trading_time(df: DataFrame, ts: str, cutoff: str | None = None) -> DataFrame:
    """Rows on Monday to Friday, up to a time of day `HH:mm:ss`."""
    out = df.where(F.weekday(F.col(ts).cast("date")) < 5)
    return out if cutoff is None else out.where(up_to(F.col(ts), cutoff))


def up_to(ts: Column, cutoff: str) -> Column:
    """Is the time of day not later than `HH:mm:ss`?"""
    return F.date_format(ts, "HH:mm:ss.SSSSSS") <= f"{cutoff}.000000"


def since(df: DataFrame, date_col: str, d: Column, days: int = 0, months: int = 0) -> DataFrame:
    """Rows after d minus a number of days or months, up to d."""
    start = F.add_months(d, -months) if months else F.date_sub(d, days)
    return df.where((F.col(date_col) > start) & (F.col(date_col) <= d))


def at_latest(df: DataFrame, date_col: str, before: Column | None = None) -> DataFrame:
    """Rows on the newest date, or on the newest date before another one."""
    pool = df if before is None else df.where(F.col(date_col) < before)
    return df.where(F.col(date_col) == pool.agg(F.max(date_col)).scalar())


def latest_batch(df: DataFrame, ts: str) -> DataFrame:
    """Rows loaded on the newest calendar day of `ts`."""
    return df.where(F.col(ts).cast("date") == df.agg(F.max(F.col(ts).cast("date"))).scalar())


def position_in_range(lo: str, mid: str, hi: str) -> Column:
    """(mid - lo) / (hi - lo), 0 where the range is empty or inverted."""
    span = (F.col(hi) - F.col(lo)).cast("double")
    return F.when(F.col(hi) <= F.col(lo), F.lit(0.0)).otherwise((F.col(mid) - F.col(lo)).cast("double") / F.nullif(span, F.lit(0.0)))


def spread_quality(df: DataFrame, lo: str, mid: str, hi: str, minimum: float) -> DataFrame:
    return df.where(position_in_range(lo, mid, hi) > minimum)


def sign_map(df: DataFrame, cols: list[str], labels: tuple = (1, 0, -1)) -> DataFrame:
    return df.withColumns({c: sign_of(F.col(c), labels) for c in cols})


def null_to_text(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: or_null_text(F.col(c)) for c in cols})


def rescale_where(df: DataFrame, cols: list[str], pred: Column, below: float, factor: int) -> DataFrame:
    """Multiply each column by `factor` where the row matches and that column is below a bound."""
    types = dict(df.dtypes)
    return df.withColumns(
        {c: F.when(pred & (F.col(c) < below), (F.col(c) * factor).cast(types[c])).otherwise(F.col(c)) for c in cols}
    )
