"""Numeric shaping: safe ratios, stored scales, squashing, buckets."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b in double; NULL when b is zero."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def dec(c: Column, scale: int, precision: int = 18) -> Column:
    """Round half away from zero to a stored scale."""
    return c.cast(f"decimal({precision},{scale})")


def hundredths(c: Column) -> Column:
    """Whole cents to a price with three stored decimals."""
    return (c.cast("decimal(14,0)") * F.lit(Decimal("0.01"))).cast("decimal(12,3)")


def money(c: Column) -> Column:
    """Whole cents of a sum, of any size, with three decimals."""
    return (c.cast("decimal(34,0)") * F.lit(Decimal("0.01"))).cast("decimal(38,3)")


def thousandths(c: Column) -> Column:
    """A price with three decimals as a whole number."""
    return (c.cast("decimal(18,3)") * 1000).cast("long")


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def squash(c: Column, scale: float = 1.0, shift: float = 0.0, mode: str = "unit") -> Column:
    """Squash (c - shift) * scale: 'unit' to (0,1), 'signed' to (-1,1), 'inverse' to 1 - unit."""
    s = sigmoid((c.cast("double") - F.lit(float(shift))) * F.lit(float(scale)))
    if mode == "unit":
        return s
    if mode == "signed":
        return s * 2 - 1
    if mode == "inverse":
        return F.lit(1.0) - s
    raise ValueError(f"unknown mode {mode!r}")


def clamped(c: Column, lo: float | None, hi: float | None) -> Column:
    """Clamp a value; NULL stays NULL."""
    out = c
    if lo is not None:
        out = F.when(out < lo, F.lit(lo)).otherwise(out)
    if hi is not None:
        out = F.when(out > hi, F.lit(hi)).otherwise(out)
    return out


def sign_of(c: Column, labels: tuple = (1, 0, -1)) -> Column:
    """(positive, missing, not positive) label of a value."""
    pos, missing, neg = (F.lit(x) for x in labels)
    return F.when(c.isNull(), missing).when(c > 0, pos).otherwise(neg)


def cases(pairs: list[tuple[Column, object]], default: object) -> Column:
    """First matching label of a list of (predicate, label)."""
    out = F.when(pairs[0][0], F.lit(pairs[0][1]))
    for pred, label in pairs[1:]:
        out = out.when(pred, F.lit(label))
    return out.otherwise(F.lit(default))


def flag(pred: Column) -> Column:
    """1 where the predicate holds, else 0 (NULL counts as 0)."""
    return F.when(pred, F.lit(1)).otherwise(F.lit(0))


#: Half of the range that a packed value has: every 64-bit whole number lies within.
HALF = 10**19


def first_by(seq: Column, value: Column) -> Column:
    """Aggregate: the value at the smallest `seq`, the smallest value among ties.

    Both are whole numbers. They are packed into one decimal, so the aggregation stays a hash
    aggregation with map-side partials; a struct would force a sort. Any long fits as a value; a
    sequence beyond 10^18 raises an error.
    """
    return _value(F.min(_packed(seq, value)))


def last_by(seq: Column, value: Column) -> Column:
    """Aggregate: the value at the largest `seq`, the largest value among ties."""
    return _value(F.max(_packed(seq, value)))


def _packed(seq: Column, value: Column) -> Column:
    wide = seq.cast("decimal(18,0)") * F.lit(Decimal(2 * HALF)).cast("decimal(20,0)")
    return (wide + (value.cast("decimal(19,0)") + F.lit(Decimal(HALF)).cast("decimal(20,0)"))).cast("decimal(38,0)")


def _value(packed: Column) -> Column:
    return (F.pmod(packed, F.lit(Decimal(2 * HALF))) - F.lit(Decimal(HALF))).cast("long")
