"""Expressions over a key's ordered rows. `w` is a window partitioned by key, ordered by date."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import Column, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WEIGHT_DIGITS = 9


def by(key: str | list[str] = "code", order: str = "load_date") -> WindowSpec:
    keys = [key] if isinstance(key, str) else key
    return W.partitionBy(*keys).orderBy(order)


def last_rows(w: WindowSpec, n: int) -> WindowSpec:
    """Frame of the newest n rows, today included."""
    return w.rowsBetween(-(n - 1), 0)


def ema_weights(n: int, span: int) -> list[Decimal]:
    """n weights (1-a)^i, a = 2/(span+1), newest first, rounded so that they sum to exactly 1."""
    a = Decimal(2) / Decimal(span + 1)
    raw = [(1 - a) ** i for i in range(n)]
    unit = Decimal(1).scaleb(-WEIGHT_DIGITS)
    out = [(x / sum(raw)).quantize(unit) for x in raw]
    out[0] += 1 - sum(out)
    return out


# Default weight vectors: 15 terms at span 10 and 40 terms at span 25 (newest first).
EMA15 = ema_weights(15, 10)
EMA40 = ema_weights(40, 25)


def weighted_last(c: Column, w: WindowSpec, weights: list[Decimal], scale: int = 3) -> Column:
    """Exact sum of weights[i] * c[t-i]; NULL unless all rows exist. Newest weight first.

    No floating-point noise, rounds the same way everywhere, and holds every price that decimal(18, scale) does.
    """
    history = list_last(wholes(c, scale), w, len(weights))
    return F.when(F.size(history) == len(weights), weighted_of(history, weights, scale))


def wholes(c: Column, scale: int = 3) -> Column:
    """c * 10^scale as a whole number."""
    return (c.cast(f"decimal(18,{scale})") * 10**scale).cast("long")


def weighted_of(history: Column, weights: list[Decimal], scale: int = 3) -> Column:
    """Exact sum of weights[-1 - i] * history[i] / 10^scale for an array of as many `wholes`, oldest first.

    Sums of whole numbers where all products surely fit 64 bits, else of decimals.
    """
    stored = f"decimal(38,{WEIGHT_DIGITS + scale})"
    factors = [int(x.scaleb(WEIGHT_DIGITS)) for x in reversed(weights)]
    most = (2**63 - 1) // max(1, sum(map(abs, factors)))
    fits = (F.array_max(history) <= F.lit(most)) & (F.array_min(history) >= F.lit(-most))

    def total(values: list[Column], kind: str, of: str) -> Column:
        products = F.zip_with(history, F.array(*values), lambda value, weight: value.cast(of) * weight)
        return F.aggregate(products, F.lit(0).cast(kind), lambda acc, x: (acc + x).cast(kind))

    whole = total([F.lit(x).cast("long") for x in factors], "long", "long").cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-(WEIGHT_DIGITS + scale)))
    shares = [F.lit(Decimal(x).scaleb(-WEIGHT_DIGITS)).cast(f"decimal({WEIGHT_DIGITS + 1},{WEIGHT_DIGITS})") for x in factors]
    large = total(shares, f"decimal(38,{WEIGHT_DIGITS})", "decimal(19,0)").cast(f"decimal({WEIGHT_DIGITS + 20},{WEIGHT_DIGITS})") * F.lit(Decimal(1).scaleb(-scale))
    return F.when(fits, whole.cast(stored)).otherwise(large.cast(stored))


def list_last(c: Column, w: WindowSpec, n: int) -> Column:
    """Values of the newest n rows, oldest first; missing values are left out."""
    return F.collect_list(c).over(last_rows(w, n))


def kth_smallest(c: Column, w: WindowSpec, n: int, k: int) -> Column:
    """k-th smallest of the newest n rows; NULL if fewer than k values are present."""
    return F.get(F.array_sort(list_last(c, w, n)), F.lit(k - 1))


def mean_strict(c: Column, w: WindowSpec, n: int) -> Column:
    """Mean of the newest n rows, NULL unless all n values are present (exact sum for decimals)."""
    rows = last_rows(w, n)
    return F.when(F.count(c).over(rows) == n, F.sum(c).over(rows) / F.lit(n))


def slope_of(values: Column, n: int) -> Column:
    """Least-squares slope of an n-element array against 0..n-1, as a product with fixed weights."""
    mid = (n - 1) / 2
    sxx = sum((i - mid) ** 2 for i in range(n))
    weights = F.array(*[F.lit((i - mid) / sxx) for i in range(n)])
    return total_of(F.zip_with(values, weights, lambda v, k: v * k))


def total_of(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def newest_of(values: Column, n: int) -> Column:
    """The last n elements of an array."""
    return F.slice(values, -n, n)


def rebased(values: Column, mean: Column, digits: int | None = None) -> Column:
    """(x - first) / mean for every element."""
    first = F.get(values, F.lit(0))

    def one(x: Column) -> Column:
        y = (x - first) / mean
        return y if digits is None else F.round(y, digits)

    return F.transform(values, one)


def lagged(c: Column, w: WindowSpec, i: int) -> Column:
    return c if i == 0 else F.lag(c, i).over(w)


def triangular(c: Column, w: WindowSpec, n: int, newest_heaviest: bool = True) -> Column:
    """Weights n..1 (or 1..n) over the newest n rows, divided by n(n+1)/2."""
    weights = [n - i if newest_heaviest else i + 1 for i in range(n)]
    total = reduce(add, [lagged(c, w, i).cast("double") * x for i, x in enumerate(weights)])
    return total / F.lit(n * (n + 1) / 2)
