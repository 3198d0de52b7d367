"""Text landing columns to typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Magnitude suffixes of money text.
MAGNITUDE = {"k": 10**3, "m": 10**6, "bn": 10**9, "tr": 10**12}


def blank(c: Column, *sentinels: str) -> Column:
    """NULL for '' and for any of `sentinels` ('Infinity', '-', ...)."""
    return F.when(~c.isin("", *sentinels), c)


def first_filled(type_: str, *cols: Column) -> Column:
    """First non-blank of several text columns, cast to `type_` (bad text gives NULL)."""
    return F.coalesce(*[blank(c) for c in cols]).try_cast(type_)


def magnitude(c: Column, keep_zero: bool = False) -> Column:
    """`12.3m`, `4bn`, `7k`, `1tr` or plain digits as DECIMAL(30,4); one character is missing.

    `keep_zero` lets the single text '0' through as zero.
    """
    number = F.regexp_extract(c, r"^(-?[0-9][0-9.,]*)(k|m|bn|tr)?$", 1)
    suffix = F.regexp_extract(c, r"^-?[0-9][0-9.,]*(k|m|bn|tr)$", 1)
    scale = F.lit(1)
    for text, factor in MAGNITUDE.items():
        scale = F.when(suffix == text, F.lit(factor)).otherwise(scale)
    value = F.regexp_replace(number, ",", "").try_cast("decimal(18,4)")
    parsed = (value * scale.cast("decimal(14,0)")).cast("decimal(30,4)")
    if keep_zero:
        return F.when(c == "0", F.lit(0).cast("decimal(30,4)")).when(F.length(c) != 1, parsed)
    return F.when(F.length(c) != 1, parsed)


def between(c: Column, key: str) -> Column:
    """Value between `key:` and the next comma of a flat `k:v,k:v,` text."""
    return F.regexp_extract(c, rf"{key}.([^,]*),", 1)


def quote_bare_numbers(c: Column) -> Column:
    """JSON text with bare NaN / Infinity / -Infinity made valid by quoting them."""
    return F.regexp_replace(c, r":\s*(-?Infinity|NaN)", r':"$1"')


def finite(c: Column) -> Column:
    """Text number as double; the three non-numbers become NULL."""
    return F.when(~c.isin("NaN", "Infinity", "-Infinity"), c).try_cast("double")


def joined(*parts: Column | str) -> Column:
    """Concatenation that skips NULL parts; plain strings are literals."""
    return F.concat_ws("", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def or_null_text(c: Column) -> Column:
    """NULL spelled out for text exports."""
    return F.coalesce(c.cast("string"), F.lit("NULL"))
