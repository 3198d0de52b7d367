"""Query registry plus the named SQL fragments that the check SQL is put together from."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
FRAGMENTS: dict[str, str] = {}


def fragment(name: str, sql: str) -> None:
    """A named WITH entry; `name` must be a unique word."""
    FRAGMENTS[name] = sql


def at_other_day(name: str, day: str, other: str, suffix: str = "_y") -> str:
    """Name of a copy of fragment `name` that reads `other` for `day`, resting on copies of all that names `day`."""

    def moves(n: str) -> bool:
        text = FRAGMENTS[n]
        return day in text or any(m != n and re.search(rf"\b{m}\b", text) and moves(m) for m in list(FRAGMENTS))

    def copy(n: str) -> str:
        if n + suffix not in FRAGMENTS:
            text = FRAGMENTS[n].replace(day, other)
            for m in [m for m in list(FRAGMENTS) if re.search(rf"\b{m}\b", text) and (m == n or moves(m))]:
                text = re.sub(rf"\b{m}\b", m + suffix, text)
                if m != n:
                    copy(m)
            fragment(n + suffix, text)
        return n + suffix

    return copy(name)


def with_fragments(sql: str) -> str:
    """Prefix `sql` with every fragment it needs, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in FRAGMENTS:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                visit(re.sub(rf"\b{name}\b", " ", FRAGMENTS[name]))
                ordered.append(name)

    visit(sql)
    if not ordered:
        return sql
    body = ",\n".join(
        f"{n} AS ({FRAGMENTS[n]})" if "UNION ALL" in FRAGMENTS[n] and n in FRAGMENTS[n] else f"{n} AS MATERIALIZED ({FRAGMENTS[n]})"
        for n in ordered
    )
    rest = sql.lstrip()
    own = rest[:5].upper() == "WITH "
    return f"WITH RECURSIVE {body}" + (f",\n{rest[5:]}" if own else f"\n{rest}")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double, so both engines hand over the same value types."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        cols.append(c.cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else c)
    return df.select(*cols)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where one exists, its SQL."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
