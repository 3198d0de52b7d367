"""Registered queries and the SQL each one is checked against."""

from __future__ import annotations

import importlib

from tapeline.catalog.registry import ORACLES, QUERIES, Query, with_fragments

MODULES = ("daily", "relational", "loading", "state", "intraday", "features", "evaluation", "streams", "feeds", "endofday", "stored")

for _module in MODULES:
    importlib.import_module(f"tapeline.catalog.{_module}")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: with_fragments(sql) for name, sql in ORACLES.items()}
