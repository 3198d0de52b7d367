"""Registered queries against their SQL on DuckDB.

A spread of queries runs by default; TAPELINE_ALL=1 runs every one.
"""

from __future__ import annotations

import math
import os
import subprocess
import sys
from decimal import Decimal

import duckdb
import pytest
from conftest import ROOT

from tapeline.catalog import oracle_sql, queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = queries(), oracle_sql()
SPREAD = [
    "actionable_list", "moving_averages", "match_point", "ema_trend", "ema_cross_period", "macd_on_candles", "parabolic_sar_two_settings", "moving_range", "volume_bands",
    "today_against_last_list", "price_lookback", "dense_filled_prices", "swing_pairs", "multiplication_lookup", "rank_over_all_orders", "lag_by_row_offset", "rolling_frames",
    "insert_if_absent", "load_quotes", "load_finance", "load_consensus", "load_analysis", "index_landing_load", "general_transactions", "etl_log", "page_list_items",
    "stability_ranking_on_candles", "full_long_list", "trend_directions", "index_direction", "short_current", "analysis_current", "provisional_index", "swing_trend",
    "features_of_range_position", "features_of_trading_strength", "market_indicators", "older_price_features", "two_period_features", "eavt_basic",
    "instances", "decay_votes", "rating_differences", "cumulative_performance", "stream_insert_if_absent",
]
CHOSEN = sorted(QUERIES) if os.environ.get("TAPELINE_ALL") else SPREAD


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    yield con
    con.close()


def value(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else x + 0.0
    assert not isinstance(x, Decimal), "decimals must be cast to double"
    return x


def key(row):
    return tuple((x is None, str(type(x)), x) for x in row)


def compare(got, names, cursor):
    theirs = [d[0] for d in cursor.description]
    assert sorted(theirs) == sorted(names)
    order = [theirs.index(n) for n in names]
    expected = sorted((tuple(value(r[i]) for i in order) for r in cursor.fetchall()), key=key)
    mine = sorted((tuple(value(x) for x in r) for r in got), key=key)
    assert mine == expected


@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    if name in ORACLES:
        compare(got, df.columns, duck.execute(ORACLES[name]))


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert not [n for n in QUERIES if "pipeline" in n]


def test_catalog_imports_without_a_session():
    code = f"import sys; sys.path.insert(0, {ROOT!r}); import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd="/")


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
