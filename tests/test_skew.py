"""A third of all rows under one brand, on one day, from one user: results stay whole."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F
from test_catalog import ORACLES, QUERIES, TABLES, compare

from tapeline.sources.files import table

HOT = [
    "actionable_list", "smoothed_candles", "price_lookback", "latest_line_per_part", "rank_over_all_orders", "priority_revenue", "insert_if_absent",
    "orphan_lines", "intraday_bars", "load_finance", "daily_volume_rank", "stream_insert_if_absent",
]


@pytest.fixture(scope="module")
def hot(spark, sf, tmp_path_factory):
    root = tmp_path_factory.mktemp("hot")
    line = table(spark, sf, "lineitem")
    third = F.col("l_orderkey") % 3 == 0
    line = line.withColumns(
        {
            "l_partkey": F.when(third, F.lit(1).cast("long")).otherwise(F.col("l_partkey")),
            "l_shipdate": F.when(F.col("l_linenumber") == 1, F.lit("1998-03-03").cast("timestamp_ntz")).otherwise(F.col("l_shipdate")),
        }
    )
    orders = table(spark, sf, "orders").withColumns(
        {
            "o_custkey": F.when(F.col("o_orderkey") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("o_custkey")),
            "o_totalprice": F.when(F.col("o_orderkey") % 3 == 1, F.lit(500.0)).otherwise(F.col("o_totalprice")),
        }
    )
    events = table(spark, sf, "events").withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("user_id")))
    changed = {"lineitem": line, "orders": orders, "events": events}
    for t in TABLES:
        changed.get(t, table(spark, sf, t)).write.parquet(f"{root}/{t}.parquet")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{root}/{t}.parquet/*.parquet'")
    yield str(root), con
    con.close()


@pytest.mark.parametrize("name", HOT)
def test_hot_groups(spark, hot, name):
    path, con = hot
    df = QUERIES[name](spark, path)
    compare([tuple(r) for r in df.collect()], df.columns, con.execute(ORACLES[name]))
