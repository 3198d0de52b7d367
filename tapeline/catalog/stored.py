"""Tables that are written, changed in place and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.catalog.feeds import loaded
from tapeline.catalog.registry import query
from tapeline.catalog.state import run_for
from tapeline.operators import tables
from tapeline.plans.feeds import FEEDS
from tapeline.sources import files, panels
from tapeline.staging import scratch

PANEL = "code string, load_date date, open decimal(12,3), high decimal(12,3), low decimal(12,3), close decimal(12,3), volume long"


@query("csv_panel", "SELECT code, load_date, open::DOUBLE AS open, high::DOUBLE AS high, low::DOUBLE AS low, close::DOUBLE AS close, volume FROM d_bars")
def csv_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Typed bars from CSV files."""
    path = scratch(spark, "csv")
    panels.quotes(spark, sf).select("code", "load_date", "open", "high", "low", "close", "volume").write.option("header", True).csv(path)
    return files.read_csv_panel(spark, path, PANEL)


@query(
    "text_landing",
    "SELECT code AS \"TRADED CODE\", load_date::VARCHAR AS \"LOAD DATE\", CASE WHEN v % 9 <> 0 THEN v::VARCHAR END AS \"VOLUME (UNITS)\", TRUE AS has_file, load_date AS loaded_on FROM d_base",
)
def text_landing(spark: SparkSession, sf: str) -> DataFrame:
    """All-text rows with odd column names, their load time and file."""
    path = scratch(spark, "landing")
    v = F.col("v")
    panels.daily_totals(spark, sf).select(
        F.col("code").alias("TRADED CODE"),
        F.col("load_date").cast("string").alias("LOAD DATE"),
        F.when(v % 9 != 0, v.cast("string")).alias("VOLUME (UNITS)"),
        F.col("load_date").cast("timestamp_ntz").alias("sys_load_time"),
    ).write.parquet(path)
    rows = files.read_landing(spark, path, ["TRADED CODE", "LOAD DATE", "VOLUME (UNITS)"])
    return rows.withColumns({"has_file": F.col("source_file").endswith(".parquet"), "loaded_on": F.col("sys_load_time").cast("date")}).drop("source_file", "sys_load_time")


@query("overwritten_snapshot", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_custkey % 3 <> 0")
def overwritten_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """A table replaced twice by rows of its own."""
    path = scratch(spark, "snapshot")
    files.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate").write.parquet(path)
    for unwanted in (F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"), F.col("o_custkey") % 3 == 0):
        tables.overwrite_snapshot(tables.delete_where(spark.read.parquet(path), unwanted), path)
    return spark.read.parquet(path)


@query(
    "backup_lists",
    " UNION ALL ".join(
        f"SELECT '{word}' AS list, code, total_ranking, category_ranking, TIMESTAMP '{stamp}' AS snapshot_ts FROM full_{side}"
        for side, word in (("long_end", "long"), ("short_end", "short"))
        for stamp in ("2001-06-29 18:00:00", "2001-06-29 19:30:00")
    ),
)
def backup_lists(spark: SparkSession, sf: str) -> DataFrame:
    """The ten current lists appended twice with the time of the snapshot; the full ones are read back."""
    run, root, out = run_for(spark, sf), scratch(spark, "backup"), None
    for stamp in ("2001-06-29 18:00:00", "2001-06-29 19:30:00"):
        run.backup(root, F.lit(stamp).cast("timestamp"))
    for word in ("long", "short"):
        rows = spark.read.parquet(f"{root}/full_{word}_snapshot").select(F.lit(word).alias("list"), "code", "total_ranking", "category_ranking", F.col("snapshot_ts").cast("timestamp_ntz"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "feed_load_times",
    "SELECT 'sdc' AS feed, count(*) = count(DISTINCT (index_name, ric, info_type, record_date)) AS whole, TRUE AS timed FROM (SELECT 'Index ' || (v % 3) AS index_name, code AS ric, v % 2 AS info_type, load_date AS record_date FROM w_base) UNION ALL SELECT 'sde', TRUE, TRUE UNION ALL SELECT 'sdl', TRUE, TRUE",
)
def feed_load_times(spark: SparkSession, sf: str) -> DataFrame:
    """Of each stored feed: are all keys different, and has every row the time of its load?"""
    _, root = loaded(spark, sf)
    out = None
    for name, feed in FEEDS.items():
        keys = F.struct(*[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in feed.keys])
        one = spark.read.parquet(f"{root}/{name}").agg(
            F.lit(name).alias("feed"), (F.count("*") == F.countDistinct(keys)).alias("whole"), (F.count("sys_load_time") == F.count("*")).alias("timed")
        )
        out = one if out is None else out.unionByName(one)
    return out
