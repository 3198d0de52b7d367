"""Two days of the end-of-day run stored, and queries that only read the store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.catalog import state
from tapeline.catalog.duck import DAY
from tapeline.catalog.registry import FRAGMENTS, ORACLES, at_other_day, fragment, query
from tapeline.catalog.state import DAY_BEFORE, run_for
from tapeline.operators.rows import trading_time
from tapeline.operators.snapshots import SnapshotStore
from tapeline.plans.endofday import EndOfDay, stored_mail, stored_page
from tapeline.plans.intraday import CUTOFFS, tick_bars
from tapeline.plans.loading import typed_ticks
from tapeline.sources import panels
from tapeline.staging import scratch

_stores: dict[tuple[str, str], SnapshotStore] = {}


def store_for(spark: SparkSession, sf: str) -> SnapshotStore:
    """The store after the run of two days, each started twice. Stored once for all queries of an application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stores:
        root = scratch(spark, "end-of-day")
        today = run_for(spark, sf, with_text=True)
        for run in (today.day_before(), today):
            for _ in range(2):
                EndOfDay(spark, root, run).go()
        _stores[key] = SnapshotStore(spark, root)
    return _stores[key]


def _lists(side: str, word: str) -> str:
    columns = "category, code, {day} AS load_date, total_ranking, category_ranking"
    before = at_other_day(f"full_{side}", DAY, DAY_BEFORE)
    return f"SELECT '{word}' AS list, {columns.format(day=DAY)} FROM full_{side} UNION ALL SELECT '{word}', {columns.format(day=DAY_BEFORE)} FROM {before}"


@query("stored_lists", f"{_lists('long_end', 'long')} UNION ALL {_lists('short_end', 'short')}")
def stored_lists(spark: SparkSession, sf: str) -> DataFrame:
    store, out = store_for(spark, sf), None
    for word in ("long", "short"):
        name = f"{word}_list_snapshot"
        rows = store.read(name, store.dates(name)).select(F.lit(word).alias("list"), "category", "code", "load_date", "total_ranking", "category_ranking")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("stored_index_summary", f"SELECT * FROM ({ORACLES['index_flags']}) WHERE category <> 'Unclassified'")
def stored_index_summary(spark: SparkSession, sf: str) -> DataFrame:
    return store_for(spark, sf).newest("index_summary_report")


@query("stored_long_summary_report", ORACLES["long_summary_report"])
def stored_long_summary_report(spark: SparkSession, sf: str) -> DataFrame:
    return store_for(spark, sf).newest("long_summary_report").drop("load_date")


@query("stored_long_summary_page", f"SELECT *, {DAY} AS load_date FROM ({ORACLES['long_summary_page']})")
def stored_long_summary_page(spark: SparkSession, sf: str) -> DataFrame:
    return stored_page(store_for(spark, sf), "long")


@query("stored_short_summary_page", f"SELECT *, {DAY} AS load_date FROM ({ORACLES['short_summary_page']})")
def stored_short_summary_page(spark: SparkSession, sf: str) -> DataFrame:
    return stored_page(store_for(spark, sf), "short")


# The stored summary takes up the lists of both days, a code by its newest one.
fragment("r_both", f"SELECT * FROM (SELECT * FROM r_long UNION ALL SELECT * FROM {at_other_day('r_long', DAY, DAY_BEFORE)}) QUALIFY row_number() OVER (PARTITION BY code ORDER BY load_date DESC) = 1")
fragment("r_sum_both", FRAGMENTS["r_sum"].replace("r_long", "r_both"))


@query(
    "stored_daily_summary",
    f"SELECT category, code, report_date, price::DOUBLE AS price, ema25, sar_buff, trend, rec, financial_healthy, pe_ranking, {DAY} AS load_date FROM r_sum_both",
)
def stored_daily_summary(spark: SparkSession, sf: str) -> DataFrame:
    return store_for(spark, sf).newest("daily_summary")


@query("stored_daily_mail", ORACLES["daily_mail"].replace("FROM r_sum s", "FROM r_sum_both s"))
def stored_daily_mail(spark: SparkSession, sf: str) -> DataFrame:
    return stored_mail(store_for(spark, sf))


@query(
    "stored_index_components",
    f"SELECT code, load_date, {DAY} AS snapshot_date FROM ix_comp UNION ALL SELECT code, load_date, {DAY_BEFORE} FROM {at_other_day('ix_comp', DAY, DAY_BEFORE)}",
)
def stored_index_components(spark: SparkSession, sf: str) -> DataFrame:
    store = store_for(spark, sf)
    dates = store.dates("index_component_history", "snapshot_date")
    return store.read("index_component_history", dates, "snapshot_date").select("code", "load_date", "snapshot_date")


#: Tables with one snapshot a day; a ranking's load_date is that of a code's last turn.
_DAILY = {n: s for n, s in state._COUNTS.items() if not n.endswith("_ranking")}


@query("stored_day_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, ({s if s.startswith('SELECT') else 'SELECT ' + s}) AS rows" for n, s in _DAILY.items()))
def stored_day_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the newest day in each table, read back after every run was started twice."""
    store, out = store_for(spark, sf), None
    for name in _DAILY:
        one = store.newest(name).agg(F.lit(name).alias("table_name"), F.count("*").alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out


@query("rush_current", "SELECT code, load_date, h / 1e4 AS high, l / 1e4 AS low, o / 1e4 AS open, c / 1e4 AS close FROM k_bar0")
def rush_current(spark: SparkSession, sf: str) -> DataFrame:
    """The newest set of provisional bars: bars of every day are stored, the newest day is found from folder names."""
    ticks = trading_time(typed_ticks(panels.web_ticker(spark, sf)), "tick_ts", CUTOFFS[0])
    store = SnapshotStore(spark, scratch(spark, "rush"))
    store.insert("rush_1230", tick_bars(ticks, "code", F.col("tick_ts").cast("date").alias("load_date")), ["code", "load_date"])
    return store.newest("rush_1230").select("code", "load_date", "high", "low", "open", "close")
