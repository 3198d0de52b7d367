"""The three index feeds: constituents, corporate actions and index levels, loaded batch by batch.

All feeds of the open batches are stored first and the batches flipped then, in one commit. A run that stops in
between leaves the batches open; the next one stores only what is missing and flips them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.operators.control import BatchControl, VersionTaken
from tapeline.operators.rows import project
from tapeline.operators.tables import insert_ignore, open_batches
from tapeline.sources.files import file_info_type, file_record_date

# The column names of the landing files.
CONSTITUENTS = [
    "INDEX NAME", "INDEX CODE", "INDEX KEY", "EFFECTIVE DATE", "COMPANY", "RIC", "BLOOMBERG TICKER", "CUSIP", "ISIN", "SEDOL", "TICKER", "GV KEY", "STOCK KEY", "GICS CODE",
    "DJI INDUSTRY CODE", "ALTERNATE CLASSIFICATION CODE", "MIC", "COUNTRY OF DOMICILE", "COUNTRY OF LISTING", "REGION", "SIZE", "CAP RANGE", "CURRENCY CODE", "LOCAL PRICE",
    "FX RATE", "SHARES OUTSTANDING", "MARKET CAP", "IWF", "AWF", "GROWTH", "VALUE", "INDEX SHARES", "INDEX MARKET CAP", "INDEX WEIGHT", "DAILY PRICE RETURN", "DAILY TOTAL RETURN",
    "DIVIDEND", "NET DIVIDEND",
]
#: Attributes of a stock that an action may change: the file has a CURRENT and a NEW column for each.
CHANGING = [
    "COMPANY NAME", "RIC", "BLOOMBERG TICKER", "CUSIP", "ISIN", "SEDOL", "TICKER", "GV KEY", "GICS CODE", "DJI INDUSTRY CODE", "ALTERNATE CLASSIFICATION CODE", "STOCK ATTRIBUTES",
    "MIC", "COUNTRY OF DOMICILE", "COUNTRY OF LISTING", "REGION", "SIZE", "CAP RANGE", "SHARIAH", "CURRENCY CODE",
]


def _both(*names: str) -> list[str]:
    return [f"{state} {name}" for name in names for state in ("CURRENT", "NEW")]


ACTIONS = [
    "INDEX NAME", "INDEX CODE", "INDEX KEY", "INDEX CURRENCY", "ACTION TYPE", "ACTION GROUP", "STATUS", "ANNOUNCED DATE", "LAST UPDATED DATE", "CLOSE OF BUSINESS DATE",
    "EFFECTIVE DATE", "REFERENCE DATE", "ANNOUNCEMENT ID", "NEW INDEX PROFILE", "SEQUENCE NO.", "STOCK KEY", *_both(*CHANGING), "FX RATE", *_both("SHARES OUTSTANDING", "IWF", "AWF"),
    "GROWTH", "VALUE", *_both("INDEX SHARES"), "INDEX SHARES PRIOR EVENTS", "INDEX SHARES POST EVENTS", "RATIO RECEIVED", "RATIO HELD", "SUBSCRIPTION PRICE", "PRICE ADJUSTMENT",
    *_both("PRICE"), "DIVIDEND CURRENCY", "DIVIDEND", "NET DIVIDEND", "ISSUANCE FEE", "FRANKING RATE", *_both("TAX RATE"), "ACQUIRER NAME", "CASH AMOUNT", "SPIN/TARGET NAME",
    "SPIN/TARGET TICKER", "SPIN/TARGET STOCK KEY", "SPIN/TARGET MIC", "SPIN/TARGET IS INDEX CO", "REPLACEMENT STOCK KEY", "COMMENTS",
]
LEVELS = [
    "CHANGE", "DATE OF INDEX", "INDEX NAME", "INDEX CODE", "INDEX KEY", "GICS CODE", "ISO CODE", "INDEX VALUE", "CLOSE MARKET CAP", "CLOSE DIVISOR", "CLOSE COUNT", "DAILY RETURN",
    "INDEX DIVIDEND", "ADJ MARKET CAP", "ADJ DIVISOR", "ADJ COUNT",
]


def column_name(landing: str) -> str:
    """`SPIN/TARGET NAME` is stored as spin_target_name."""
    return landing.lower().replace(".", "").replace("/", "_").replace(" ", "_")


@dataclass(frozen=True)
class Feed:
    """What one feed stores: its landing columns, the key of its table, key columns whose NULL is ''."""

    columns: tuple[str, ...]
    keys: tuple[str, ...]
    blanks: tuple[str, ...] = ()
    typed: bool = False  # has the file's type as info_type

    def rows(self, landing: DataFrame) -> DataFrame:
        """Landing rows as they are stored, without the load time. A file name without a date gives a NULL record_date."""
        out = project(landing, {column_name(c): c for c in self.columns} | {"source_file": "source_file"})
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in self.blanks})
        if self.typed:
            out = out.withColumn("info_type", file_info_type(F.col("source_file")))
        return out.withColumn("record_date", file_record_date(F.col("source_file"))).drop("source_file")


FEEDS = {
    "sdc": Feed(tuple(CONSTITUENTS), ("index_name", "ric", "info_type", "record_date"), typed=True),
    "sde": Feed(tuple(ACTIONS), ("index_name", "current_ric", "comments", "record_date"), ("current_ric", "comments")),
    "sdl": Feed(tuple(LEVELS), ("index_name", "date_of_index", "record_date")),
}


def load_open_batches(
    spark: SparkSession,
    control: BatchControl,
    landings: dict[str, DataFrame],
    root: str,
    stamp: Column | None = None,
    stored: Callable[[str], None] = lambda name: None,
    tries: int = 3,
) -> int:
    """Store the open batches of all feeds below `root` and flip them; returns the control version that stands then.

    Tables are partitioned by record_date; each row carries the time of its load as sys_load_time. Of rows with the same
    key the smallest stays, and none whose key is stored already. `stored` is told of each feed
    when it is stored. Where another writer commits meanwhile, the load starts over: what is stored is not stored again.
    """
    for attempt in range(tries):
        base = control.version()
        batches = control.read(base)
        if batches.where(~F.col("is_executed")).isEmpty():
            return base
        for name, feed in FEEDS.items():
            rows = feed.rows(open_batches(landings[name], batches))
            order = [F.col(c).asc_nulls_first() for c in rows.columns if c not in feed.keys]
            loaded = rows.withColumn("sys_load_time", F.current_timestamp() if stamp is None else stamp)
            insert_ignore(spark, f"{root}/{name}", loaded, list(feed.keys), order, by="record_date")
            stored(name)
        try:
            return control.flip(base, stamp)
        except VersionTaken:
            if attempt + 1 == tries:
                raise
    return control.version()
