"""The end-of-day run as stored steps: tables, lists, reports and the long-list chain, restartable after the last stored step.

Each step writes one table by insert-if-absent and is then noted in the ledger. A run of the same day goes on after
the last noted step; a step that was written but not noted is written again and adds nothing. Reports
compare with the snapshots of the trading day before as they were stored; nothing of that day is computed again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.operators.snapshots import RunLedger, SnapshotStore
from tapeline.operators.tables import overwrite_snapshot
from tapeline.plans import daily, market_index, rankings, reports
from tapeline.plans.reports import DailyRun

KEYS = ["code", "load_date"]
#: Trading days whose long lists a summary takes up.
LISTED_DAYS = 5
PAGE_ROWS, PAGE_ROWS_PER_CATEGORY = 70, 6


@dataclass(frozen=True)
class Step:
    """A table of the run: how its rows of the day are made, its key, the tables that must be stored before.

    A daily table has a snapshot of each day, be it without rows; a ranking's load_date is that of a code's last turn.
    """

    make: Callable[[], DataFrame]
    keys: tuple[str, ...] = ("code", "load_date")
    needs: tuple[str, ...] = ()
    by: str = "load_date"
    daily: bool = True


class MissingStep(RuntimeError):
    """A step came up before one that it needs."""


class EndOfDay:
    """The run of one day into the store at `root`."""

    def __init__(self, spark: SparkSession, root: str, run: DailyRun) -> None:
        self.spark, self.root, self.run, self.day = spark, root, run, str(run.d)
        self.store, self.ledger = SnapshotStore(spark, root), RunLedger(spark, root)

    def steps(self) -> dict[str, Step]:
        """All steps in order."""
        run, day = self.run, self.run.day
        out = {}
        for name, make in run.outputs().items():
            keys = ("load_date",) if name == "trading_days" else (*KEYS, "usage_direction") if name.endswith("_ranking") else tuple(KEYS)
            out[name] = Step(make, keys, daily=not name.endswith("_ranking"))
        out["index_component_history"] = Step(
            lambda: run.components.withColumn("snapshot_date", day), (*KEYS, "snapshot_date"), by="snapshot_date"
        )
        rankings_ = ("ema_on_ha_ranking", "ema_on_sar_ranking", "stb_on_ha_ranking", "stb_on_sar_ranking")
        for side, word in zip(rankings.SIDES, ("long", "short"), strict=True):
            out[f"{word}_list_snapshot"] = Step(lambda side=side: self._list(side), needs=rankings_)
        out["index_summary_report"] = Step(self._index_summary, ("category", "load_date"), needs=("index_direction",))
        for side, word in zip(rankings.SIDES, ("long", "short"), strict=True):
            needs = (f"{word}_list_snapshot", "index_direction", "ema", "sar", "heikin_ashi", "volume_bands", "simple_moving_range")
            out[f"{word}_summary_report"] = Step(lambda side=side, word=word: self._summary(side, word), needs=needs)
        out["half_year_actionable_list"] = Step(lambda: daily.actionable_list(run.bars, run.d, months=6, turnover_cuts=(100, 200, 300), style="narrow"))
        out["sar_pair"] = Step(lambda: run.sar_pair.where(F.col("load_date") == day))
        for span in ("semester", "quarter"):
            out[f"{span}_trend_stability_list"] = Step(lambda span=span: self._dated(run.steady(span)), needs=("half_year_actionable_list",))
            out[f"{span}_trend_direction_list"] = Step(lambda span=span: self._dated(run.direction_list(span)), needs=("half_year_actionable_list", "sar_pair", "ema"))
        chain = tuple(f"{span}_trend_{kind}_list" for span in ("semester", "quarter") for kind in ("stability", "direction"))
        out["daily_long_list"] = Step(lambda: reports.daily_long_list(run), needs=chain)
        out["daily_summary"] = Step(self._daily_summary, ("code", "report_date", "load_date"), needs=("daily_long_list",))
        return out

    def _dated(self, rows: DataFrame) -> DataFrame:
        return rows if "load_date" in rows.columns else rows.withColumn("load_date", self.run.day)

    def _list(self, side: str) -> DataFrame:
        return self.run.full_list(side).select("category", "code", self.run.day.alias("load_date"), "total_ranking", "category_ranking")

    def _snapshots(self, name: str, like: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The stored rows of this day and of the newest day before it; where none are stored, no rows that look like `like`."""
        dates = [d for d in self.store.dates(name) if d <= self.day]
        before = [d for d in dates if d < self.day][:1]
        none = like.limit(0)
        today = self.store.read(name, [self.day]) if self.day in dates else none
        return today, self.store.read(name, before) if before else none

    def _index_summary(self) -> DataFrame:
        today, before = self._snapshots("index_direction", self.run.index.withColumnRenamed("category", "code"))
        return market_index.index_flags(today.withColumnRenamed("code", "category"), before.withColumnRenamed("code", "category"))

    def _summary(self, side: str, word: str) -> DataFrame:
        today, before = self._snapshots(f"{word}_list_snapshot", self._list(side))
        report = reports.summary_report(self.run, side, today, before)
        return report.withColumn("load_date", self.run.day)

    def _daily_summary(self) -> DataFrame:
        dates = [d for d in self.store.dates("daily_long_list") if d <= self.day][:LISTED_DAYS]
        listed = self.store.read("daily_long_list", dates) if dates else reports.daily_long_list(self.run).limit(0)
        return reports.daily_summary(self.run, listed).withColumn("load_date", self.run.day)

    def go(self, stored: Callable[[str], None] = lambda step: None) -> list[str]:
        """Run what is not stored yet; returns the steps that ran. `stored` is told of each step when it is noted."""
        done, ran = self.ledger.done(self.day), []
        for name, step in self.steps().items():
            if name in done:
                continue
            if missing := set(step.needs) - done:
                raise MissingStep(f"{name} needs {sorted(missing)}")
            self.store.insert(name, step.make(), list(step.keys), step.by, self.day if step.daily else None)
            if name == "index_component_history":
                overwrite_snapshot(self.run.components, f"{self.root}/index_component_snapshot")
            self.ledger.mark(self.day, name)
            done.add(name)
            ran.append(name)
            stored(name)
        return ran


def _newest(store: SnapshotStore, name: str) -> DataFrame:
    found = store.newest(name)
    if found is None:
        raise LookupError(f"no snapshot of {name} is stored yet")
    return found


def stored_page(store: SnapshotStore, word: str, most: int = PAGE_ROWS, per_category: int = PAGE_ROWS_PER_CATEGORY) -> DataFrame:
    """The newest stored summary report, cut to a page."""
    return reports.summary_page(_newest(store, f"{word}_summary_report"), most, per_category)


def stored_mail(store: SnapshotStore) -> DataFrame:
    """The daily mail from the newest stored summary and the one before."""
    today, before = _newest(store, "daily_summary"), store.newest("daily_summary", 1)
    names = [c for c in today.columns if c != "load_date"]
    before = today.limit(0) if before is None else before
    return reports.daily_mail(today.select(*names), before.select(*names), _newest(store, "simple_moving_range"))
