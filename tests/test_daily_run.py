from __future__ import annotations

import os

from pyspark.sql import functions as F

from tapeline.catalog.intraday import NOW
from tapeline.catalog.state import run_for
from tapeline.plans.intraday import CUTOFFS, IntradayRun
from tapeline.plans.loading import typed_ticks
from tapeline.plans.reports import DailyRun
from tapeline.sources import panels
from tapeline.staging import shared_dir, stage
from tapeline.streaming.ticks import stored_rows


def test_writing_a_day_twice_adds_nothing(spark, sf, tmp_path):
    run, root = run_for(spark, sf), str(tmp_path)
    run.write(spark, root)
    tables = [t for t in sorted(os.listdir(root)) if t != "index_component_history"]
    first = {t: stored_rows(spark, f"{root}/{t}") for t in tables}
    run.write(spark, root)
    assert {t: stored_rows(spark, f"{root}/{t}") for t in tables} == first
    assert first["heikin_ashi"] > 0 and first["trading_days"] == 1


def test_backup_appends_ten_lists(spark, sf, tmp_path):
    run, root = run_for(spark, sf), str(tmp_path)
    run.backup(root, F.lit("2001-06-29 18:00:00").cast("timestamp"))
    assert len(os.listdir(root)) == 10


def test_later_days_do_not_change_a_day(spark, sf):
    """Results as of d are the same whether or not the panel goes on after d."""
    bars = stage(panels.quotes(spark, sf))
    d = "1999-06-30"
    whole = DailyRun(bars, panels.categories, d)
    cut = DailyRun(bars.where(F.col("load_date") <= F.lit(d).cast("date")), panels.categories, d)
    for name in ("sar", "candles", "ema", "trend"):
        a, b = getattr(whole, name), getattr(cut, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_cutoffs_only_add_ticks(spark, sf):
    run = run_for(spark, sf)
    ticks = typed_ticks(panels.web_ticker(spark, sf))
    first, last = (IntradayRun(run, ticks, NOW, c).bars for c in (CUTOFFS[0], CUTOFFS[2]))
    both = first.alias("a").join(last.alias("b"), "code")
    assert both.count() == first.count()
    assert both.where("a.high > b.high OR a.low < b.low OR a.open <> b.open").count() == 0


def test_stage_writes_to_the_shared_folder(spark):
    df = stage(spark.range(3))
    assert df.inputFiles()[0].removeprefix("file:").removeprefix("//").startswith(shared_dir(spark).removeprefix("file:"))
    assert df.count() == 3
