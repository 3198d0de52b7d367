"""The stored end-of-day run: restart, second run, reports from stored snapshots alone, newest snapshot by folder name."""

from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tapeline.catalog.state import run_for
from tapeline.operators.snapshots import RunLedger, SnapshotStore
from tapeline.plans import views
from tapeline.plans.endofday import EndOfDay, MissingStep, Step, stored_mail, stored_page

DAY, BEFORE = "2001-06-29", "2001-06-28"


class Stopped(RuntimeError):
    pass


@pytest.fixture(scope="module")
def today(spark, sf):
    return run_for(spark, sf, with_text=True)


@pytest.fixture(scope="module")
def root(spark, today, tmp_path_factory):
    """Two days stored, the second one stopped half-way once."""
    path = str(tmp_path_factory.mktemp("eod"))
    assert len(EndOfDay(spark, path, today.day_before()).go()) == 31

    def stop(step):
        if step == "long_list_snapshot":
            raise Stopped

    with pytest.raises(Stopped):
        EndOfDay(spark, path, today).go(stop)
    return path


def counts(spark, root, names):
    store = SnapshotStore(spark, root)
    by = {"index_component_history": "snapshot_date"}
    return {n: store.read(n, store.dates(n, by.get(n)), by.get(n)).count() for n in names if store.dates(n, by.get(n))}


def test_run_goes_on_after_the_last_stored_step_and_a_second_one_adds_nothing(spark, root, today):
    run = EndOfDay(spark, root, today)
    names = list(run.steps())
    at = names.index("long_list_snapshot") + 1
    assert run.ledger.done(DAY) == set(names[:at])
    assert run.go() == names[at:]
    assert run.go() == []
    first = counts(spark, root, names)
    assert {"sar", "ema", "heikin_ashi", "sar_pair", "actionable_list"} <= set(first)

    class Forgetful(RunLedger):
        def done(self, run):
            return set()

    again = EndOfDay(spark, root, today)
    again.ledger = Forgetful(spark, root)  # as if nothing had been noted: every step is written once more
    assert again.go() == names
    assert counts(spark, root, names) == first


def test_reports_compare_with_what_was_stored(spark, root, today):
    run = EndOfDay(spark, root, today)
    run.go()
    store = run.store
    for name in ("sar", "ema", "heikin_ashi"):
        assert store.dates(name) == [DAY, BEFORE]
    listed = {name: store.dates(name) for name in ("long_list_snapshot", "long_summary_report", "daily_summary")}
    print(listed)
    if listed["long_summary_report"]:
        page = stored_page(store, "long")
        assert {str(r["load_date"]) for r in page.collect()} <= {listed["long_summary_report"][0]}
    if listed["daily_summary"]:
        mail = stored_mail(store)
        old = store.newest("daily_summary", 1)
        known = set() if old is None else {r["code"] for r in old.collect()}
        assert all(r["watch_point"] == "true" for r in mail.collect() if r["code"] not in known)


def test_day_before_is_cut_from_the_later_run(spark, sf, today):
    before, apart = today.day_before(), run_for(spark, sf, with_text=True)
    apart.d, apart.day = BEFORE, F.lit(BEFORE).cast("date")
    assert before.d == BEFORE
    for name in ("bars", "candles", "ema", "candle_ema", "trend", "sar", "sar_pair", "actionable", "index"):
        assert rows(getattr(before, name)) == rows(getattr(apart, name)), name
    assert set(before.ema.inputFiles()) == set(today.ema.inputFiles())  # nothing of it is computed again


def test_first_day_has_an_empty_one_before(spark, sf, tmp_path):
    run = run_for(spark, sf, with_text=True)
    first = run.bars.agg(F.min("load_date")).first()[0]
    run.d, run.day = str(first), F.lit(first)
    before = run.day_before()
    assert before.d < str(first) and before.bars.count() == 0 and before.full_list("long_end").count() == 0


def test_steps_want_what_they_need(spark, today, tmp_path):
    run = EndOfDay(spark, str(tmp_path), today)
    steps = run.steps()
    run.steps = lambda: {"daily_summary": steps["daily_summary"]}
    with pytest.raises(MissingStep, match="daily_long_list"):
        run.go()


def test_newest_snapshot_is_found_without_reading(spark, tmp_path):
    store, days = SnapshotStore(spark, str(tmp_path)), [dt.date(2020, 1, d) for d in (9, 10, 31)]
    for i, d in enumerate(days):
        store.insert("t", spark.createDataFrame([(i, d)], "v int, load_date date"), ["load_date"])
    for file in tmp_path.glob("t/load_date=2020-01-09/*.parquet"):
        file.write_bytes(b"spoilt")
    assert store.dates("t") == ["2020-01-31", "2020-01-10", "2020-01-09"]
    assert [store.newest("t", k).first()["v"] for k in (0, 1)] == [2, 1]
    assert store.newest("t", until="2020-01-30").first()["v"] == 1
    assert store.newest("t", 3) is None and store.newest("none") is None


def test_day_without_rows_is_the_newest_snapshot(spark, tmp_path):
    """A summary that lists no code is stored as such: neither an error nor the older day's rows."""
    columns = "category string, code string, report_date date, price double, ema25 string, sar_buff string, trend string, rec string, financial_healthy double, pe_ranking double, load_date date"
    ranges = spark.createDataFrame([("A", dt.date(2020, 1, 2), 1.0, 0.5)], "code string, load_date date, avg_diff double, std_diff double")

    def go(d, summary):
        run = EndOfDay(spark, str(tmp_path), SimpleNamespace(d=d, day=F.lit(d).cast("date")))
        by_day = {"simple_moving_range": Step(lambda: ranges), "daily_summary": Step(lambda: spark.createDataFrame(summary, columns), ("code", "report_date", "load_date"))}
        by_day["a_ranking"] = Step(lambda: ranges, daily=False)
        run.steps = lambda: by_day
        assert run.go() == list(by_day)
        return run.store

    day = dt.date(2020, 1, 2)
    store = go("2020-01-01", [])
    assert stored_mail(store).count() == 0 and store.newest("daily_summary").columns[0] == "category"
    store = go("2020-01-02", [("S", "A", day, 1.0, "1%", "2%", "t", "Buy", 0.5, 1.0, day)])
    assert [r["code"] for r in stored_mail(store).collect()] == ["A"]
    store = go("2020-01-03", [])
    assert store.dates("daily_summary") == ["2020-01-03", "2020-01-02", "2020-01-01"]
    assert store.newest("daily_summary").count() == 0 and stored_mail(store).count() == 0
    assert store.read("daily_summary", store.dates("daily_summary")).count() == 1
    assert store.dates("a_ranking") == ["2020-01-02"]


def test_what_several_steps_rest_on_is_written_once(today):
    for make in (today.steady, today.direction_list):
        assert make("quarter") is make("quarter") and make("quarter").inputFiles()
    for measure in ("ema", "stb"):
        assert today.ranking(measure, "sar", "long_end") is today.ranking(measure, "sar", "long_end")


def test_fundamentals_older_than_two_weeks_are_cut_before_the_newest_is_sought(spark):
    days = {"A": (1, 20, 29), "B": (1,), "C": (16, 17), "D": (15,), "E": (30,)}
    values = [(c, dt.date(2020, 1, d), 1, 1, 1, -1, float(d), "Buy") for c, all_ in days.items() for d in all_]
    analysis = spark.createDataFrame(values, "code string, load_date date, revenue int, net_income int, net_profit_margin int, ebitda int, fpe double, average_recommendation string")
    cats = spark.createDataFrame([(c, "S") for c in days], "code string, category string")
    out = views.analysis_current(analysis, cats, "2020-01-29")
    assert rows(out.select("code", F.dayofmonth("load_date"))) == [("A", 29), ("C", 17)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("> 2020-01-15") > plan.rindex("Window [")
