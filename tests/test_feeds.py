"""Batch control: atomic versions, feeds that stop half-way, batches announced meanwhile."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tapeline.operators.control import BatchControl, VersionTaken
from tapeline.plans.feeds import FEEDS, Feed, column_name, load_open_batches



@pytest.fixture
def stamp(spark):
    return F.lit("2020-02-01 08:00:00").cast("timestamp")


class Stopped(RuntimeError):
    pass


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "batch_id string")


def landing(spark, feed: Feed, *given):
    """(batch, file, {column: value}) as landing rows; what is not given is missing."""
    columns = [*feed.columns, "source_file", "batch_id"]
    data = [tuple(values.get(c) for c in feed.columns) + (file, batch) for batch, file, values in given]
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in columns))


def landings(spark):
    sdc = {"INDEX NAME": "S&P", "RIC": "AAA", "IWF": "0.5"}
    sde = {"INDEX NAME": "S&P", "SPIN/TARGET NAME": "Spun"}
    sdl = {"INDEX NAME": "S&P", "DATE OF INDEX": "2020-01-02", "INDEX VALUE": "7"}
    return {
        "sdc": landing(spark, FEEDS["sdc"], ("b1", "20200102_idxSDC.csv", sdc), ("b2", "20200103_idxSDC.csv", sdc), ("b1", "20200102_idxSDX.csv", sdc)),
        "sde": landing(spark, FEEDS["sde"], ("b1", "20200102_SDE.csv", sde), ("b1", "20200102_SDE.csv", sde | {"COMMENTS": "x"}), ("b2", "20200102_SDE.csv", sde | {"STATUS": "later"})),
        "sdl": landing(spark, FEEDS["sdl"], ("b1", "20200102_SDL.csv", sdl), ("b1", "20200102_SDL.csv", sdl | {"INDEX VALUE": "6"}), ("b3", "20200102_SDL.csv", sdl)),
    }


def stored(spark, root, name):
    return spark.read.parquet(f"{root}/{name}")


def test_column_names():
    assert [column_name(c) for c in ("SPIN/TARGET NAME", "SEQUENCE NO.", "RIC")] == ["spin_target_name", "sequence_no", "ric"]
    assert [len(f.columns) for f in FEEDS.values()] == [38, 91, 16]
    assert all(len(set(map(column_name, f.columns))) == len(f.columns) and {k for k in f.keys} <= {*map(column_name, f.columns), "info_type", "record_date"} for f in FEEDS.values())


def test_versions_are_committed_once(spark, tmp_path, stamp):
    control = BatchControl(spark, str(tmp_path / "c"))
    assert control.version() == 0 and control.read().count() == 0
    assert control.announce(ids(spark, "b1", "b2", "b1", None), stamp) == 1
    assert control.announce(ids(spark, "b1"), stamp) == 1  # nothing new, no version
    assert control.announce(ids(spark, "b3"), stamp) == 2
    with pytest.raises(VersionTaken):
        control.flip(1, stamp)  # b3 came meanwhile
    assert not any(r["is_executed"] for r in control.read().collect())
    assert control.flip(2, stamp) == 3
    assert {(r["batch_id"], r["is_executed"]) for r in control.read().collect()} == {("b1", True), ("b2", True), ("b3", True)}
    assert {r["batch_id"] for r in control.read(1).collect()} == {"b1", "b2"}


def test_load_stores_all_feeds_and_flips(spark, tmp_path, stamp):
    control, root = BatchControl(spark, str(tmp_path / "c")), str(tmp_path / "t")
    control.announce(ids(spark, "b1"), stamp)
    assert load_open_batches(spark, control, landings(spark), root, stamp) == 2
    day = dt.date(2020, 1, 2)
    assert rows(stored(spark, root, "sdc").select("index_name", "ric", "iwf", "info_type", "record_date")) == [("S&P", "AAA", "0.5", "SDC", day), ("S&P", "AAA", "0.5", "SDX", day)]
    assert rows(stored(spark, root, "sde").select("current_ric", "comments", "spin_target_name", "record_date")) == [("", "", "Spun", day), ("", "x", "Spun", day)]
    assert rows(stored(spark, root, "sdl").select("index_value")) == [("6",)]  # of two with one key the smaller
    assert {r[0] for name in FEEDS for r in stored(spark, root, name).select("sys_load_time").collect()} == {dt.datetime(2020, 2, 1, 8)}
    control.announce(ids(spark, "b2", "b3"), stamp)
    load_open_batches(spark, control, landings(spark), root, stamp)
    assert [stored(spark, root, name).count() for name in FEEDS] == [3, 2, 1]  # b2's action and b3's level have stored keys
    assert control.read().where("NOT is_executed").count() == 0
    assert load_open_batches(spark, control, landings(spark), root) == control.version()


def test_load_that_stops_between_two_feeds_is_repeated_without_doubles(spark, tmp_path, stamp):
    control, root = BatchControl(spark, str(tmp_path / "c")), str(tmp_path / "t")
    control.announce(ids(spark, "b1", "b2"), stamp)

    def stop_after(feed):
        def told(name):
            if name == feed:
                raise Stopped

        return told

    for feed in ("sdc", "sde"):
        with pytest.raises(Stopped):
            load_open_batches(spark, control, landings(spark), root, stamp, stored=stop_after(feed))
        assert control.read().where("is_executed").count() == 0
    load_open_batches(spark, control, landings(spark), root, stamp)
    assert [stored(spark, root, name).count() for name in FEEDS] == [3, 2, 1]
    assert control.read().where("is_executed").count() == 2


def test_batch_announced_during_a_load_is_loaded_too(spark, tmp_path, stamp):
    control, root = BatchControl(spark, str(tmp_path / "c")), str(tmp_path / "t")
    control.announce(ids(spark, "b1"), stamp)
    seen = []

    def announce(name):
        if not seen:
            seen.append(name)
            control.announce(ids(spark, "b2"), stamp)

    load_open_batches(spark, control, landings(spark), root, stamp, stored=announce)
    assert control.read().where("is_executed").count() == 2
    assert [stored(spark, root, name).count() for name in FEEDS] == [3, 2, 1]
