from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tapeline.operators import tables
from tapeline.operators.keyindex import KeyIndex
from tapeline.plans import loading
from tapeline.sources import files


def test_insert_ignore_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    new = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("b", 2, "z")], "k string, d int, v string")
    for _ in range(3):
        tables.insert_ignore(spark, path, new, ["k", "d"], [F.col("v")])
    assert rows(spark.read.parquet(path)) == [("a", 1, "x"), ("b", 2, "z")]
    tables.insert_ignore(spark, path, spark.createDataFrame([("b", 2, "new"), ("c", 3, "w")], new.schema), ["k", "d"])
    assert rows(spark.read.parquet(path)) == [("a", 1, "x"), ("b", 2, "z"), ("c", 3, "w")]


def test_insert_ignore_reads_only_the_dates_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [dt.date(2020, 1, i) for i in (1, 2, 3)]
    for d in days:
        tables.insert_ignore(spark, path, spark.createDataFrame([("a", d)], "k string, d date"), ["k", "d"], by="d")
    again = spark.createDataFrame([("a", days[1]), ("b", days[1])], "k string, d date")
    tables.insert_ignore(spark, path, again, ["k", "d"], by="d")
    assert rows(spark.read.parquet(path).select("k", "d")) == [("a", days[0]), ("a", days[1]), ("a", days[2]), ("b", days[1])]


def spoil(path, day):
    """Make the stored rows of a day unreadable."""
    for file in (path / f"d={day}").glob("*.parquet"):
        file.write_bytes(b"spoilt")


def test_insert_reads_no_partition_that_cannot_hold_the_key(spark, tmp_path):
    path, schema = tmp_path / "t", "k string, d date, v int"
    days = [dt.date(2020, 1, i) for i in (1, 2, 3, 4)]
    first = [(f"k{i}", d, i) for d in days[:3] for i in range(50)]
    tables.insert_ignore(spark, str(path), spark.createDataFrame(first, schema), ["k", "d"], by="d")
    for d in days[:2]:
        spoil(path, d)
    # a new day, new keys of a stored day, and stored keys of a day that can be read
    more = [("k1", days[3], 1), ("new", days[0], 2), ("k1", days[2], 3), ("k60", days[2], 4), (None, days[1], 5)]
    for _ in range(2):
        tables.insert_ignore(spark, str(path), spark.createDataFrame([m for m in more if m[0] != "new" or _ == 0], schema), ["k", "d"], by="d")
    left = spark.read.schema(schema).parquet(str(path)).where(F.col("d") >= F.lit(days[2]))
    assert sorted((r["k"], r["d"]) for r in left.collect()) == sorted([(f"k{i}", days[2]) for i in [*range(50), 60]] + [("k1", days[3])])
    with pytest.raises(Exception, match="(?i)parquet|footer"):  # a stored key of a spoilt day has to be looked up
        tables.insert_ignore(spark, str(path), spark.createDataFrame([("k1", days[0], 1)], schema), ["k", "d"], by="d")


def test_key_index_of_full_bitmaps_and_of_older_tables(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k long, d date"
    days = [dt.date(2020, 1, i) for i in (1, 2)]
    old = spark.createDataFrame([(i, d) for d in days for i in range(300)], schema)
    old.write.partitionBy("d").parquet(path)  # stored without an index
    index = KeyIndex(spark, path, ["k", "d"], "d", slots=64)
    new = spark.createDataFrame([(i, days[1]) for i in range(200, 500)], schema)
    assert sorted(r["k"] for r in index.absent(new).collect()) == list(range(300, 500))
    assert index.marked(new).where("_maybe").count() > 290  # every bit is set, the result is exact
    assert KeyIndex(spark, path, ["k", "d"], "d").slots == 64


def test_insert_is_repeated_after_a_crash_between_index_and_data(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k string, d date"
    new = spark.createDataFrame([("a", dt.date(2020, 1, 1)), ("b", dt.date(2020, 1, 2))], schema)
    KeyIndex(spark, path, ["k", "d"], "d").add(new)
    for _ in range(2):
        tables.insert_ignore(spark, path, new, ["k", "d"], by="d")
    assert spark.read.parquet(path).count() == 2


def test_insert_without_partitions_looks_up_only_what_may_be_stored(spark, tmp_path):
    path = tmp_path / "t"
    tables.insert_ignore(spark, str(path), spark.range(100), ["id"])
    for file in path.glob("*.parquet"):
        file.write_bytes(b"spoilt")
    tables.insert_ignore(spark, str(path), spark.range(100, 150), ["id"])
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        tables.insert_ignore(spark, str(path), spark.range(99, 101), ["id"])


def test_null_keys_never_conflict(spark):
    new = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    stored = spark.createDataFrame([(None, 9), ("a", 9)], "k string, v int")
    assert rows(tables.absent_rows(stored, new, ["k"])) == [(None, 1), (None, 2)]


def test_overwrite_may_read_its_own_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    tables.overwrite_snapshot(tables.delete_where(spark.read.parquet(path), F.col("id") < 7), path)
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == [7, 8, 9]


def test_delete_keeps_unknown_rows(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "x int")
    assert rows(tables.delete_where(df, F.col("x") > 3)) == [(1,), (None,)]


def test_backup_appends_with_stamp(spark, tmp_path):
    path = str(tmp_path / "b")
    stamp = F.lit("2020-01-01 00:00:00").cast("timestamp")
    tables.backup_snapshot(spark.range(2), path, stamp)
    tables.backup_snapshot(spark.range(2), path)
    assert spark.read.parquet(path).count() == 4
    assert spark.read.parquet(path).where("year(snapshot_ts) > 2020").count() == 2


def test_split_and_fan_out(spark, tmp_path):
    df = spark.createDataFrame([("EUR", 1), ("JPY", 2), ("EUR", 3)], "instrument string, v int")
    files.split_by(df, "instrument", str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s" / "instrument=EUR")).count() == 2
    paths = [str(tmp_path / f"f{i}") for i in range(3)]
    files.fan_out(df, paths)
    files.fan_out(df, paths)
    assert all(spark.read.parquet(p).count() == 3 for p in paths)


def test_csv_panel(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("code,load_date,close\na,2020-01-02,1.5\nb,2020-01-03,\n")
    got = files.read_csv_panel(spark, str(path), "code string, load_date date, close decimal(8,3)")
    assert [(r[0], r[1], None if r[2] is None else float(r[2])) for r in got.orderBy("code").collect()] == [("a", dt.date(2020, 1, 2), 1.5), ("b", dt.date(2020, 1, 3), None)]


def test_landing_reads_text_and_file_name(spark, tmp_path):
    path = str(tmp_path / "20200102_idxSDC.csv")
    df = spark.createDataFrame([("S&P", "AAA")], "`INDEX NAME` string, RIC string").withColumn("sys_load_time", F.lit("2020-01-02").cast("timestamp_ntz"))
    df.coalesce(1).write.parquet(path)
    got = files.read_landing(spark, path, ["INDEX NAME", "RIC"])
    assert got.columns == ["INDEX NAME", "RIC", "sys_load_time", "source_file"]
    names = spark.createDataFrame([("20200102_idxSDC.csv",)], "f string").select(files.file_record_date(F.col("f")), files.file_info_type(F.col("f"))).first()
    assert tuple(names) == (dt.date(2020, 1, 2), "SDC")


def test_batch_control(spark):
    landing = spark.createDataFrame([("b1", "n", "r", "20200102_SDC.csv"), ("b2", "n", "r", "20200103_SDC.csv")], "batch_id string, `INDEX NAME` string, RIC string, source_file string")
    control = spark.createDataFrame([("b1", True), ("b2", False)], "batch_id string, is_executed boolean")
    got = loading.index_rows(landing, control, {"index_name": "INDEX NAME", "ric": "RIC"})
    assert rows(got) == [("n", "r", "SDC", dt.date(2020, 1, 3))]
    assert tables.open_batches(landing, tables.mark_executed(control)).count() == 0


def test_retention(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, i), i) for i in range(1, 11) for _ in range(2)], "d date, v int")
    assert {r[0].day for r in tables.keep_last_n_dates(df, "d", 3).collect()} == {8, 9, 10}


def test_forex_queue_drains_to_newest_taken(spark):
    q = spark.createDataFrame([(1,), (2,), (3,)], "sys_dt int")
    assert rows(loading.drained(q, q.where("sys_dt <= 2"))) == [(3,)]


def test_insert_computes_new_rows_once(spark, tmp_path):
    """Rows with and without a whole key come from one pass over `new`, and those without are spread."""
    passes = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            passes.add(batch.num_rows)
            yield batch

    kept = [(1, "a", dt.date(2020, 1, 1)), (1, "b", dt.date(2020, 1, 1)), (None, "c", dt.date(2020, 1, 1)), (None, "c", dt.date(2020, 1, 1)), (2, "d", None)]
    schema = "k int, v string, load_date date"
    new = spark.createDataFrame(kept, schema).mapInArrow(seen, schema)
    for runs in (1, 2):  # a second time only the rows without a whole key come again
        tables.insert_ignore(spark, f"{tmp_path}/t", new, ["k", "load_date"], by="load_date")
        assert passes.value == len(kept) * runs
        stored = spark.read.parquet(f"{tmp_path}/t")
        assert rows(stored.where("k = 1").select("v")) == [("a",)]
        assert stored.where("k IS NULL OR load_date IS NULL").count() == 3 * runs
