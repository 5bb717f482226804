"""Log folders whose files store the columns in different types."""

from __future__ import annotations

from conftest import rows

from playlens.sources import events, logs, read_device_log, read_mixed_device_log


def parts(spark):
    text = "device_id STRING, event STRING, payload STRING, time STRING"
    return [spark.createDataFrame([("1", "E1", "p", "2019-01-01T00:00:00"), ("x y", "E 2", "p", None)], text),
            spark.createDataFrame([(2, "E1", "p", "2019-01-01T00:00:00")], text.replace("device_id STRING", "device_id LONG")),
            spark.createDataFrame([(3, "E1", "p")], "device_id INT, event STRING, payload STRING").selectExpr(
                "*", "TIMESTAMP'2019-01-02 00:00:00.5' AS time", "1 AS extra"),
            spark.createDataFrame([(4, "E 2")], "device_id LONG, event STRING")]


WANT = sorted([("1", "E1", "p", "2019-01-01T00:00:00"), ("x y", "E 2", "p", None), ("2", "E1", "p", "2019-01-01T00:00:00"),
               ("3", "E1", "p", "2019-01-02T00:00:00.500000"), ("4", "E 2", None, None)], key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_one_folder_with_all_types(spark, tmp_path):
    for p in parts(spark):
        p.write.mode("append").parquet(str(tmp_path / "log"))
    df = read_mixed_device_log(spark, str(tmp_path / "log"))
    assert df.columns == list(logs.LOG_COLUMNS) and got(df) == WANT
    plan = events(df, "E1")._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x]
    # text; number; number with a timestamp; number without payload or time: one scan for each
    assert len(scans) == 4 and all("EqualTo(event,E1)" in x for x in scans)
    assert not any("extra" in x for x in scans)


def test_partitioned_folders(spark, tmp_path):
    for p in parts(spark)[:3]:
        p.write.mode("append").partitionBy("event").parquet(str(tmp_path / "log"))
    df = read_mixed_device_log(spark, str(tmp_path / "log"))
    assert got(df) == [r for r in WANT if r[0] != "4"]
    plan = events(df, "E 2")._jdf.queryExecution().executedPlan().toString()
    assert all("PartitionFilters: [isnotnull(event" in x for x in plan.splitlines() if "FileScan parquet" in x)
    assert got(events(df, "E 2")) == [("x y", "E 2", "p", None)]


def test_equal_types_are_one_scan(spark, tmp_path):
    for p in parts(spark)[:1] * 3:
        p.write.mode("append").parquet(str(tmp_path / "log"))
    df = read_mixed_device_log(spark, str(tmp_path / "log"))
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert rows(df.na.drop()) == rows(read_device_log(spark, str(tmp_path / "log")).na.drop())


def test_groups_do_not_grow_with_the_files(spark, tmp_path):
    for _ in range(4):
        for p in parts(spark)[:2]:
            p.write.mode("append").parquet(str(tmp_path / "log"))
    df = read_mixed_device_log(spark, str(tmp_path / "log"))
    assert df.count() == 12
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2
