"""Months and durations of sessions are computed once per row, not again in each filter."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import rows
from playlens.config import MonthlyConfig
from playlens.operators.computed import with_computed
from playlens.operators.usage import price_sessions
from playlens.plans import monthly

LOG = "device_id STRING, event STRING, payload STRING, time STRING"


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_filters_do_not_repeat_months_and_durations(spark):
    log = spark.createDataFrame([("a", "DEVICE_FIRST_TIME_CONNECTED", "", "1995-02-01T00:00:00")], LOG)
    content = spark.createDataFrame([("A", "1:00")], "title STRING, length STRING")
    cfg = MonthlyConfig(cutoff_date="1995-12", reference_date="1995-01", analysis_duration=90, active_threshold=2)
    text = optimized(monthly.usage(log, content, cfg))
    filters = [line for line in text.splitlines() if "Filter " in line and ("end_time" in line or "_t#" in line or "duration" in line)]
    assert filters and not any("split" in line.lower() for line in filters), text


def test_unreadable_durations_drop_and_columns_stay(spark):
    times = [("1995-01-01T10:00:00", "1995-01-01T10:00:40"), ("1995-02-30T10:00:00", "1995-03-01T10:00:00"), ("x", "1995-01-01T10:00:40"),
             ("1995-01-01T10:00:00", "1995-01-01T10:61:75.5"), ("1995-01-01T10:00:00", "1995-01-01T10:00:09Z"), ("1995-01-01T23:59:50", "1995-01-02T00:00:10")]
    s = spark.createDataFrame([("d", f"{i}", a, b, "A") for i, (a, b) in enumerate(times)],
                              "device_id STRING, i STRING, start_time STRING, end_time STRING, item_name STRING")
    content = spark.createDataFrame([("A", "1:00"), ("A", "abc")], "title STRING, length STRING")
    got = price_sessions(s, content, duration="epoch", check=False)
    assert got.columns == [*s.columns, "title", "length", "duration"]
    assert rows(got, "i", "length", "duration") == [("0", 60, 40), ("3", 60, 3735), ("5", 60, 20)]
    assert rows(price_sessions(s, content, duration="time_of_day"), "i", "duration") == [("0", 40), ("1", 0)]


def test_a_computed_column_takes_the_place_of_one_of_its_name(spark):
    df = spark.range(3).select(F.col("id").alias("a"), F.lit(1).alias("b"), F.lit("x").alias("c"))
    got = with_computed(df, "b", F.col("a") * 2)
    assert got.columns == ["a", "b", "c"] and rows(got) == [(0, 0, "x"), (1, 2, "x"), (2, 4, "x")]
