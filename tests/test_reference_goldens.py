"""Goldens of the original unit tests, compared after casting to the typed schema."""

from __future__ import annotations

import pytest

from conftest import log_frame, rows
from playlens.config import CohortConfig, PopularityConfig
from playlens.operators import (
    content_popularity, count_plays, count_usage, day_bucket, first_time_users, pair_plays,
    price_sessions, score_plays, shift_log, users_by_segment,
)

CONNECT, START, FINISH = "DEVICE_FIRST_TIME_CONNECTED", "ITEM_PLAY_STARTED", "ITEM_PLAY_FINISHED"
CFG = CohortConfig()


def test_first_time_users_range_and_shift(spark):
    log = log_frame(spark, [
        ("00", CONNECT, "", "2018-08-01T00:00:00"),
        ("01", CONNECT, "", "2020-08-01T00:00:00"),
        ("02", "EVENT1", "", "2019-08-01T00:00:00"),
        ("03", CONNECT, "", "2019-08-01T00:00:00"),
        ("04", CONNECT, "", "2019-11-01T00:00:00"),
    ])
    got = rows(first_time_users(log, CFG), "device_id", "shift_factor", "setup_time", "cutoff")
    assert got == [("03", 7, "2019-08-01T00:00:00", "2019-11-01T00:00:00"),
                   ("04", 10, "2019-11-01T00:00:00", "2020-02-01T00:00:00")]


def test_shift_log_lifetime_filter_and_reference(spark):
    log = log_frame(spark, [
        ("00", CONNECT, "", "2019-08-01T00:00:00"),
        ("03", START, "", "2018-08-01T00:00:00"),
        ("03", START, "", "2019-10-01T00:00:00"),
        ("04", START, "", "2020-08-01T00:00:00"),
        ("04", START, "", "2019-11-01T00:00:00"),
    ])
    ftu = spark.createDataFrame(
        [("03", "2019-08-01T00:00:00", 7, "2019-11-01T00:00:00"),
         ("04", "2019-11-01T00:00:00", 10, "2020-02-01T00:00:00")],
        "device_id STRING, setup_time STRING, shift_factor INT, cutoff STRING")
    got = rows(shift_log(log, ftu), "device_id", "event", "time", "time_shifted", "reference")
    assert got == [("03", START, "2019-10-01T00:00:00", "2019-03-01T00:00:00", "2019-01-01T00:00:00"),
                   ("04", START, "2019-11-01T00:00:00", "2019-01-01T00:00:00", "2019-01-01T00:00:00")]


def test_pairing_earliest_finish_wins(spark):
    log = spark.createDataFrame([
        ("00", CONNECT, "", "2019-01-10T00:00:00", "2019-01-10T00:00:00"),
        ("00", START, '{"item_name":"A.mp3"}', "2019-03-11T00:00:00", "2019-01-10T00:00:00"),
        ("00", FINISH, '{"item_name":"A.mp3"}', "2019-03-11T00:00:01", "2019-01-10T00:00:00"),
        ("00", FINISH, '{"item_name":"A.mp3"}', "2019-03-11T00:00:02", "2019-01-10T00:00:00"),
    ], "device_id STRING, event STRING, payload STRING, time_shifted STRING, reference STRING")
    got = rows(pair_plays(log, time_col="time_shifted", carry=["reference"]),
               "device_id", "start_time", "item_name", "end_time", "reference")
    assert got == [("00", "2019-03-11T00:00:00", "A", "2019-03-11T00:00:01", "2019-01-10T00:00:00")]


def test_day_buckets(spark):
    s = spark.createDataFrame(
        [("00", f"2019-0{m}-11T00:00:00", "A", f"2019-0{m}-11T00:00:01", "2019-01-10T00:00:00") for m in (1, 2, 3)],
        "device_id STRING, start_time STRING, item_name STRING, end_time STRING, reference STRING")
    out = day_bucket(s, CFG)
    assert "reference" not in out.columns
    assert rows(out, "start_time", "bucket") == [
        ("2019-01-11T00:00:00", 1), ("2019-02-11T00:00:00", 2), ("2019-03-11T00:00:00", 3)]


def _priced_input(spark):
    s = spark.createDataFrame([
        ("00", "2019-01-11T00:00:00", "A", "2019-01-11T00:05:00", 1),
        ("00", "2019-02-11T00:00:00", "B", "2019-02-11T00:10:00", 2),
        ("00", "2019-03-11T00:00:00", "C", "2019-03-11T00:00:30", 3),
    ], "device_id STRING, start_time STRING, item_name STRING, end_time STRING, bucket INT")
    cm = spark.createDataFrame([("A", "10:00"), ("B", "30:00"), ("C", "0:20")], "title STRING, length STRING")
    return s, cm


def test_price_sessions_lengths_and_check(spark):
    s, cm = _priced_input(spark)
    got = rows(price_sessions(s, cm), "item_name", "title", "length", "duration", "bucket")
    assert got == [("A", "A", 600, 300, 1), ("B", "B", 1800, 600, 2)]


def test_usage_counts(spark):
    s, cm = _priced_input(spark)
    got = rows(count_usage(price_sessions(s, cm), CFG), "device_id", "bucket", "count")
    assert got == [("00", 1, 1), ("00", 2, 0)]


def test_users_by_segment_thresholds(spark):
    usage = spark.createDataFrame(
        [(f"0{d}", b, c) for d in range(6) for b, c in ((1, 30), (2, 10), (3, 1))],
        "device_id STRING, bucket INT, count BIGINT")
    profile = spark.createDataFrame(
        [(f"0{d}", g, str(d + 1)) for d, g in enumerate("MMMFFF")], "device_id STRING, gender STRING, age STRING")
    got = rows(users_by_segment(usage, profile, CFG), "age", "gender", "activity_type", "bucket", "count")
    expected = sorted((str(d + 1), g, t, b, 1) for d, g in enumerate("MMMFFF")
                      for t, b in (("active", 1), ("rare", 2), ("inactive", 3)))
    assert got == expected


def test_content_popularity_golden(spark):
    items = ["Pop Goes the Weasel2", "Pop Goes the Weasel2", "Humpty Dumpty", "Pop Goes the Weasel2",
             "Humpty Dumpty", "Pop Goes the Weasel2", "Humpty Dumpty", "Humpty Dumpty",
             "Pop Goes the Weasel2", "Pop Goes the Weasel2", "Pop Goes the Weasel2",
             "Pop Goes the Weasel2", "Humpty Dumpty", "Pop Goes the Weasel2", "The Wheels on the Bus",
             "Five Little Monkeys", "Humpty Dumpty", "Humpty Dumpty"]
    weights = [0.33, 0.0, 1.0, 0.66, 0.33, 0.0, 1.0, 0.0, 1.0, 0.33, 0.66, 0.66, 1.0, 0.0, 1.0, 0.33, 0.0, 1.0]
    scored = spark.createDataFrame(
        [(f"0{i // 3}", it, 0.0, w) for i, (it, w) in enumerate(zip(items, weights))],
        "device_id STRING, item_name STRING, PercentPlayed DOUBLE, weight DOUBLE")
    profile = spark.createDataFrame(
        [("00", "M", "1"), ("01", "M", "2"), ("02", "M", "3"), ("03", "F", "4"), ("04", "F", "1"), ("05", "M", "1")],
        "device_id STRING, gender STRING, age STRING")
    got = [(i, a, g, round(w, 6)) for i, a, g, w in
           rows(content_popularity(scored, profile), "item_name", "age", "gender", "weighted_sum")]
    assert got == sorted([
        ("Five Little Monkeys", "1", "M", 0.33), ("Humpty Dumpty", "1", "F", 1.0),
        ("Humpty Dumpty", "1", "M", 2.0), ("Humpty Dumpty", "2", "M", 0.33),
        ("Humpty Dumpty", "3", "M", 1.0), ("Pop Goes the Weasel2", "1", "F", 0.0),
        ("Pop Goes the Weasel2", "1", "M", 0.33), ("Pop Goes the Weasel2", "2", "M", 0.66),
        ("Pop Goes the Weasel2", "3", "M", 1.0), ("Pop Goes the Weasel2", "4", "F", 1.65),
        ("The Wheels on the Bus", "1", "F", 1.0)])


def test_score_plays_intended_golden(spark):
    import datetime as dt
    t = lambda hh, mm: dt.datetime(2005, 6, 1, hh, mm)
    s = spark.createDataFrame([
        ("0", "Black Beauty Part 1 The Spring Hunt.mp3", t(13, 33), t(13, 30), False),
        ("1", "The Peacock.mp3", t(13, 33), t(13, 50), True),
        ("1", "Phonics.mp3", t(13, 33), t(13, 34), False),
        ("1", "Pizza Moon.mp3", t(13, 33), t(13, 34), True),
        ("1", "Pop Goes the Weasel2.mp3", t(13, 33), t(13, 34), False),
    ], "device_id STRING, item_name STRING, start TIMESTAMP, end TIMESTAMP, reach_end_of_stream BOOLEAN")
    cm = spark.createDataFrame([
        ("Black Beauty Part 1 The Spring Hunt", "4:15"), ("The Peacock", "2:35"), ("Phonics", "4:01"),
        ("Pizza Moon", "3:20"), ("Pop Goes the Weasel2", "0:41")], "Title STRING, Length STRING")
    got = rows(score_plays(s, cm.toDF("title", "length"), PopularityConfig()),
               "device_id", "item_name", "PercentPlayed", "weight")
    assert got == [("1", "Phonics", pytest.approx(0.24896265560165975), 0.0), ("1", "Pizza Moon", 0.3, 0.33)]


def test_play_counts_sample(spark):
    # fixed values: the usage-input sample (device, content, period) and its counts
    sample = [(11, 1, "1")] + [(11, 2, "1")] * 5 + [(11, 2, "2")] * 8 + [(22, 2, "1")] * 2 + [(22, 2, "2")] * 3
    df = spark.createDataFrame(sample, "`Device ID` INT, `Content ID` INT, `Time Period` STRING")
    got = rows(count_plays(df, "Device ID", "Time Period"), "Device ID", "Time Period", "Activity Count")
    assert got == [(11, "1", 6), (11, "2", 8), (22, "1", 2), (22, "2", 3)]


def test_absolute_activity_types_rule(spark):
    from playlens.operators import absolute_activity_types
    df = spark.createDataFrame([(c,) for c in (8, 6, 3, 2, 5, 2)], "`Activity Count` BIGINT")
    got = [r["Activity Type"] for r in absolute_activity_types(df).collect()]
    assert got == ["active", "active", "semiactive", "rare", "active", "rare"]


def test_full_weight_variant_keeps_unmatched_rows(spark):
    import datetime as dt
    t = dt.datetime(2005, 6, 1, 13, 33)
    s = spark.createDataFrame([
        ("1", "Phonics.mp3", t, t + dt.timedelta(seconds=60), False),     # 60/241 → first quarter
        ("1", "Unknown.mp3", t, t + dt.timedelta(seconds=60), True),      # no content row
        ("2", "Pizza Moon.mp3", t, t + dt.timedelta(seconds=400), True),  # over 100 % → full weight
    ], "device_id STRING, item_name STRING, start TIMESTAMP, end TIMESTAMP, reach_end_of_stream BOOLEAN")
    cm = spark.createDataFrame([("Phonics", "4:01"), ("Pizza Moon", "3:20"), ("Never Played", "1:00")],
                               "title STRING, length STRING")
    out = score_plays(s, cm, PopularityConfig(), out_of_range="full")
    got = [(r.device_id, r.item_name, r.weight) for r in out.collect()]
    assert sorted(got, key=str) == sorted([("1", "Phonics", 0.0), ("1", "Unknown", 1.0), ("2", "Pizza Moon", 1.0),
                                           (None, "Never Played", 1.0)], key=str)
