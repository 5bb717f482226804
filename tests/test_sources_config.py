"""Readers, preview and configuration loading."""

from __future__ import annotations

from conftest import rows
from playlens.config import CohortConfig, MonthlyConfig, PopularityConfig
from playlens.session import scratch_path
from playlens.sources import clean, preview, read_content_map_parquet, with_length_seconds, write_parquet


def test_content_map_from_parquet_any_case(spark):
    p = scratch_path(spark, "cm-parquet")
    write_parquet(spark.createDataFrame([("Phonics", "4:01"), ("Pizza Moon", "3:20")], "Title STRING, Length STRING"), p)
    cm = with_length_seconds(read_content_map_parquet(spark, p), strict=True)
    assert rows(cm) == [("Phonics", "4:01", 241), ("Pizza Moon", "3:20", 200)]


def test_preview_and_clean(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("c", 3)], "k STRING, v INT")
    assert preview(df, 2).count() == 2
    assert rows(clean(df)) == [("a", 1), ("c", 3)]


def test_config_from_original_json_layout():
    cohort = CohortConfig.from_json({
        "main": {"CUTOFF_DATE": "2019-12-01T00:00:00", "REFERENCE_DATE": "2019-01-01T00:00:00",
                 "ANALYSIS_DURATION": 90, "BIN_DURATION": 30},
        "usage": {"LONG_ITEM_DURATION_THRESHOLD": 120, "LONG_ITEM_ACTIVE_PERCENTAGE": 0.5},
        "activity": {"ACTIVE": 1.0, "SEMI-ACTIVE": 0.5, "RARE": 0.2, "INACTIVE": 0}})
    assert cohort == CohortConfig()
    assert cohort.activity_thresholds() == (30.0, 15.0, 6.0, 0.0)
    weights = PopularityConfig.from_json('{"weights": {"FIRST": 0.0, "SECOND": 0.33, "THIRD": 0.66, "FOURTH": 1.0}}')
    assert weights.weights() == (0.0, 0.33, 0.66, 1.0)
    assert MonthlyConfig().active_threshold == 20
    m = MonthlyConfig.from_json({"main": {"CUTOFF_DATE": "1995-12", "REFERENCE_DATE": "1995-01"},
                                 "monthly": {"ACTIVE_THRESHOLD": 2}})
    assert (m.cutoff_date, m.reference_date, m.active_threshold, m.analysis_duration) == ("1995-12", "1995-01", 2, 90)


def test_device_log_with_numeric_ids_and_timestamp_times(spark):
    import datetime as dt
    from playlens.sources import read_device_log
    p = scratch_path(spark, "typed-log")
    t = dt.datetime(2019, 3, 11, 0, 0, 1, 500000)
    write_parquet(spark.createDataFrame([(7, "ITEM_PLAY_STARTED", "{}", t)],
                                        "device_id BIGINT, event STRING, payload STRING, time TIMESTAMP"), p)
    got = read_device_log(spark, p).first()
    assert (got.device_id, got.time) == ("7", "2019-03-11T00:00:01.500000")


def test_maps_are_read_by_column_name(spark, tmp_path):
    import pytest
    from playlens.sources import read_content_map, read_profile
    (tmp_path / "p.csv").write_text("device_id,gender,note,age\n1,F,x,2\n")
    assert rows(read_profile(spark, str(tmp_path / "p.csv")), "device_id", "age", "gender") == [("1", "2", "F")]
    (tmp_path / "c.csv").write_text("id,Length,Title\n9,4:01,Phonics\n")
    assert rows(read_content_map(spark, str(tmp_path / "c.csv")), "title", "length") == [("Phonics", "4:01")]
    (tmp_path / "bad.csv").write_text("id,title\n9,Phonics\n")
    with pytest.raises(ValueError, match="length"):
        read_content_map(spark, str(tmp_path / "bad.csv"))
