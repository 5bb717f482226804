"""Usage kept up to date span by span equals usage of the whole log."""

from __future__ import annotations

import random

import pytest
from conftest import log_frame, rows

from playlens.config import CohortConfig
from playlens.plans import cohort
from playlens.plans.incremental import UsageState

CFG = CohortConfig(cutoff_date="2019-03-01T00:00:00", reference_date="2018-12-31T00:00:00", analysis_duration=30,
                   long_item_duration_threshold=60)
DAYS = ["2019-01-01", "2019-01-02", "2019-01-03T12:00:00", "2019-01-05", "2019-01-31T12:00:00", "2019-02-20", "2019-05-01"]


def random_log(spark, seed):
    """Plays over midnight and over many days, starts without a finish, copies, connects given twice."""
    rnd = random.Random(seed)
    when = lambda d, s: f"2019-{1 + d // 28:02d}-{1 + d % 28:02d}T{s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}"
    recs = []
    for device in range(12):
        if device != 7:  # never connected
            for day in {rnd.randrange(0, 6), rnd.randrange(0, 50)}:
                recs.append((f"d{device}", "DEVICE_FIRST_TIME_CONNECTED", "", when(day, rnd.randrange(86400))))
        for _ in range(60):
            day, second = rnd.randrange(0, 60), rnd.choice((rnd.randrange(86400), rnd.randrange(86300, 86400), 0))
            item = f'{{"item_name":"{rnd.choice("AB")}.mp3"}}'
            recs.append((f"d{device}", "ITEM_PLAY_STARTED", item, when(day, second)))
            if rnd.random() < 0.7:
                after = rnd.choice((0, 30, 90, 150, 86400, 4 * 86400))
                recs.append((f"d{device}", "ITEM_PLAY_FINISHED", item, when(day + (second + after) // 86400, (second + after) % 86400)))
    recs += rnd.sample(recs, 40) + [(None, "ITEM_PLAY_STARTED", '{"item_name":"A"}', when(3, 3)), ("d1", "ITEM_PLAY_STARTED", "x", None)]
    rnd.shuffle(recs)
    return log_frame(spark, recs)


@pytest.mark.parametrize("seed, spans", [(1, DAYS), (2, ["2019-01-01", "2019-01-03T10:00:00", "2019-05-01"])])
def test_spans_equal_one_run(spark, tmp_path, seed, spans):
    log = random_log(spark, seed).cache()
    content = spark.createDataFrame([("A", "2:00"), ("B", "0:40")], "title STRING, length STRING")
    state = UsageState(spark, str(tmp_path / "state"), CFG)
    for start, stop in zip(spans, spans[1:]):
        state.take_in(log, content, start, stop)
    want = rows(cohort.usage(log, content, CFG), "device_id", "bucket", "count")
    assert want and rows(state.usage(), "device_id", "bucket", "count") == want
    # the last span again: it replaces its own rows only
    state.take_in(log, content, spans[-2], spans[-1])
    assert rows(state.usage(), "device_id", "bucket", "count") == want
    profile = spark.createDataFrame([(f"d{i}", str(i % 3), "F") for i in range(12)], "device_id STRING, age STRING, gender STRING")
    assert rows(state.segments(profile)) == rows(cohort.segment_counts(log, content, profile, CFG))
    with pytest.raises(ValueError):
        state.take_in(log, content, "2019-02-01", "2019-02-01")


def test_a_span_reads_only_its_rows(spark, tmp_path):
    """Rows of other spans are not needed: each span is given a log that holds nothing else."""
    log = random_log(spark, 3).cache()
    content = spark.createDataFrame([("A", "2:00"), ("B", "0:40")], "title STRING, length STRING")
    state = UsageState(spark, str(tmp_path / "state"), CFG)
    spans = ["2019-01-01", "2019-01-20", "2019-02-05T00:00:00", "2019-05-01"]
    for start, stop in zip(spans, spans[1:]):
        state.take_in(log.where(f"time >= '{start}' AND time < '{stop}'"), content, start, stop)
    assert rows(state.usage(), "device_id", "bucket", "count") == rows(cohort.usage(log, content, CFG), "device_id", "bucket", "count")


def test_windows_that_are_over_carry_no_starts(spark, tmp_path):
    log = log_frame(spark, [("d", "DEVICE_FIRST_TIME_CONNECTED", "", "2019-01-01T00:00:01"),
                            ("d", "ITEM_PLAY_STARTED", '{"item_name":"A"}', "2019-01-01T10:00:00")])
    content = spark.createDataFrame([("A", "2:00")], "title STRING, length STRING")
    state = UsageState(spark, str(tmp_path / "state"), CFG)
    assert state.usage().count() == 0 and state.open_starts("2019-01-01").count() == 0
    state.take_in(log, content, "2019-01-01", "2019-01-02")
    assert state.open_starts("2019-01-02").count() == 1
    assert state.open_starts("2019-02-01T00:00:02").count() == 0
