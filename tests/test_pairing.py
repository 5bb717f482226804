"""The chunked linear pairing against the direct join definition."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import log_frame
from playlens.operators import pair_plays
from tools.literal_pairing import pair_plays_literal

START, FINISH = "ITEM_PLAY_STARTED", "ITEM_PLAY_FINISHED"


def random_log(seed: int, n: int = 3000):
    rnd = random.Random(seed)
    days = ["2019-01-01", "2019-01-02", "2019-03-31", "2019-12-31", "2020-01-01"]
    out = []
    for _ in range(n):
        dev = rnd.choice(["a", "b", "c", None])
        item = rnd.choice(["A.mp3", "B.mp3", "C", "Dr. X.mp3"])
        ev = rnd.choice([START, FINISH, FINISH, "OTHER"])
        hh, mm, ss = rnd.choice([0, 1, 23]), rnd.choice([0, 59]), rnd.randrange(0, 4)
        t = f"{rnd.choice(days)}T{hh:02d}:{mm:02d}:{ss:02d}"
        if rnd.random() < 0.05:
            t = t + ".5Z"
        flag = rnd.choice(["true", "false", '"true"', None])
        body = {"item_name": item}
        payload = '{"item_name":"%s"%s}' % (item, "" if flag is None else f',"did_reach_end_of_stream":{flag}')
        if rnd.random() < 0.03:
            payload = rnd.choice(["{}", "garbage", None])
        out.append((dev, ev, payload, None if rnd.random() < 0.01 else t))
        if rnd.random() < 0.2:  # exact copies
            out.append(out[-1])
    return out


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("strict,by_flag", [(True, False), (False, False), (True, True), (False, True)])
@pytest.mark.parametrize("chunk", ["hour", "day"])
def test_linear_equals_literal_text(spark, strict, by_flag, chunk):
    log = log_frame(spark, random_log(7)).cache()
    a = pair_plays(log, strict=strict, by_flag=by_flag, chunk=chunk)
    b = pair_plays_literal(log, strict=strict, by_flag=by_flag)
    same(a, b.select(*a.columns))
    assert a.count() > 100


@pytest.mark.parametrize("strict,by_flag", [(True, True), (False, True), (False, False)])
def test_linear_equals_literal_timestamp(spark, strict, by_flag):
    log = log_frame(spark, random_log(11)).withColumn("ts", F.col("time").try_cast("timestamp")).cache()
    a = pair_plays(log, time_col="ts", strict=strict, by_flag=by_flag, start_col="start", end_col="end")
    b = pair_plays_literal(log, time_col="ts", strict=strict, by_flag=by_flag, start_col="start", end_col="end")
    same(a, b.select(*a.columns))


def test_carry_column_rides_along(spark):
    log = log_frame(spark, random_log(3)).withColumn("ref", F.concat(F.lit("r-"), F.col("device_id")))
    a = pair_plays(log, carry=["ref"])
    b = pair_plays_literal(log, carry=["ref"])
    same(a, b.select(*a.columns))
    assert a.where(F.col("ref") != F.concat(F.lit("r-"), F.col("device_id"))).count() == 0


def test_finish_in_a_much_later_chunk(spark):
    log = log_frame(spark, [
        ("d", START, '{"item_name":"A"}', "2019-01-01T10:59:59"),
        ("d", START, '{"item_name":"A"}', "2019-01-01T12:00:00"),
        ("d", FINISH, '{"item_name":"A"}', "2019-03-05T08:00:00"),
        ("d", FINISH, '{"item_name":"A"}', "2019-03-05T09:00:00"),
    ])
    got = sorted((r.start_time, r.end_time) for r in pair_plays(log).collect())
    assert got == [("2019-01-01T10:59:59", "2019-03-05T08:00:00"), ("2019-01-01T12:00:00", "2019-03-05T08:00:00")]


def test_hot_key_copies_collapse_before_the_window(spark):
    # one key holding most rows, many exact copies: result equals the literal form
    rows_ = [("hot", START, '{"item_name":"A"}', f"2019-01-01T00:{m:02d}:00") for m in range(60)] * 40
    rows_ += [("hot", FINISH, '{"item_name":"A"}', f"2019-01-01T00:{m:02d}:30") for m in range(0, 60, 7)] * 40
    log = log_frame(spark, rows_)
    a = pair_plays(log)
    same(a, pair_plays_literal(log).select(*a.columns))
    assert a.count() == 57
