"""The pairing's one exchange on (key, chunk), and what goes back to the starts."""

from __future__ import annotations

from conftest import log_frame
from playlens.operators import pair_plays
from playlens.session import apply_defaults
from test_pairing import random_log, same
from tools.literal_pairing import pair_plays_literal


def joined_log(spark, tmp_path):
    path = str(tmp_path / "log")
    log_frame(spark, random_log(13)).write.parquet(path)
    shift = spark.createDataFrame([("a", 1), ("b", 2)], "device_id STRING, ref INT")
    return spark.read.parquet(path).join(shift.hint("merge"), "device_id")


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_events_joined_by_device_are_paired_by_chunk_and_parsed_once(spark, tmp_path):
    apply_defaults(spark)
    log = joined_log(spark, tmp_path)
    paired = pair_plays(log, carry=["ref"])
    text = final_plan(paired)
    assert text.count("Generate inline") == 1, text
    assert text.count("FileScan parquet") == 1, text
    same(paired, pair_plays_literal(log, carry=["ref"]).select(*paired.columns))


def test_only_chunks_with_an_open_start_go_back_to_the_starts(spark):
    apply_defaults(spark)
    start, finish = "ITEM_PLAY_STARTED", "ITEM_PLAY_FINISHED"
    p, ended = '{"item_name":"A"}', '{"item_name":"A","did_reach_end_of_stream":true}'
    log = log_frame(spark, [
        ("d", start, p, "2019-01-01T10:00:00"), ("d", finish, ended, "2019-01-01T10:00:00"),  # a tie, open if strict
        ("d", start, p, "2019-01-01T11:00:00"), ("d", finish, p, "2019-01-01T11:30:00"),      # open for the ended ones
        ("d", start, p, "2019-01-01T12:00:00"), ("d", finish, ended, "2019-01-01T12:10:00"),
        ("d", start, p, "2019-01-01T12:20:00"),                                                # open, without a finish
    ])
    for strict in (True, False):
        for by_flag in (True, False):
            paired = pair_plays(log, strict=strict, by_flag=by_flag)
            assert "_open0" in paired._jdf.queryExecution().optimizedPlan().toString()
            same(paired, pair_plays_literal(log, strict=strict, by_flag=by_flag).select(*paired.columns))
