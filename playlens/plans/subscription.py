"""Subscription content pipeline: device log → weighted popularity per item and segment."""

from __future__ import annotations

from pyspark.sql import DataFrame

from playlens.config import PopularityConfig
from playlens.functions.payload import to_timestamp_lenient
from playlens.operators.accounting import DropCounts
from playlens.operators.pairing import pair_plays
from playlens.operators.popularity import content_popularity, score_plays


def sessions(log: DataFrame, drops: DropCounts | None = None) -> DataFrame:
    """``device_id, item_name, start, end, reach_end_of_stream`` (TIMESTAMP times).

    Non-strict pairing (a finish at the start instant counts) done separately
    for finishes that reached the end of the stream and those that did not.
    """
    timed = log.withColumn("_ts", to_timestamp_lenient("time"))
    return pair_plays(timed, time_col="_ts", strict=False, by_flag=True,
                      start_col="start", end_col="end", drops=drops).select(
        "device_id", "item_name", "start", "end", "reach_end_of_stream")


def scored_of(sessions_: DataFrame, content: DataFrame, cfg: PopularityConfig | None = None,
              out_of_range: str = "drop", drops: DropCounts | None = None) -> DataFrame:
    """Scored plays from ``sessions`` (read back from a stage, say)."""
    # Sessions are distinct by construction; the stage's duplicate drop is a no-op.
    return score_plays(sessions_.na.drop(), content, cfg, out_of_range=out_of_range, bare_names=True, drops=drops)


def scored(log: DataFrame, content: DataFrame, cfg: PopularityConfig | None = None,
           out_of_range: str = "drop") -> DataFrame:
    return scored_of(sessions(log), content, cfg, out_of_range)


def popularity(log: DataFrame, content: DataFrame, profile: DataFrame,
               cfg: PopularityConfig | None = None) -> DataFrame:
    """``item_name, age, gender, weighted_sum``."""
    return content_popularity(scored(log, content, cfg), profile)
