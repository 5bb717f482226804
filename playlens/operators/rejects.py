"""Rows the pipelines cannot read, listed instead of failing the job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.functions.durations import length_seconds
from playlens.functions.payload import ITEM_PLAY_FINISHED, ITEM_PLAY_STARTED, READERS
from playlens.sources.maps import RAW


def rejected_events(log: DataFrame, payloads: str = "strict") -> DataFrame:
    """Start/finish events that no pipeline can use: the payload (by its reader) is no JSON object or
    has no ``item_name``, the time is missing or no time, or the device is missing.
    The first of these that applies is given."""
    plays = log.where(F.col("event").isin(ITEM_PLAY_STARTED, ITEM_PLAY_FINISHED))
    parsed = plays.select("device_id", "time", F.inline(F.array(READERS[payloads]("payload"))), F.col("payload"))
    no_json = F.col("payload").isNull() | F.col("not_json").isNotNull()
    if payloads == "strict":
        no_json = no_json | ~F.coalesce(F.rtrim("payload").endswith("}"), F.lit(False))
    reason = (F.when(no_json, "payload is not JSON")
              .when(F.col("item_name").isNull(), "no item_name")
              .when(F.col("time").try_cast("timestamp").isNull(), "time is not readable")
              .when(F.col("device_id").isNull(), "no device_id"))
    return (parsed.select(F.lit("log").alias("source"), F.col("device_id").alias("id"),
                          F.col("time"), reason.alias("reason"))
            .where(F.col("reason").isNotNull()))


def rejected_content(content: DataFrame) -> DataFrame:
    """Content-map rows whose length is not ``M:SS``."""
    return (content.where(length_seconds("length").isNull())
            .select(F.lit("content").alias("source"), F.col("title").alias("id"),
                    F.lit(None).cast("string").alias("time"),
                    F.lit("length is not M:SS").alias("reason")))


def rejected_lines(checked: DataFrame, source: str) -> DataFrame:
    """``source, file, line``: the lines of a checked CSV input that cannot be read, as they stand."""
    return checked.where(F.col(RAW).isNotNull()).select(F.lit(source).alias("source"), "file", F.col(RAW).alias("line"))


def rejects(log: DataFrame, content: DataFrame | None = None) -> DataFrame:
    """``source, id, time, reason`` for every unreadable log or content row."""
    out = rejected_events(log)
    if content is not None:
        out = out.unionByName(rejected_content(content))
    return out
