"""Session pricing, bucketing and usage counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.config import CohortConfig, MonthlyConfig
from playlens.functions.activity import is_active_play, is_valid_play
from playlens.functions.dates import day_bucket as _day_bucket
from playlens.functions.durations import duration_epoch, duration_time_of_day, length_seconds
from playlens.operators.accounting import DropCounts
from playlens.operators.computed import with_computed


def day_bucket(sessions: DataFrame, cfg: CohortConfig, start_col: str = "start_time",
               ref_col: str = "reference", shift_col: str | None = None) -> DataFrame:
    """Adds ``bucket INT``: 1-based ``bin_duration``-day bin of the start since
    the device's reference date; drops ``reference``. No upper clamp.

    ``shift_col``: the start and reference columns hold unshifted times and this
    column the months to move them back by (the bin is computed on month
    indexes, without building the shifted text)."""
    bucket = _day_bucket(start_col, ref_col, int(cfg.bin_duration), shift_col)
    return sessions.withColumn("bucket", bucket).drop(ref_col)


def price_sessions(sessions: DataFrame, content: DataFrame, duration: str = "time_of_day",
                   check: bool = True, start_col: str = "start_time", end_col: str = "end_time",
                   drops: DropCounts | None = None) -> DataFrame:
    """Join sessions with the content map on ``item_name = title``; add
    ``length`` and ``duration`` in seconds (INT).

    ``duration``: ``time_of_day`` (clock time only: plays over midnight turn
    negative) or ``epoch`` (true elapsed seconds). ``check`` keeps plays with
    ``0 <= duration <= length``. Unknown items drop, and so do plays whose length or
    duration cannot be read; repeated titles fan out. With ``drops`` they are counted (step
    ``priced``); the join then keeps unknown items until they are.
    """
    cm = content.select(F.col("title"), length_seconds("length").alias("_len"))
    j = sessions.join(cm, F.col("item_name") == F.col("title"), "inner" if drops is None else "left")
    if duration == "time_of_day":
        dur = duration_time_of_day(start_col, end_col)
    elif duration == "epoch":
        dur = duration_epoch(start_col, end_col).cast("int")
    else:
        raise ValueError("duration must be 'time_of_day' or 'epoch'")
    j = with_computed(j.withColumnRenamed("_len", "length"), "duration", dur)
    if drops is not None:
        return drops.keep(j, "priced", {
            "unknown item": F.col("title").isNull(), "unreadable length": F.col("length").isNull(),
            "unreadable duration": F.col("duration").isNull(),
            **({"invalid play": ~is_valid_play("duration", "length")} if check else {})})
    j = j.where(F.col("length").isNotNull() & F.col("duration").isNotNull())
    if check:
        j = j.where(is_valid_play("duration", "length"))
    return j


def count_usage(priced: DataFrame, cfg: CohortConfig | MonthlyConfig, period: str = "bucket",
                strict: bool = False) -> DataFrame:
    """Active plays per (device, period) as ``count BIGINT``; a device whose
    plays are all inactive keeps a 0 row. Partial aggregation runs map-side."""
    flag = is_active_play("duration", "length", cfg.long_item_duration_threshold,
                          cfg.long_item_active_percentage, strict=strict)
    return (priced.groupBy("device_id", period)
            .agg(F.sum(flag).cast("bigint").alias("count")))


def count_plays(df: DataFrame, device: str = "device_id", period: str = "bucket",
                name: str = "Activity Count") -> DataFrame:
    """Number of plays per (device, period)."""
    return df.groupBy(device, period).agg(F.count(F.lit(1)).alias(name))
