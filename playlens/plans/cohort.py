"""Cohort pipeline: device log → users per (age, gender, activity class, bin).

One lazy plan: first-time users → shifted log → sessions → day bins →
priced plays → usage counts → segment counts. Nothing is written between
the stages, so the event filter and column pruning reach the log scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.config import CohortConfig
from playlens.functions.dates import shift_date
from playlens.functions.payload import ITEM_PLAY_FINISHED, ITEM_PLAY_STARTED
from playlens.operators.accounting import DropCounts
from playlens.operators.pairing import pair_plays
from playlens.operators.segments import users_by_segment
from playlens.operators.timeshift import analysis_window, first_time_users, of_new_devices, shift_log
from playlens.operators.usage import count_usage, day_bucket, price_sessions
from playlens.sources.logs import events


def shifted(log: DataFrame, cfg: CohortConfig) -> DataFrame:
    return shift_log(analysis_window(log, cfg), first_time_users(log, cfg))


def raw_sessions(log: DataFrame, cfg: CohortConfig, drops: DropCounts | None = None) -> DataFrame:
    """Strict pairs of the lifetime-filtered log on the raw times, with the
    device's ``shift_factor`` and ``setup_time``.

    A device has one shift, and moving whole months keeps the order of its
    times, so these are the pairs of the shifted times. Later steps compute
    bins on month indexes and durations on the (unchanged) clock time, and
    build the shifted text only for output columns: expressions that filters
    get pushed into stay small.
    """
    ftu = first_time_users(log, cfg)
    plays = events(analysis_window(log, cfg), ITEM_PLAY_STARTED, ITEM_PLAY_FINISHED)
    j = of_new_devices(plays, ftu)
    j = j.where(F.col("time").between(F.col("setup_time"), F.col("cutoff")))
    return pair_plays(j, time_col="time", strict=True, carry=["shift_factor", "setup_time"],
                      start_col="_start", end_col="_end", drops=drops)


def _shifted(col: str) -> Column:
    return shift_date(col, "shift_factor")


def sessions(log: DataFrame, cfg: CohortConfig) -> DataFrame:
    """``device_id, start_time, item_name, end_time, reference`` (shifted times)."""
    s = raw_sessions(log, cfg)
    return s.select("device_id", _shifted("_start").alias("start_time"), "item_name",
                    _shifted("_end").alias("end_time"), _shifted("setup_time").alias("reference"))


def _bucketed_raw(raw: DataFrame, cfg: CohortConfig) -> DataFrame:
    return day_bucket(raw, cfg, start_col="_start", ref_col="setup_time", shift_col="shift_factor")


def bucketed(log: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Sessions with ``bucket INT`` (reference dropped)."""
    b = _bucketed_raw(raw_sessions(log, cfg), cfg)
    return b.select("device_id", _shifted("_start").alias("start_time"), "item_name",
                    _shifted("_end").alias("end_time"), "bucket")


def _priced_raw(raw: DataFrame, content: DataFrame, cfg: CohortConfig, drops: DropCounts | None = None) -> DataFrame:
    # Sessions are distinct by construction (one row per start), so the
    # original stage's duplicate drop would be a shuffle with no effect; only
    # the null drop is kept. Clock-time durations of the shifted times equal
    # those of the raw times (a month shift keeps the time text).
    return price_sessions(_bucketed_raw(raw, cfg).na.drop(), content,
                          start_col="_start", end_col="_end", drops=drops)


def priced(log: DataFrame, content: DataFrame, cfg: CohortConfig) -> DataFrame:
    p = _priced_raw(raw_sessions(log, cfg), content, cfg)
    return p.select("device_id", _shifted("_start").alias("start_time"), "item_name",
                    _shifted("_end").alias("end_time"), "bucket", "title", "length", "duration")


def usage_of(raw: DataFrame, content: DataFrame, cfg: CohortConfig, drops: DropCounts | None = None) -> DataFrame:
    """Usage counts from ``raw_sessions`` (read back from a stage, say)."""
    return count_usage(_priced_raw(raw, content, cfg, drops), cfg)


def usage(log: DataFrame, content: DataFrame, cfg: CohortConfig) -> DataFrame:
    return usage_of(raw_sessions(log, cfg), content, cfg)


def segment_counts(log: DataFrame, content: DataFrame, profile: DataFrame, cfg: CohortConfig) -> DataFrame:
    """``age, gender, activity_type, bucket, count``."""
    return users_by_segment(usage(log, content, cfg), profile, cfg)
