"""Monthly variant: active and non-active new devices per month since setup.

Differs from the cohort pipeline: no lifetime filter, pairing on the raw times,
month buckets (1..analysis_duration), epoch durations, no valid-play check,
strict active rule, and an absolute usage threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.config import MonthlyConfig
from playlens.functions.dates import month_bucket
from playlens.functions.payload import ITEM_PLAY_FINISHED, ITEM_PLAY_STARTED
from playlens.operators.accounting import DropCounts
from playlens.operators.computed import with_computed
from playlens.operators.pairing import pair_plays
from playlens.operators.segments import monthly_actives
from playlens.operators.timeshift import first_time_users, of_new_devices
from playlens.operators.usage import count_usage, price_sessions
from playlens.sources.logs import events


def shift_table(log: DataFrame, cfg: MonthlyConfig) -> DataFrame:
    """``device_id, setup_time, shift_factor``: one row per new device."""
    return first_time_users(log, cfg, with_cutoff=False)


def sessions(log: DataFrame, cfg: MonthlyConfig, drops: DropCounts | None = None) -> DataFrame:
    """``device_id, start_time, item_name, end_time, month``.

    The device's shift factor joins the log once and rides through the pairing
    (it is constant per device), so no second join with the shift table is needed.
    """
    shift = shift_table(log, cfg).select("device_id", "shift_factor")
    new_users = of_new_devices(events(log, ITEM_PLAY_STARTED, ITEM_PLAY_FINISHED), shift)
    s = pair_plays(new_users, time_col="time", strict=True, carry=["shift_factor"], drops=drops)
    # Month of the shifted start since the reference month, on month indexes
    # (the shifted text is not needed: it has index ``index(start) - shift``).
    month = month_bucket("start_time", F.lit(cfg.reference_date), int(cfg.analysis_duration), shift="shift_factor")
    return (with_computed(s, "month", month).where(F.col("month") > 0).na.drop()
            .select("device_id", "start_time", "item_name", "end_time", "month"))


def usage_of(sessions_: DataFrame, content: DataFrame, cfg: MonthlyConfig, drops: DropCounts | None = None) -> DataFrame:
    """Usage counts from ``sessions`` (read back from a stage, say)."""
    priced = price_sessions(sessions_, content, duration="epoch", check=False, drops=drops)
    return count_usage(priced, cfg, period="month", strict=True)


def usage(log: DataFrame, content: DataFrame, cfg: MonthlyConfig) -> DataFrame:
    return usage_of(sessions(log, cfg), content, cfg)


def actives(log: DataFrame, content: DataFrame, cfg: MonthlyConfig) -> DataFrame:
    """``month, active, non_active`` ordered by month."""
    return monthly_actives(usage(log, content, cfg), cfg.active_threshold)
