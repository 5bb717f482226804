"""Cohort alignment: first-time users and the time-shifted log."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.config import CohortConfig, MonthlyConfig
from playlens.functions.dates import personal_cutoff, shift_date, shift_factor
from playlens.functions.payload import DEVICE_FIRST_TIME_CONNECTED
from playlens.operators.device_filter import EXPECTED, only_devices_of
from playlens.sources.logs import events


def first_time_users(log: DataFrame, cfg: CohortConfig | MonthlyConfig,
                     with_cutoff: bool = True) -> DataFrame:
    """Devices first connected strictly between the reference and cutoff dates.

    Returns ``device_id, setup_time, shift_factor INT[, cutoff]``: the shift is
    the number of months from the reference month to the setup month; the
    cutoff ends the device's analysis window. Times compare as text. A device
    with several qualifying connect events keeps the earliest (one row per
    device, so later joins do not fan out).
    """
    ftu = (events(log, DEVICE_FIRST_TIME_CONNECTED)
           .where((F.col("time") < F.lit(cfg.cutoff_date)) & (F.col("time") > F.lit(cfg.reference_date))
                  & F.col("device_id").isNotNull())
           .groupBy("device_id").agg(F.min("time").alias("setup_time")))
    cols = [F.col("device_id"), F.col("setup_time"),
            shift_factor("setup_time", F.lit(cfg.reference_date)).alias("shift_factor")]
    if with_cutoff:
        cols.append(personal_cutoff("setup_time", int(cfg.analysis_duration)).alias("cutoff"))
    return ftu.select(*cols)


def of_new_devices(log: DataFrame, ftu: DataFrame, expected: int = EXPECTED) -> DataFrame:
    """Log rows of first-time users, joined with their row of ``ftu`` (one per device).

    A Bloom filter of the devices drops the other rows where they are scanned, so what
    is shuffled grows with the new devices' events and not with the log. Adaptive execution
    broadcasts the user side when its measured bytes allow; else both sides shuffle on
    ``device_id`` and skewed partitions are split."""
    return only_devices_of(log, ftu, expected=expected).join(ftu, "device_id")


def analysis_window(log: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Rows that can lie in some device's window, by fixed bounds that reach the Parquet scan:
    set-up times lie between the reference and the cutoff date, and a window ends
    ``analysis_duration // 30`` months after set-up at the latest. (Months above 12 are no dates.)"""
    year_month = re.match(r"(\d{4})-(\d{2})", cfg.cutoff_date)
    rows = log.where(F.col("time") > F.lit(cfg.reference_date))
    if year_month is None:
        return rows
    index = int(year_month[1]) * 12 + int(year_month[2]) + int(cfg.analysis_duration) // 30  # the month after the last
    return rows.where(F.col("time") < F.lit(f"{index // 12:04d}-{index % 12 + 1:02d}"))


def shift_log(log: DataFrame, ftu: DataFrame) -> DataFrame:
    """Log rows of first-time users inside their own window
    ``setup_time <= time <= cutoff``, with ``time_shifted`` (moved back by the
    device's shift factor) and ``reference`` (the setup time moved back alike).

    The log is reduced before the join (see ``of_new_devices``).
    """
    base = [c for c in log.columns]
    j = of_new_devices(log, ftu)
    j = j.where(F.col("time").between(F.col("setup_time"), F.col("cutoff")))
    return j.select(*[F.col(c) for c in base],
                    shift_date("time", "shift_factor").alias("time_shifted"),
                    shift_date("setup_time", "shift_factor").alias("reference"))
