"""Play durations and item lengths in whole seconds (INT / BIGINT)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playlens.functions._util import as_col, ColumnOrName
from playlens.functions.dates import time_part


def _clock(s: Column) -> tuple[Column, Column, Column]:
    hms = F.substring_index(time_part(s), ".", 1)
    return tuple(F.split_part(hms, F.lit(":"), F.lit(i)).try_cast("int") for i in (1, 2, 3))  # type: ignore[return-value]


def seconds_of_day(s: ColumnOrName) -> Column:
    h, m, sec = _clock(as_col(s))
    return h * 3600 + m * 60 + sec


def duration_time_of_day(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Seconds between the clock times only: a play over midnight is negative."""
    return (seconds_of_day(end) - seconds_of_day(start)).cast("int")


def epoch_seconds_text(s: ColumnOrName) -> Column:
    """Seconds since 1970 of ISO text read as UTC wall time, fraction cut off.
    Impossible dates give null. Independent of the session time zone."""
    s = as_col(s)
    day = F.unix_date(F.split_part(s, F.lit("T"), F.lit(1)).try_cast("date"))
    return day.cast("bigint") * 86400 + seconds_of_day(s)


def duration_epoch(start: ColumnOrName, end: ColumnOrName) -> Column:
    """True elapsed seconds between two ISO texts (fractions cut before subtracting)."""
    return epoch_seconds_text(end) - epoch_seconds_text(start)


def played_for(start_ts: ColumnOrName, end_ts: ColumnOrName) -> Column:
    """Whole-second difference of two TIMESTAMP columns."""
    return F.unix_seconds(as_col(end_ts)) - F.unix_seconds(as_col(start_ts))


def length_seconds(length: ColumnOrName, strict: bool = False) -> Column:
    """``M:SS`` text → seconds. ``strict`` accepts only what a ``%M:%S`` parse
    accepts (minutes and seconds 0-59); otherwise any whole minutes. Bad text → null."""
    t = as_col(length)
    m = F.split_part(t, F.lit(":"), F.lit(1)).try_cast("int")
    s = F.split_part(t, F.lit(":"), F.lit(2)).try_cast("int")
    secs = m * 60 + s
    if not strict:
        return secs.cast("int")
    ok = m.between(0, 59) & s.between(0, 59) & (F.size(F.split(t, ":")) == 2)
    return F.when(ok, secs).cast("int")
