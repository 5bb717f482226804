"""Calendar arithmetic on ISO-8601 text (``YYYY-MM-DDTHH:MM:SS[.fff][Z]``).

Shifted times may be impossible dates such as ``2019-02-31T..``: a shift moves
the month and keeps the day. Casting such text to a timestamp raises under ANSI
mode and ``add_months`` would clamp the day, so every function here works on
the integer parts of the text and returns text. All are native expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playlens.functions._util import as_col, ColumnOrName


def _date_part(s: Column) -> Column:
    return F.split_part(s, F.lit("T"), F.lit(1))


def time_part(s: ColumnOrName) -> Column:
    """Text after the ``T``: clock time with any fraction and zone suffix."""
    return F.split_part(as_col(s), F.lit("T"), F.lit(2))


def split_date(s: ColumnOrName) -> tuple[Column, Column, Column]:
    """(year, month, day) as INT columns; null where a part is not a number.
    Year and month never contain the ``T``, so only the day needs the date part."""
    s = as_col(s)
    y, m = (F.split_part(s, F.lit("-"), F.lit(i)).try_cast("int") for i in (1, 2))
    d = F.split_part(_date_part(s), F.lit("-"), F.lit(3)).try_cast("int")
    return y, m, d


def month_index(s: ColumnOrName) -> Column:
    """Months since year 0: ``year * 12 + month - 1``. Works on ``YYYY-MM`` too."""
    y, m, _ = split_date(s)
    return y * 12 + m - 1


def form_date(year: Column, month: Column, day: Column, time: Column) -> Column:
    """``Y-MM-DDT<time>``: month and day zero-padded, year as is."""
    return F.concat(
        year.cast("string"), F.lit("-"),
        F.lpad(month.cast("string"), 2, "0"), F.lit("-"),
        F.lpad(day.cast("string"), 2, "0"), F.lit("T"), time,
    )


def _from_month_index(idx: Column, day: Column, time: Column) -> Column:
    m0 = F.pmod(idx, F.lit(12))
    return form_date(((idx - m0) / 12).cast("int"), m0 + 1, day, time)


def shift_factor(s: ColumnOrName, ref: ColumnOrName) -> Column:
    """Calendar months from ``ref`` to ``s`` (day and time ignored)."""
    return (month_index(s) - month_index(ref)).cast("int")


def add_months_keep_day(s: ColumnOrName, months: ColumnOrName | int) -> Column:
    """Move ``s`` by whole months, keeping day and time text unchanged."""
    s = as_col(s)
    n = F.lit(months) if isinstance(months, int) else as_col(months)
    _, _, d = split_date(s)
    return _from_month_index(month_index(s) + n, d, time_part(s))


def personal_cutoff(setup: ColumnOrName, analysis_days: int) -> Column:
    """End of a device's analysis window: ``analysis_days // 30`` months after setup."""
    return add_months_keep_day(setup, analysis_days // 30)


def shift_date(s: ColumnOrName, factor: ColumnOrName) -> Column:
    """Move ``s`` back by ``factor`` months, keeping day and time."""
    return add_months_keep_day(s, -as_col(factor))


def day_number(s: ColumnOrName, shift: ColumnOrName | None = None) -> Column:
    """The bucket day count ``year*365 + month*30 + day`` (a 360/365 hybrid).

    With ``shift``: the day count of ``shift_date(s, shift)``, computed on the
    month index directly instead of parsing the shifted text (same value)."""
    y, m, d = split_date(s)
    if shift is None:
        return y * 365 + m * 30 + d
    idx = y * 12 + m - 1 - as_col(shift)
    m0 = F.pmod(idx, F.lit(12))
    return ((idx - m0) / 12).cast("int") * 365 + (m0 + 1) * 30 + d


def day_bucket(s: ColumnOrName, ref: ColumnOrName, bin_days: int,
               shift: ColumnOrName | None = None) -> Column:
    """1-based bin of ``bin_days`` days since ``ref``; floor division, no clamp.
    With ``shift``, both times are first moved back by that many months."""
    diff = day_number(s, shift) - day_number(ref, shift)
    return (F.floor(diff / F.lit(float(bin_days))) + 1).cast("int")


def month_bucket(s: ColumnOrName, ref: ColumnOrName, max_months: int,
                 shift: ColumnOrName | None = None) -> Column:
    """Calendar months from ``ref`` to ``s``; null when above ``max_months``. With
    ``shift``, ``s`` is first moved back by that many months."""
    moved = month_index(s) if shift is None else month_index(s) - as_col(shift)
    diff = (moved - month_index(ref)).cast("int")
    return F.when(diff <= max_months, diff)
