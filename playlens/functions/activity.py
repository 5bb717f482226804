"""Scoring rules: active plays, activity classes, percent played and weights."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from playlens.functions._util import as_col, ColumnOrName


def is_valid_play(duration: ColumnOrName, length: ColumnOrName) -> Column:
    """A play is valid when ``0 <= duration <= length`` (null → not valid)."""
    d = as_col(duration)
    return F.coalesce((d >= 0) & (d <= as_col(length)), F.lit(False))


def is_active_play(duration: ColumnOrName, length: ColumnOrName,
                   long_item_seconds: float, min_share: float, strict: bool = False) -> Column:
    """1 when the whole item was played, or when a long item was played long
    enough; else 0. ``strict`` uses ``>`` for both tests (monthly variant)."""
    d, n = as_col(duration), as_col(length)
    share = F.try_divide(d.cast("double"), n.cast("double"))
    if strict:
        long_enough = (n > F.lit(long_item_seconds)) & (share > F.lit(min_share))
    else:
        long_enough = (n >= F.lit(long_item_seconds)) & (share >= F.lit(min_share))
    return F.when(d >= n, 1).when(long_enough, 1).otherwise(0)


def activity_type(count: ColumnOrName, thresholds: Sequence[float], labels: Sequence[str],
                  otherwise: str = "null") -> Column:
    """First label whose threshold the count reaches (``>=``), checked from the
    most active down; below all thresholds gives the text ``otherwise``."""
    c = as_col(count).cast("bigint")
    expr = None
    for thr, label in zip(thresholds, labels):
        cond = c >= F.lit(float(thr))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(otherwise)


def percent_played(played_seconds: ColumnOrName, length_seconds: ColumnOrName) -> Column:
    """played / length as DOUBLE; null for a zero or missing length."""
    return F.try_divide(as_col(played_seconds).cast("double"), as_col(length_seconds).cast("double"))


def play_weight(pct: ColumnOrName, weights: Sequence[float], out_of_range: str = "drop") -> Column:
    """Weight of a play by quarter of the item played: [0,.25), [.25,.5), [.5,.75),
    [.75,1]. ``drop``: other values give null (the row is dropped by the caller).
    ``full``: three quarters only, everything else (null and negative too) → last weight."""
    p = as_col(pct)
    w1, w2, w3, w4 = (F.lit(float(w)) for w in weights)
    q = (F.when((p >= 0.0) & (p < 0.25), w1)
         .when((p >= 0.25) & (p < 0.50), w2)
         .when((p >= 0.50) & (p < 0.75), w3))
    if out_of_range == "drop":
        return q.when((p >= 0.75) & (p <= 1.00), w4)
    if out_of_range == "full":
        return q.otherwise(w4)
    raise ValueError(f"out_of_range must be 'drop' or 'full', not {out_of_range!r}")


def active_share(active: ColumnOrName, non_active: ColumnOrName) -> Column:
    """Share of active users: active / (active + non_active)."""
    a = as_col(active).cast("double")
    return F.try_divide(a, a + as_col(non_active).cast("double"))
