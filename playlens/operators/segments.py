"""Activity classes and user counts per demographic segment."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.config import ABSOLUTE_ACTIVITY, COHORT_LABELS, CohortConfig
from playlens.functions.activity import active_share
from playlens.functions.activity import activity_type as _activity_type
from playlens.operators.accounting import DropCounts


def activity_types(usage: DataFrame, thresholds: Sequence[float], labels: Sequence[str],
                   count_col: str = "count", name: str = "activity_type",
                   otherwise: str = "null") -> DataFrame:
    """Adds the activity class of each usage count (``>=`` thresholds, most active first)."""
    return usage.withColumn(name, _activity_type(count_col, thresholds, labels, otherwise))


def cohort_activity_types(usage: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Classes of the cohort pipeline: fractions of the bin length."""
    return activity_types(usage, cfg.activity_thresholds(), COHORT_LABELS)


def absolute_activity_types(counts: DataFrame, count_col: str = "Activity Count",
                            name: str = "Activity Type") -> DataFrame:
    """Classes of the notebook aggregator: absolute play counts 5 / 3 / 1 / 0."""
    labels = [label for label, _ in ABSOLUTE_ACTIVITY]
    thresholds = [thr for _, thr in ABSOLUTE_ACTIVITY]
    return activity_types(counts, thresholds, labels, count_col=count_col, name=name)


def users_by_segment(usage: DataFrame, profile: DataFrame, cfg: CohortConfig | None = None,
                     thresholds: Sequence[float] | None = None,
                     labels: Sequence[str] = COHORT_LABELS, period: str = "bucket",
                     drops: DropCounts | None = None) -> DataFrame:
    """Devices per (age, gender, activity_type, period) as ``count BIGINT``.

    ``usage`` has one row per (device, period), so the join with the profile
    (one row per device) meets no hot key; devices without a profile drop (counted by
    ``drops`` in rows of ``usage``, step ``profiled``).
    """
    thr = thresholds if thresholds is not None else (cfg or CohortConfig()).activity_thresholds()
    typed = activity_types(usage, thr, labels)
    prof = profile.select("device_id", "age", "gender")
    return (join_profile(typed, prof, drops)
            .groupBy("age", "gender", "activity_type", period)
            .agg(F.count(F.lit(1)).alias("count")))


def join_profile(rows: DataFrame, profile: DataFrame, drops: DropCounts | None = None,
                 weight: Column | None = None) -> DataFrame:
    """Rows with their device's profile; those without one drop, counted where ``drops`` is given."""
    if drops is None:
        return rows.join(profile, "device_id")
    found = rows.join(profile.withColumn("_known", F.lit(True)), "device_id", "left")
    return drops.keep(found, "profiled", {"no profile": F.col("_known").isNull()}, weight).drop("_known")


def monthly_actives(usage: DataFrame, threshold: int = 20, month_col: str = "month",
                    with_share: bool = False) -> DataFrame:
    """Per month: devices with ``count >= threshold`` (active) and below it
    (non_active). Months lacking either kind are left out. Ordered by month."""
    agg = (usage.groupBy(month_col)
           .agg(F.count_if(F.col("count") >= threshold).alias("active"),
                F.count_if(F.col("count") < threshold).alias("non_active"))
           .where((F.col("active") > 0) & (F.col("non_active") > 0)))
    if with_share:
        agg = agg.withColumn("active_share", active_share("active", "non_active"))
    return agg.orderBy(month_col)
