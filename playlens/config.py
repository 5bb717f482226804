"""Run parameters of the three pipelines as immutable value objects.

The defaults are the values the original pipelines ship with; ``from_json``
accepts the nested JSON layout those pipelines read from their config files.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace
from typing import Any, Mapping


@dataclass(frozen=True)
class CohortConfig:
    """Parameters of the cohort pipeline (first-time users → segment counts)."""

    # fixed values: defaults of the cohort pipeline config
    cutoff_date: str = "2019-12-01T00:00:00"
    reference_date: str = "2019-01-01T00:00:00"
    analysis_duration: int = 90
    bin_duration: int = 30
    long_item_duration_threshold: int = 120
    long_item_active_percentage: float = 0.5
    active: float = 1.0
    semi_active: float = 0.5
    rare: float = 0.2
    inactive: float = 0.0

    @classmethod
    def from_json(cls, doc: Mapping[str, Any] | str) -> "CohortConfig":
        if isinstance(doc, str):
            doc = json.loads(doc)
        main = doc.get("main", {})
        usage = doc.get("usage", {})
        act = doc.get("activity", {})
        base = cls()
        return cls(
            cutoff_date=str(main.get("CUTOFF_DATE", base.cutoff_date)),
            reference_date=str(main.get("REFERENCE_DATE", base.reference_date)),
            analysis_duration=int(main.get("ANALYSIS_DURATION", base.analysis_duration)),
            bin_duration=int(main.get("BIN_DURATION", base.bin_duration)),
            long_item_duration_threshold=int(
                usage.get("LONG_ITEM_DURATION_THRESHOLD", base.long_item_duration_threshold)),
            long_item_active_percentage=float(
                usage.get("LONG_ITEM_ACTIVE_PERCENTAGE", base.long_item_active_percentage)),
            active=float(act.get("ACTIVE", base.active)),
            semi_active=float(act.get("SEMI-ACTIVE", base.semi_active)),
            rare=float(act.get("RARE", base.rare)),
            inactive=float(act.get("INACTIVE", base.inactive)),
        )

    def activity_thresholds(self) -> tuple[float, float, float, float]:
        """Per-bin usage thresholds: fraction × bin length in double arithmetic,
        as the original computes them (e.g. ``0.06 * 30`` is ``1.7999999999999998``)."""
        b = float(self.bin_duration)
        return (self.active * b, self.semi_active * b, self.rare * b, self.inactive * b)

    def with_(self, **kw: Any) -> "CohortConfig":
        return replace(self, **kw)


@dataclass(frozen=True)
class PopularityConfig:
    """Weights of the four percent-played quarters (subscription pipeline)."""

    # fixed values: weights of the JSON config (THIRD is 0.67 there, 0.66 in the INI file)
    first: float = 0.00
    second: float = 0.33
    third: float = 0.67
    fourth: float = 1.00

    @classmethod
    def from_json(cls, doc: Mapping[str, Any] | str) -> "PopularityConfig":
        if isinstance(doc, str):
            doc = json.loads(doc)
        w = doc.get("weights", {})
        base = cls()
        return cls(
            first=float(w.get("FIRST", base.first)),
            second=float(w.get("SECOND", base.second)),
            third=float(w.get("THIRD", base.third)),
            fourth=float(w.get("FOURTH", base.fourth)),
        )

    def weights(self) -> tuple[float, float, float, float]:
        return (self.first, self.second, self.third, self.fourth)


@dataclass(frozen=True)
class MonthlyConfig:
    """Parameters of the monthly-actives script (month buckets, epoch durations)."""

    # fixed values: constants hard-coded in the monthly script
    cutoff_date: str = "2019-12"
    reference_date: str = "2019-01"
    analysis_duration: int = 90
    active_threshold: int = 20
    long_item_duration_threshold: int = 120
    long_item_active_percentage: float = 0.5

    @classmethod
    def from_json(cls, doc: Mapping[str, Any] | str) -> "MonthlyConfig":
        """Same layout as the cohort config (``main``/``usage`` sections) plus an
        optional ``monthly.ACTIVE_THRESHOLD``; missing keys keep the defaults."""
        if isinstance(doc, str):
            doc = json.loads(doc)
        main, usage, monthly = doc.get("main", {}), doc.get("usage", {}), doc.get("monthly", {})
        base = cls()
        return cls(
            cutoff_date=str(main.get("CUTOFF_DATE", base.cutoff_date)),
            reference_date=str(main.get("REFERENCE_DATE", base.reference_date)),
            analysis_duration=int(main.get("ANALYSIS_DURATION", base.analysis_duration)),
            active_threshold=int(monthly.get("ACTIVE_THRESHOLD", base.active_threshold)),
            long_item_duration_threshold=int(
                usage.get("LONG_ITEM_DURATION_THRESHOLD", base.long_item_duration_threshold)),
            long_item_active_percentage=float(
                usage.get("LONG_ITEM_ACTIVE_PERCENTAGE", base.long_item_active_percentage)),
        )

    def with_(self, **kw: Any) -> "MonthlyConfig":
        return replace(self, **kw)


# fixed values: labels and absolute thresholds of the notebook user aggregator
ABSOLUTE_ACTIVITY = (("active", 5.0), ("semiactive", 3.0), ("rare", 1.0), ("not active", 0.0))
# fixed values: labels of the cohort user aggregator, most to least active
COHORT_LABELS = ("active", "semiactive", "rare", "inactive")
