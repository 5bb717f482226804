"""Counts of the rows that a step leaves out, gathered in the pass that leaves them out.

The original joins drop rows without a word: plays of unknown items, devices without a profile,
events that cannot be read. Here a step is given the reasons for dropping a row, in order; each row
is counted under the first that holds, by ``DataFrame.observe``, so no second pass over the
data and no anti-join is needed. The counts are known once an action has run the plan. (A stage
that Spark has to run again after losing an executor may count its rows again.)
"""

from __future__ import annotations

from typing import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class DropCounts:
    """Collects the counts of the steps of one action."""

    def __init__(self) -> None:
        self._steps: dict[str, Observation] = {}

    def keep(self, df: DataFrame, step: str, reasons: Mapping[str, Column], weight: Column | None = None) -> DataFrame:
        """Rows of ``df`` for which no reason holds. ``weight`` (one by default) is what a row counts."""
        if step in self._steps:
            raise ValueError(f"step {step} is counted already")
        held = None
        for name, reason in reasons.items():
            held = F.when(reason, name) if held is None else held.when(reason, name)
        n = F.lit(1) if weight is None else weight
        first = F.col("_dropped")
        seen = self._steps[step] = Observation(step)
        rows = df.withColumn("_dropped", held).observe(
            seen, F.coalesce(F.sum(n), F.lit(0)).alias("rows"),
            *[F.coalesce(F.sum(F.when(first == name, n)), F.lit(0)).alias(name) for name in reasons])
        return rows.where(first.isNull()).drop("_dropped")

    def counts(self) -> dict[str, dict[str, int]]:
        """``step -> rows and reason -> count``, after the action; all rows of the step are ``rows``.

        A step that Spark left out of the plan while it ran, since an input turned out empty, has
        counted nothing and is not listed."""
        found = {step: _metrics(seen) for step, seen in self._steps.items()}
        return {step: {k: int(v) for k, v in seen.items()} for step, seen in found.items() if seen is not None}


def _metrics(seen: Observation) -> dict | None:
    try:
        return seen.get
    except Py4JJavaError as e:  # a row without names stands for a node that was left out
        if e.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return None


def keep(df: DataFrame, step: str, reasons: Mapping[str, Column], drops: DropCounts | None,
         weight: Column | None = None) -> DataFrame:
    """``df`` without the rows a reason holds for, counted where ``drops`` is given."""
    if drops is not None:
        return drops.keep(df, step, reasons, weight)
    for reason in reasons.values():
        df = df.where(~F.coalesce(reason, F.lit(False)))
    return df
