"""Columns that are computed once per row, whatever reads them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``withColumn`` for a costly ``value`` that filters read.

    A filter on a projected column is pushed down with the whole expression in place of the column, once for
    each mention, and again below the next join; there its common parts are computed again each time, and
    the code of such a step can outgrow what the JVM compiles. A generator's output stays a
    column: the projection below it computes common parts once."""
    made = df.withColumn(name, value)
    others = [F.col(c) for c in made.columns if c != name]
    return made.select(*others, F.inline(F.array(F.struct(F.col(name))))).select(*made.columns)
