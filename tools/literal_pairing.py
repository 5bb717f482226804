"""Pairing by its direct definition, for checks and the benchmark baseline only.

Joins each start with every later finish of its (device, item) key and keeps
the minimum, as the original pipelines did. Its cost grows with starts ×
finishes per key and a hot key lands in one task, so it is not part of the
library; the library's ``playlens.operators.pair_plays`` is the linear form.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.operators.pairing import play_events


def pair_plays_literal(log: DataFrame, time_col: str = "time", strict: bool = True,
                       by_flag: bool = False, carry: Sequence[str] = (),
                       start_col: str = "start_time", end_col: str = "end_time",
                       flag_col: str = "reach_end_of_stream") -> DataFrame:
    """Sessions by the direct definition (same columns as ``pair_plays``)."""
    ev = play_events(log, time_col, by_flag, carry)
    keys = ["device_id", "item_name", *carry]
    s = ev.where(~F.col("_end")).select(*keys, F.col("_t").alias(start_col))
    e = ev.where(F.col("_end")).select(*keys, F.col("_t").alias("_e"), F.col("_flag").alias(flag_col))
    cond = (F.col(start_col) < F.col("_e")) if strict else (F.col(start_col) <= F.col("_e"))
    j = s.join(e, keys).where(cond)
    group = [*keys, start_col] + ([flag_col] if by_flag else [])
    out = j.groupBy(*group).agg(F.min("_e").alias(end_col))
    return out.select(*keys, start_col, end_col, *([flag_col] if by_flag else []))
