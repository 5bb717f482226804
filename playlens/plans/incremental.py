"""Cohort usage kept up to date by the log's new time span, without reading the older log again.

The log is taken in by spans of its time text, in order (a day, a month): rows with
``from <= time < to``. What a span leaves behind is enough for the next ones:

* ``users``: devices first connected in the span, with their set-up time. Spans come in order, so
  the earliest row of a device is the right one; later ones are ignored.
* ``sessions``: pairs of the span's plays and of the starts still open before it. A start takes the
  earliest later finish, and every finish of the span is later than an open start, so what an
  earlier span paired stays right. Starts without a finish are kept with a null end: they are the
  open starts, carried on until the device's window is over before the next span begins.
* ``usage``: active plays per device and bin of the span's sessions.

Each is written below ``state/<kind>/span=<from>``; a span that is taken in again (late rows, a repaired file)
replaces its own folders only, and those after it have to be repeated as well, as
their open starts depend on it. Usage counts of spans add up, so the state is read by one aggregate with
a map-side part over rows of (device, bin), not by pairing again.
"""

from __future__ import annotations

import os
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.config import CohortConfig
from playlens.functions.payload import ITEM_PLAY_FINISHED, ITEM_PLAY_STARTED
from playlens.operators.pairing import pair_events, play_events
from playlens.operators.segments import users_by_segment
from playlens.operators.timeshift import analysis_window, first_time_users, of_new_devices
from playlens.plans.cohort import usage_of
from playlens.sources.logs import events
from playlens.sources.sinks import write_parquet

CARRY = ("shift_factor", "setup_time", "cutoff")
USERS = "device_id STRING, setup_time STRING, shift_factor INT, cutoff STRING"
SESSIONS = "device_id STRING, item_name STRING, shift_factor INT, setup_time STRING, cutoff STRING, _start STRING, _end STRING"
USAGE = "device_id STRING, bucket INT, count BIGINT"


class UsageState:
    """Usage of a cohort below the folder ``path``, span by span. The configuration and the content
    map must stay the same from span to span."""

    def __init__(self, spark: SparkSession, path: str, cfg: CohortConfig):
        self.spark, self.path, self.cfg = spark, path, cfg

    def _folder(self, kind: str, start: str) -> str:
        return os.path.join(self.path, kind, f"span={quote(start, safe='')}")  # as Spark writes partition values

    def _read(self, kind: str, schema: str) -> DataFrame:
        try:
            # the span is a folder's name; as text it orders like the times
            return self.spark.read.schema(schema + ", span STRING").parquet(os.path.join(self.path, kind))
        except AnalysisException:  # nothing taken in yet
            return self.spark.createDataFrame([], schema + ", span STRING")

    def users(self, until: str | None = None) -> DataFrame:
        """First-time users of the spans taken in (up to the one that starts at ``until``), one row per device."""
        rows = self._read("users", USERS)
        rows = rows if until is None else rows.where(F.col("span") <= F.lit(until))
        first = rows.groupBy("device_id").agg(F.min(F.struct("setup_time", "shift_factor", "cutoff")).alias("u"))
        return first.select("device_id", "u.*")

    def open_starts(self, before: str) -> DataFrame:
        """Starts without a finish in the spans before, in windows that reach ``before``, as play events."""
        rows = self._read("sessions", SESSIONS).where(F.col("span") < F.lit(before))
        # a start is carried on by every span it outlasts: the last span's rows hold all of them
        last = rows.groupBy().agg(F.max("span").alias("last"))
        held = rows.where(F.col("_end").isNull() & (F.col("cutoff") >= F.lit(before))).join(
            F.broadcast(last), F.col("span") == F.col("last"))  # one row
        return held.select("device_id", "item_name", *CARRY, F.col("_start").alias("_t"), F.lit(False).alias("_end"),
                           F.lit(None).cast("boolean").alias("_flag"))

    def take_in(self, log: DataFrame, content: DataFrame, start: str, stop: str) -> None:
        """Add the log's rows with ``start <= time < stop`` (texts). Spans are taken in by rising time; only rows
        of the span are read from ``log``, which may hold more."""
        if not start < stop:
            raise ValueError(f"an empty span: {start} .. {stop}")
        span = log.where((F.col("time") >= F.lit(start)) & (F.col("time") < F.lit(stop)))
        write_parquet(first_time_users(span, self.cfg), self._folder("users", start))
        users = self.users(until=start)
        plays = events(analysis_window(span, self.cfg), ITEM_PLAY_STARTED, ITEM_PLAY_FINISHED)
        inside = of_new_devices(plays, users).where(F.col("time").between(F.col("setup_time"), F.col("cutoff")))
        both = play_events(inside, carry=CARRY).unionByName(self.open_starts(start)).distinct()
        sessions = pair_events(both, carry=CARRY, start_col="_start", end_col="_end", keep_open=True)
        write_parquet(sessions, self._folder("sessions", start))
        done = self._read("sessions", SESSIONS).where((F.col("span") == F.lit(start)) & F.col("_end").isNotNull())
        write_parquet(usage_of(done.drop("span", "cutoff"), content, self.cfg), self._folder("usage", start))

    def usage(self) -> DataFrame:
        """``device_id, bucket, count`` over all spans taken in."""
        return self._read("usage", USAGE).groupBy("device_id", "bucket").agg(F.sum("count").alias("count"))

    def segments(self, profile: DataFrame) -> DataFrame:
        """Users per segment, activity class and bin over all spans taken in."""
        return users_by_segment(self.usage(), profile, self.cfg)

