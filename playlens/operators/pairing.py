"""Play sessions: pair every play start with the earliest later finish.

For each distinct start ``s`` of a (device, item) key the session ends at
``min{e : e is a finish of the key, e > s}`` (``strict``) or ``e >= s``. With
``by_flag`` the minimum is taken separately over finishes that reached the end
of the stream and those that did not, so one start can give two sessions.
Pairing is not exclusive: several starts may share one finish.

Plan (all native operators, no Python worker):

1. Project start/finish events to ``(key, t, is_end, flag)`` and drop copies
   with ``distinct``. Its map-side partial aggregate collapses repeated events
   before the shuffle, so a large group of identical rows never reaches a task
   whole, and the shuffle spreads one hot key over many tasks by ``t``.
2. Cut each key's timeline into chunks (a fixed-width prefix of the time: the
   hour by default) and run a running ``min`` of finish times over
   ``partitionBy(key, chunk).orderBy(t DESC)``. A start sees the finishes after
   it in its own chunk. Tie order encodes strictness: a finish at the same
   instant sorts after the start (strict) or before it (non-strict). A hot key
   is split over its chunks, and a chunk holds at most one row per distinct
   instant and kind.
3. Starts whose chunk has no later finish take the earliest finish of the
   next chunks. An aggregate over the same de-duplicated events, from the one
   exchange on (key, chunk), gives one row per chunk with its earliest finish; those rows (at
   most "time span / chunk width" per key) get a running ``min`` over later
   chunks, and those of chunks that hold a start without a finish are left-joined back on
   (key, chunk). The starts side of that join is already partitioned and sorted by
   (key, chunk), so only these rows are shuffled for it, and the events are sorted once.

Chunks order like their times (a text prefix or a truncated timestamp), so every
finish of a later chunk is later than every start of an earlier one, and the
in-chunk answer, when present, is never beaten by a later chunk.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from playlens.functions.payload import (
    ITEM_PLAY_FINISHED, ITEM_PLAY_STARTED, READERS, reached_end, strip_extension,
)
from playlens.operators.accounting import DropCounts

# Chunk widths: characters of ISO text kept / timestamp truncation unit.
_TEXT_PREFIX = {"hour": 13, "day": 10, "month": 7}


def _chunk_of(t: Column, is_text: bool, chunk: str) -> Column:
    if chunk not in _TEXT_PREFIX:
        raise ValueError(f"chunk must be one of {sorted(_TEXT_PREFIX)}")
    if is_text:
        return F.substring(t, 1, _TEXT_PREFIX[chunk])
    return F.date_trunc(chunk, t)


def play_events(log: DataFrame, time_col: str = "time", by_flag: bool = False,
                carry: Sequence[str] = (), drops: DropCounts | None = None, payloads: str = "strict") -> DataFrame:
    """Distinct start/finish events as ``device_id, item_name, *carry, _t, _end, _flag``.

    Rows without device, item or time are dropped: a join never matches nulls,
    whereas a window partition would group them together. ``drops`` counts them (step ``events``).
    ``payloads`` is the payload reader: ``strict`` JSON or ``tolerant``.
    """
    is_end = F.col("event") == F.lit(ITEM_PLAY_FINISHED)
    # One parse per row: as a generator's output, the fields keep later filters on the
    # item from parsing the text again.
    fields = (log.where(F.col("event").isin(ITEM_PLAY_STARTED, ITEM_PLAY_FINISHED))
              .select(F.col("device_id"), *[F.col(c) for c in carry], F.col(time_col).alias("_t"),
                      is_end.alias("_end"),
                      F.inline(F.array(READERS[payloads]("payload"))).alias("_item", "_eos", "_bad")))
    flag = (F.when(F.col("_end"), reached_end("_eos"))
            if by_flag else F.lit(None).cast("boolean"))
    ev = fields.select(F.col("device_id"), strip_extension("_item").alias("item_name"),
                       *[F.col(c) for c in carry], F.col("_t"), F.col("_end"), flag.alias("_flag"))
    if drops is not None:
        ev = drops.keep(ev, "events", {"no device": F.col("device_id").isNull(), "no item": F.col("item_name").isNull(),
                                       "no time": F.col("_t").isNull()})
    not_null = F.col("device_id").isNotNull() & F.col("item_name").isNotNull() & F.col("_t").isNotNull()
    for c in carry:
        not_null = not_null & F.col(c).isNotNull()
    return ev.where(not_null).distinct()


def pair_plays(log: DataFrame, time_col: str = "time", strict: bool = True, by_flag: bool = False,
               carry: Sequence[str] = (), chunk: str = "hour",
               start_col: str = "start_time", end_col: str = "end_time",
               flag_col: str = "reach_end_of_stream", drops: DropCounts | None = None, payloads: str = "strict") -> DataFrame:
    """Sessions ``device_id, item_name, *carry, <start_col>, <end_col>[, <flag_col>]``.

    ``log`` holds ``device_id, event, payload`` and ``time_col`` (ISO text or
    TIMESTAMP; text compares as text). ``carry`` columns must be constant per
    device (e.g. the cohort ``reference``); they ride along as part of the key.
    Starts without a matching finish give no row.
    """
    is_text = isinstance(log.schema[time_col].dataType, StringType)
    return pair_events(play_events(log, time_col, by_flag, carry, drops, payloads), is_text, strict, by_flag, carry, chunk,
                       start_col, end_col, flag_col)


def pair_events(events: DataFrame, is_text: bool = True, strict: bool = True, by_flag: bool = False,
                carry: Sequence[str] = (), chunk: str = "hour",
                start_col: str = "start_time", end_col: str = "end_time",
                flag_col: str = "reach_end_of_stream", keep_open: bool = False) -> DataFrame:
    """``pair_plays`` from the distinct events that ``play_events`` returns. ``keep_open`` also
    returns the starts without a matching finish, with a null ``end_col``."""
    keys = ["device_id", "item_name", *carry]
    # One exchange on (key, chunk) serves the window and the aggregate of the chunks. Without
    # it, events dealt by device (after a join with the devices) would stay so: the window and
    # the aggregate would run in that join's tasks, each with a join and a parse of its own.
    ev = events.withColumn("_chunk", _chunk_of(F.col("_t"), is_text, chunk)).repartition(*keys, "_chunk")

    flags = (True, False) if by_flag else (None,)

    def finish_time(f: bool | None) -> Column:
        cond = F.col("_end") if f is None else (F.col("_end") & (F.col("_flag") == F.lit(f)))
        return F.when(cond, F.col("_t"))

    tie = F.col("_end").asc() if strict else F.col("_end").desc()
    ordered = Window.partitionBy(*keys, "_chunk").orderBy(F.col("_t").desc(), tie)
    in_chunk = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = (ev.select(*keys, "_chunk", "_t", "_end",
                        *[F.min(finish_time(f)).over(in_chunk).alias(f"_in{i}") for i, f in enumerate(flags)])
              .where(~F.col("_end")))

    # One row per chunk (chunks holding only starts included) from an aggregate with a
    # map-side part, then the earliest finish over all later chunks of the key.
    # The count makes the aggregate depend on copies: with minima alone the optimizer
    # would leave the de-duplication out here and read the log a second time for it.
    # A chunk is open if its last start has no finish in it; only open chunks go back to the starts.
    last_start = F.max(F.when(~F.col("_end"), F.col("_t")))

    def is_open(f: bool | None) -> Column:
        last = F.max(finish_time(f))
        found = (last > last_start) if strict else (last >= last_start)
        return last_start.isNotNull() & ~F.coalesce(found, F.lit(False))

    per_chunk = ev.groupBy(*keys, "_chunk").agg(
        *[F.min(finish_time(f)).alias(f"_m{i}") for i, f in enumerate(flags)],
        *[is_open(f).alias(f"_open{i}") for i, f in enumerate(flags)],
        F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 0)
    later = (Window.partitionBy(*keys).orderBy(F.col("_chunk").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    next_chunks = per_chunk.select(
        *keys, "_chunk", *[f"_open{i}" for i in range(len(flags))],
        *[F.min(f"_m{i}").over(later).alias(f"_nx{i}") for i in range(len(flags))]).where(
        reduce(or_, [F.col(f"_open{i}") & F.col(f"_nx{i}").isNotNull() for i in range(len(flags))])).drop(
        *[f"_open{i}" for i in range(len(flags))])

    paired = starts.join(next_chunks, [*keys, "_chunk"], "left")
    ends = [F.coalesce(F.col(f"_in{i}"), F.col(f"_nx{i}")) for i in range(len(flags))]
    out_keys = [F.col(k) for k in keys]
    if not by_flag:
        out = paired.select(*out_keys, F.col("_t").alias(start_col), ends[0].alias(end_col))
        return out if keep_open else out.where(F.col(end_col).isNotNull())
    options = F.array(*[F.struct(F.lit(f).alias(flag_col), e.alias(end_col)) for f, e in zip(flags, ends)])
    out = paired.select(*out_keys, F.col("_t").alias(start_col), F.inline(options)).select(*out_keys, start_col, end_col, flag_col)
    return out if keep_open else out.where(F.col(end_col).isNotNull())
