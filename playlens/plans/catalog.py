"""Named queries over the driver test tables, one per operator group.

Every query derives its input from the parquet tables through ``adapter`` and
runs over all rows. The configurations below are the ones the checks use.
"""

from __future__ import annotations

from dataclasses import asdict
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.config import COHORT_LABELS, CohortConfig, MonthlyConfig, PopularityConfig
from playlens.functions.durations import length_seconds
from playlens.functions.payload import (
    ITEM_PLAY_FINISHED, ITEM_PLAY_STARTED, end_of_stream, item_name, reached_end, split_item_name, strip_extension,
    tolerant_fields,
)
from playlens.operators.dashboard import (
    activity_chart, dashboard_functions, dashboard_views, segmentations, select_function, to_dashboard,
)
from playlens.operators.rejects import rejected_lines, rejects
from playlens.operators.segments import absolute_activity_types, cohort_activity_types, monthly_actives
from playlens.operators.timeshift import first_time_users
from playlens.operators.usage import count_plays
from playlens.plans import adapter, cohort, monthly, subscription
from playlens.plans.incremental import UsageState
from playlens.plans.stages import Stages
from playlens.session import scratch_path
from playlens.sources.logs import clean, events, read_mixed_device_log
from playlens.sources.maps import (
    read_checked_csv, read_content_map, read_content_map_parquet, read_profile, read_usage_input,
)
from playlens.sources.sinks import write_csv, write_parquet, write_single_parquet

# The adapter log spans 1995-2001, so the cohort window is set in 1995. Usage
# counts per 30-day bin stay small on these tables, so the activity fractions
# are lowered (× 30 = 3, 1.8, 0.9, 0) to give every class a non-empty result.
COHORT = CohortConfig(cutoff_date="1995-12-01T00:00:00", reference_date="1995-01-01T00:00:00",
                      analysis_duration=90, bin_duration=30,
                      active=0.1, semi_active=0.06, rare=0.03, inactive=0.0)
POPULARITY = PopularityConfig()
MONTHLY = MonthlyConfig(cutoff_date="1995-12", reference_date="1995-01", analysis_duration=90,
                        active_threshold=2)
#: Spans in which the log of the cohort's window is taken in one after another.
SPANS = ("1995-01-01", "1995-05-15T12:00:00", "1995-09-01", "1995-11-03T09:30:00", "1996-04-01")
FILTER_AGE, FILTER_GENDER = 1, "F"

Query = Callable[[SparkSession, str], DataFrame]


def _log(spark: SparkSession, sf: str) -> DataFrame:
    return adapter.stored_log(spark, sf)


def read_clean_log(spark, sf):
    return clean(_log(spark, sf))


def content_map_load(spark, sf):
    path = scratch_path(spark, "content-map-csv")
    cm = adapter.content_map(spark, sf)
    write_csv(cm.select(F.lit("x").alias("Note"), F.col("length").alias("Length"), F.col("title").alias("Title")), path)
    cm = read_content_map(spark, path)
    return cm.select("title", "length", length_seconds("length").alias("length_seconds"),
                     length_seconds("length", strict=True).alias("length_seconds_strict"))


def profile_load(spark, sf):
    path = scratch_path(spark, "profile-csv")
    write_csv(adapter.profile(spark, sf).select("gender", F.lit("x").alias("note"), "age", "device_id"), path)
    return read_profile(spark, path)


def content_map_parquet(spark, sf):
    path = scratch_path(spark, "content-map")
    write_parquet(adapter.content_map(spark, sf).select(F.col("length").alias("Length"), F.col("title").alias("Title")), path)
    return read_content_map_parquet(spark, path)


def parquet_sink(spark, sf):
    path = scratch_path(spark, "usage")
    write_parquet(usage_counts(spark, sf), path, partition_by=("bucket",))
    return spark.read.parquet(path).select("device_id", "bucket", "count")


def single_parquet_sink(spark, sf):
    path = scratch_path(spark, "active-segments")
    active = users_by_segment(spark, sf).where(F.col("activity_type") == "active")
    write_single_parquet(active.select("gender", "age", "bucket", "count"), path)
    return spark.read.parquet(path)


def csv_sink(spark, sf):
    path = scratch_path(spark, "segments-csv")
    write_csv(users_by_segment(spark, sf), path)
    return spark.read.csv(path, header=True)


def usage_input_load(spark, sf):
    b = cohort.bucketed(_log(spark, sf), COHORT)
    rows = b.select(F.monotonically_increasing_id().alias("index"),
                    F.col("device_id").try_cast("int").alias("Device ID"),
                    F.substring("item_name", 5, 10).try_cast("int").alias("Content ID"),
                    F.col("bucket").cast("string").alias("Time Period"))
    path = scratch_path(spark, "usage-input-csv")
    write_csv(rows, path)
    return read_usage_input(spark, path)


def event_filter(spark, sf):
    return events(_log(spark, sf), ITEM_PLAY_STARTED, ITEM_PLAY_FINISHED)


def mixed_schema_log(spark, sf):
    """The log in one folder with the device as text or number and the time as text or timestamp."""
    path = scratch_path(spark, "mixed-log")
    log, third = _log(spark, sf), F.pmod(F.hash("device_id", "time"), F.lit(3))
    number, stamp = F.col("device_id").try_cast("bigint"), F.col("time").try_cast("timestamp")
    known = number.isNotNull() & stamp.isNotNull()
    write_parquet(log.where(F.coalesce(~known, F.lit(True)) | (third == 0)), path, partition_by=("event",))
    for part, cols in ((1, {"device_id": number}), (2, {"device_id": number, "time": stamp})):
        write_parquet(log.where(known & (third == part)).withColumns(cols), path, mode="append", partition_by=("event",))
    return events(read_mixed_device_log(spark, path), ITEM_PLAY_STARTED, ITEM_PLAY_FINISHED)


def resumed_usage(spark, sf):
    """Usage from sessions that a second run takes over from the files of a first one."""
    out, content = scratch_path(spark, "resumed"), adapter.content_map(spark, sf)
    inputs = {t: f"{sf}/{t}.parquet" for t in ("lineitem", "orders", "part")}
    made_from = {"inputs": tuple(inputs), "settings": asdict(COHORT)}
    Stages(spark, out, inputs).run("sessions", lambda: cohort.raw_sessions(_log(spark, sf), COHORT), **made_from)
    again = Stages(spark, out, inputs)
    sessions = again.run("sessions", lambda: cohort.raw_sessions(_log(spark, sf), COHORT), **made_from)
    if again.history != {"sessions": "taken over"}:
        raise AssertionError(again.history)
    return again.run("usage", lambda: cohort.usage_of(sessions, content, COHORT), **made_from, after="sessions")


def incremental_usage(spark, sf):
    """Usage of the cohort kept up to date span by span; plays and windows cross the spans' borders."""
    log, content = _log(spark, sf), adapter.content_map(spark, sf)
    state = UsageState(spark, scratch_path(spark, "usage-state"), COHORT)
    for start, stop in zip(SPANS, SPANS[1:]):
        state.take_in(log, content, start, stop)
    return state.usage()


def first_time_users_q(spark, sf):
    return first_time_users(_log(spark, sf), COHORT)


def shifted_log(spark, sf):
    return cohort.shifted(_log(spark, sf), COHORT)


def parse_payload(spark, sf):
    return (events(_log(spark, sf), ITEM_PLAY_STARTED, ITEM_PLAY_FINISHED)
            .select("device_id", "event", "time", item_name("payload").alias("item_name"),
                    end_of_stream("payload").alias("reach_end_of_stream")))


def parse_payload_tolerant(spark, sf):
    """Payloads as other writers leave them: single quotes, a missing brace, no quotes at all."""
    log, kind = events(_log(spark, sf), ITEM_PLAY_STARTED, ITEM_PLAY_FINISHED), F.pmod(F.xxhash64("device_id", "time"), F.lit(4))
    p = F.col("payload")
    loose = (F.when(kind == 1, F.replace(p, F.lit('"'), F.lit("'"))).when(kind == 2, F.regexp_replace(p, '"?}$', ""))
             .when(kind == 3, F.replace(F.replace(p, F.lit('"'), F.lit("")), F.lit(":"), F.lit(" = "))).otherwise(p))
    fields = F.inline(F.array(tolerant_fields(loose)))
    return log.select("device_id", "event", "time", fields).select(
        "device_id", "event", "time", strip_extension("item_name").alias("item_name"),
        reached_end("did_reach_end_of_stream").alias("reach_end_of_stream"))


def split_item_names(spark, sf):
    """The text-splitting form of the item's name, with its extension."""
    log = events(_log(spark, sf), ITEM_PLAY_STARTED, ITEM_PLAY_FINISHED)
    finished = F.col("event") == ITEM_PLAY_FINISHED
    name = F.when(finished, split_item_name("payload", finished=True)).otherwise(split_item_name("payload"))
    return log.where(F.col("payload").contains("category")).select("device_id", "event", "time", name.alias("item_name"))


def pair_plays_strict(spark, sf):
    return cohort.sessions(_log(spark, sf), COHORT)


def pair_plays_by_flag(spark, sf):
    return subscription.sessions(_log(spark, sf))


def day_bucket(spark, sf):
    return cohort.bucketed(_log(spark, sf), COHORT)


def priced_sessions(spark, sf):
    return cohort.priced(_log(spark, sf), adapter.content_map(spark, sf), COHORT)


def usage_counts(spark, sf):
    return cohort.usage(_log(spark, sf), adapter.content_map(spark, sf), COHORT)


def play_counts(spark, sf):
    return count_plays(cohort.bucketed(_log(spark, sf), COHORT), "device_id", "bucket")


def activity_types(spark, sf):
    return cohort_activity_types(usage_counts(spark, sf), COHORT)


def activity_types_absolute(spark, sf):
    return absolute_activity_types(play_counts(spark, sf))


def users_by_segment(spark, sf):
    return cohort.segment_counts(_log(spark, sf), adapter.content_map(spark, sf),
                                 adapter.profile(spark, sf), COHORT)


def monthly_sessions(spark, sf):
    return monthly.sessions(_log(spark, sf), MONTHLY)


def monthly_actives_q(spark, sf):
    u = monthly.usage(_log(spark, sf), adapter.content_map(spark, sf), MONTHLY)
    return monthly_actives(u, MONTHLY.active_threshold, with_share=True)


def scored_plays(spark, sf):
    return subscription.scored(_log(spark, sf), adapter.content_map(spark, sf), POPULARITY)


def scored_plays_full_weight(spark, sf):
    # the sessions are read twice (plays, titles played), so they are written once, as the jobs do
    path, sessions = scratch_path(spark, "sessions"), subscription.sessions(_log(spark, sf))
    write_parquet(sessions, path)
    return subscription.scored_of(spark.read.schema(sessions.schema).parquet(path), adapter.content_map(spark, sf),
                                  POPULARITY, out_of_range="full")


def content_popularity(spark, sf):
    return subscription.popularity(_log(spark, sf), adapter.content_map(spark, sf),
                                   adapter.profile(spark, sf), POPULARITY)


def _dash(spark, sf):
    return to_dashboard(users_by_segment(spark, sf))


def rollup_gender(spark, sf):
    dashboard_views(spark, _dash(spark, sf))
    return spark.table("gender")


def rollup_age(spark, sf):
    dashboard_views(spark, _dash(spark, sf))
    return spark.table("age")


def select_age(spark, sf):
    dashboard_functions(spark, _dash(spark, sf))
    return select_function(spark, "age", age=FILTER_AGE)


def select_gender(spark, sf):
    dashboard_functions(spark, _dash(spark, sf))
    return select_function(spark, "gender", gender=FILTER_GENDER)


def segmentations_q(spark, sf):
    return segmentations(_dash(spark, sf))


def segment_filter(spark, sf):
    dashboard_functions(spark, _dash(spark, sf))
    return select_function(spark, "full", age=FILTER_AGE, gender=FILTER_GENDER)


def activity_chart_q(spark, sf):
    return activity_chart(_dash(spark, sf), (*COHORT_LABELS, "null"))


def rejects_q(spark, sf):
    return rejects(_log(spark, sf), adapter.content_map(spark, sf))


def unreadable_lines(spark, sf):
    """Lines of the three CSV inputs that cannot be read: too few or too many fields, text for a number."""
    customer, part = adapter.table(spark, sf, "customer"), adapter.table(spark, sf, "part")

    def every(key: str, n: int):
        return F.pmod(F.col(key), F.lit(n)) == 0

    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    lines = {
        "profile": ("gender,device_id,age", customer.select(
            F.when(every("c_custkey", 11), F.concat_ws(",", F.lit("F"), key)).when(
                every("c_custkey", 13), F.concat_ws(",", F.lit("M"), key, nation, F.lit("more"))).otherwise(
                F.concat_ws(",", F.lit("F"), key, nation)).alias("value"))),
        "content": ("Title,Length", part.select(
            F.when(every("p_partkey", 17), F.concat(F.lit("item"), F.col("p_partkey").cast("string"))).otherwise(
                F.concat_ws(",", F.concat(F.lit("item"), F.col("p_partkey").cast("string")),
                            F.concat(F.col("p_size").cast("string"), F.lit(":00")))).alias("value"))),
        "usage": (",device,content,period", customer.select(F.concat_ws(
            ",", key, F.when(every("c_custkey", 7), F.concat(F.lit("d"), key)).otherwise(key),
            F.when(every("c_custkey", 19), F.lit("1.5")).otherwise(nation), F.lit("1")).alias("value"))),
    }
    out = []
    for source, (header, body) in lines.items():
        path = scratch_path(spark, f"{source}-lines")
        # written as one file so that its first line is the header (a small reference table)
        body.select("value", F.lit(1).alias("o")).union(spark.createDataFrame([(header, 0)], "value STRING, o INT")).orderBy(
            "o").coalesce(1).select("value").write.text(path)
        checked = read_checked_csv(spark, path, source)
        out.append(rejected_lines(checked, source).select(
            "source", "line", F.col("file").contains(path.rsplit("/", 1)[-1]).alias("file_known")))
    return out[0].union(out[1]).union(out[2])


QUERIES: dict[str, Query] = {
    "read_clean_log": read_clean_log,
    "content_map_load": content_map_load,
    "profile_load": profile_load,
    "usage_input_load": usage_input_load,
    "event_filter": event_filter,
    "mixed_schema_log": mixed_schema_log,
    "resumed_usage": resumed_usage,
    "incremental_usage": incremental_usage,
    "first_time_users": first_time_users_q,
    "shifted_log": shifted_log,
    "parse_payload": parse_payload,
    "parse_payload_tolerant": parse_payload_tolerant,
    "split_item_names": split_item_names,
    "pair_plays_strict": pair_plays_strict,
    "pair_plays_by_flag": pair_plays_by_flag,
    "day_bucket": day_bucket,
    "priced_sessions": priced_sessions,
    "usage_counts": usage_counts,
    "play_counts": play_counts,
    "activity_types": activity_types,
    "activity_types_absolute": activity_types_absolute,
    "users_by_segment": users_by_segment,
    "monthly_sessions": monthly_sessions,
    "monthly_actives": monthly_actives_q,
    "scored_plays": scored_plays,
    "scored_plays_full_weight": scored_plays_full_weight,
    "content_popularity": content_popularity,
    "rollup_gender": rollup_gender,
    "rollup_age": rollup_age,
    "segmentations": segmentations_q,
    "segment_filter": segment_filter,
    "select_age": select_age,
    "select_gender": select_gender,
    "content_map_parquet": content_map_parquet,
    "parquet_sink": parquet_sink,
    "single_parquet_sink": single_parquet_sink,
    "csv_sink": csv_sink,
    "activity_chart": activity_chart_q,
    "rejects": rejects_q,
    "unreadable_lines": unreadable_lines,
}
