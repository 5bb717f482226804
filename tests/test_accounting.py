"""Counts of dropped rows equal those of anti-joins over the same rows."""

from __future__ import annotations

import os

import pytest
from conftest import rows

from playlens.functions.payload import ITEM_PLAY_FINISHED, ITEM_PLAY_STARTED, payload_fields
from playlens.operators import pair_plays, score_plays
from playlens.operators.accounting import DropCounts
from playlens.operators.popularity import content_popularity
from playlens.plans import adapter, catalog, cohort, jobs, subscription
from playlens.session import scratch_path
from playlens.sources import events

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return adapter.stored_log(spark, SF), adapter.content_map(spark, SF).cache(), adapter.profile(spark, SF).cache()


def test_jobs_write_counts_that_equal_anti_joins(spark, tables):
    log, content, profile = tables
    out = scratch_path(spark, "counted")
    jobs.run_cohort(spark, log, content, profile, catalog.COHORT, out, stages=True)
    sessions = spark.read.parquet(os.path.join(out, "sessions"))
    dropped = {(s, r["step"], r["reason"]): r["n"] for s in ("sessions", "usage", "segments")
               for r in spark.read.parquet(os.path.join(out, "_dropped", s)).collect()}
    titles = content.select(content["title"].alias("item_name"))
    assert dropped["usage", "priced", "unknown item"] == sessions.join(titles, "item_name", "left_anti").count() > 0
    assert dropped["usage", "priced", "unreadable length"] == sessions.join(
        content.where("try_to_number(split_part(length, ':', 1), '999') IS NULL").select(content["title"].alias("item_name")),
        "item_name").count() > 0
    usage = spark.read.parquet(os.path.join(out, "usage"))
    assert dropped["segments", "profiled", "no profile"] == usage.join(profile, "device_id", "left_anti").count() > 0
    assert dropped["segments", "profiled", "rows"] == usage.count()
    priced = cohort.priced(log, content, catalog.COHORT).count()
    assert dropped["usage", "priced", "rows"] - priced == sum(
        n for (s, step, reason), n in dropped.items() if step == "priced" and reason != "rows")
    # counting changes no row
    assert rows(spark.read.parquet(os.path.join(out, "segments")), "age", "gender", "activity_type", "bucket", "count") == rows(
        catalog.users_by_segment(spark, SF), "age", "gender", "activity_type", "bucket", "count")


def test_unreadable_events_are_counted_once(spark, tables):
    log = tables[0]
    drops = DropCounts()
    paired = pair_plays(log, strict=True, drops=drops).collect()
    plays = events(log, ITEM_PLAY_STARTED, ITEM_PLAY_FINISHED).select(
        "device_id", "time", payload_fields("payload").alias("p")).select("device_id", "time", "p.item_name")
    got = drops.counts()["events"]
    assert got["rows"] == plays.count()
    assert got["no device"] == plays.where("device_id IS NULL").count() > 0
    assert got["no item"] == plays.where("device_id IS NOT NULL AND item_name IS NULL").count() > 0
    assert got["no time"] == plays.where("device_id IS NOT NULL AND item_name IS NOT NULL AND time IS NULL").count() > 0
    assert sorted(map(tuple, paired)) == sorted(map(tuple, pair_plays(log, strict=True).collect()))


def test_popularity_counts_plays(spark, tables):
    log, content, profile = tables
    sessions = subscription.sessions(log).cache()
    drops = DropCounts()
    got = content_popularity(subscription.scored_of(sessions, content, drops=drops), profile, drops)
    assert rows(got) == rows(content_popularity(subscription.scored_of(sessions, content), profile))
    scored, profiled = drops.counts()["scored"], drops.counts()["profiled"]
    assert scored["unknown item"] == sessions.join(content, sessions["item_name"] == content["title"], "left_anti").count() > 0
    kept = score_plays(sessions.na.drop(), content, bare_names=True)
    assert scored["rows"] - sum(n for k, n in scored.items() if k != "rows") == kept.count() == profiled["rows"]
    assert profiled["no profile"] == kept.join(profile, "device_id", "left_anti").count() > 0


def test_first_reason_counts_and_no_rows(spark):
    df = spark.createDataFrame([(1, None), (None, None), (2, 3)], "a INT, b INT")
    drops = DropCounts()
    kept = drops.keep(df, "x", {"no a": df["a"].isNull(), "no b": df["b"].isNull()})
    assert rows(kept) == [(2, 3)] and drops.counts() == {"x": {"rows": 3, "no a": 1, "no b": 1}}
    with pytest.raises(ValueError):
        drops.keep(df, "x", {})
    none = DropCounts()
    none.keep(df.limit(0), "x", {"no a": df["a"].isNull()}).collect()
    assert none.counts() == {"x": {"rows": 0, "no a": 0}}
