"""The spark-submit jobs write the same results as the catalogue queries."""

from __future__ import annotations

import os

from conftest import rows
from playlens.plans import adapter, catalog
from playlens.plans.jobs import run_cohort, run_monthly, run_popularity
from playlens.session import scratch_path
from playlens.sources import read_content_map, read_profile, write_csv

SF = "/root/testdata/sf0.001"


def test_jobs_end_to_end(spark):
    log = adapter.stored_log(spark, SF)
    cm_path, prof_path = scratch_path(spark, "job-content"), scratch_path(spark, "job-profile")
    write_csv(adapter.content_map(spark, SF), cm_path)
    write_csv(adapter.profile(spark, SF), prof_path)
    content, profile = read_content_map(spark, cm_path), read_profile(spark, prof_path)
    out = scratch_path(spark, "job-out")

    run_cohort(spark, log, content, profile, catalog.COHORT, out, stages=True)
    got = spark.read.parquet(os.path.join(out, "segments"))
    assert rows(got) == rows(catalog.users_by_segment(spark, SF).select(*got.columns))
    assert spark.read.parquet(os.path.join(out, "sessions")).count() == \
        catalog.pair_plays_strict(spark, SF).count()

    run_popularity(spark, log, content, profile, catalog.POPULARITY, out)
    got = spark.read.parquet(os.path.join(out, "popularity"))
    want = catalog.content_popularity(spark, SF)
    assert rows(got.select(*want.columns)) == rows(want)

    run_monthly(spark, log, content, catalog.MONTHLY, out)
    got = spark.read.parquet(os.path.join(out, "users_by_month"))
    want = catalog.monthly_actives_q(spark, SF).drop("active_share")
    assert rows(got) == rows(want)
