"""Batch jobs for ``spark-submit``: one lazy plan per pipeline.

    spark-submit --py-files playlens.zip playlens/plans/jobs.py cap --log DIR \\
        --content MAP.csv --profile PROFILE.csv --out DIR [--config config.json] [--stages]
    ... scp --log DIR --content MAP.csv --profile PROFILE.csv --out DIR [--config weights.json]
    ... dlt --log DIR --content MAP.csv --out DIR [--config config.json]

(locally: ``python -m playlens.plans.jobs cap ...``)

Inputs: the device log as Parquet (any directory layout Spark reads; ``--mixed-types`` where files
store its columns in different types), the content and profile maps as CSV with a header.

The sessions of each pipeline (the costly pairing) are always written as Parquet
under ``<out>/sessions`` and read back, so a lost executor does not send later steps
back to the log scan; ``--stages`` also writes each further stage's result under ``<out>/<stage>``.
A stage that an earlier run with the same inputs and settings has finished is taken over
(see ``stages``); rows that joins leave out are counted under ``<out>/_dropped/<stage>``; ``--fresh`` runs all of them again, ``--until STAGE`` stops after one. The plans are
those of the query catalogue.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession

from playlens.config import CohortConfig, MonthlyConfig, PopularityConfig
from playlens.operators.accounting import DropCounts
from playlens.operators.popularity import content_popularity
from playlens.operators.segments import monthly_actives, users_by_segment
from playlens.plans import cohort, monthly, subscription
from playlens.plans.stages import Stages
from playlens.session import build_session
from playlens.sources import read_content_map, read_device_log, read_mixed_device_log, read_profile

#: Settings each pipeline's sessions and usage counts depend on.
WINDOW = ("cutoff_date", "reference_date", "analysis_duration")
USAGE = ("bin_duration", "long_item_duration_threshold", "long_item_active_percentage")
CLASSES = ("active", "semi_active", "rare", "inactive")
#: Names of the stages, in order (those in brackets only with ``--stages``).
STAGES = {"cap": ("sessions", "[shifted_log]", "[usage]", "segments"), "scp": ("sessions", "[scored]", "popularity"),
          "dlt": ("sessions", "[shift_table]", "users_by_month")}


def _load_json(path: str | None) -> dict:
    if not path:
        return {}
    with open(path) as f:
        return json.load(f)


def _some(cfg, names: tuple[str, ...]) -> dict:
    return {k: v for k, v in asdict(cfg).items() if k in names}


def run_cohort(spark: SparkSession, log: DataFrame, content: DataFrame, profile: DataFrame, cfg: CohortConfig,
               out: str, stages: bool = False, store: Stages | None = None, until: str | None = None) -> None:
    store, drops = store or Stages(spark, out), DropCounts()
    sessions = store.run("sessions", lambda: cohort.raw_sessions(log, cfg, drops), _some(cfg, WINDOW), ("log",), drops=drops)
    if until == "sessions":
        return
    drops, last = DropCounts(), "sessions"
    usage = cohort.usage_of(sessions, content, cfg, drops)
    if stages:
        store.run("shifted_log", lambda: cohort.shifted(log, cfg), _some(cfg, WINDOW), ("log",))
        if until == "shifted_log":
            return
        usage = store.run("usage", lambda: usage, _some(cfg, USAGE), ("content",), after="sessions", drops=drops)
        drops, last = DropCounts(), "usage"
        if until == "usage":
            return
    counted = usage
    store.run("segments", lambda: users_by_segment(counted, profile, cfg, drops=drops), _some(cfg, USAGE + CLASSES),
              ("content", "profile"), after=last, drops=drops)


def run_popularity(spark: SparkSession, log: DataFrame, content: DataFrame, profile: DataFrame, cfg: PopularityConfig,
                   out: str, stages: bool = False, store: Stages | None = None, until: str | None = None) -> None:
    store, drops = store or Stages(spark, out), DropCounts()
    sessions = store.run("sessions", lambda: subscription.sessions(log, drops), {}, ("log",), drops=drops)
    if until == "sessions":
        return
    drops, last = DropCounts(), "sessions"
    scored = subscription.scored_of(sessions, content, cfg, drops=drops)
    if stages:
        scored = store.run("scored", lambda: scored, asdict(cfg), ("content",), after="sessions", drops=drops)
        drops, last = DropCounts(), "scored"
        if until == "scored":
            return
    plays = scored
    store.run("popularity", lambda: content_popularity(plays, profile, drops), asdict(cfg), ("content", "profile"),
              after=last, drops=drops)


def run_monthly(spark: SparkSession, log: DataFrame, content: DataFrame, cfg: MonthlyConfig, out: str,
                stages: bool = False, store: Stages | None = None, until: str | None = None) -> None:
    store, drops = store or Stages(spark, out), DropCounts()
    sessions = store.run("sessions", lambda: monthly.sessions(log, cfg, drops), _some(cfg, WINDOW), ("log",), drops=drops)
    if until == "sessions":
        return
    if stages:
        store.run("shift_table", lambda: monthly.shift_table(log, cfg), _some(cfg, WINDOW), ("log",))
        if until == "shift_table":
            return
    # at most one row per month: a single output file is cheap
    priced = DropCounts()
    store.run("users_by_month", lambda: monthly_actives(monthly.usage_of(sessions, content, cfg, priced), cfg.active_threshold),
              asdict(cfg), ("content",), after="sessions", single=True, drops=priced)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="playlens")
    p.add_argument("pipeline", choices=["cap", "scp", "dlt"])
    p.add_argument("--log", required=True)
    p.add_argument("--content", required=True)
    p.add_argument("--profile")
    p.add_argument("--out", required=True)
    p.add_argument("--config")
    p.add_argument("--stages", action="store_true")
    p.add_argument("--until", metavar="STAGE", help="stop after this stage")
    p.add_argument("--fresh", action="store_true", help="take over no stage of an earlier run")
    p.add_argument("--mixed-types", action="store_true", help="log files store columns in different types")
    a = p.parse_args(argv)
    if a.pipeline in ("cap", "scp") and not a.profile:
        p.error(f"{a.pipeline} needs --profile")
    names = [x.strip("[]") for x in STAGES[a.pipeline] if a.stages or not x.startswith("[")]
    if a.until and a.until not in names:
        p.error(f"--until must be one of {names} here")
    spark = build_session(app=f"playlens-{a.pipeline}")
    paths = {k: v for k, v in (("log", a.log), ("content", a.content), ("profile", a.profile)) if v}
    store = Stages(spark, a.out, paths, a.fresh, kind=a.pipeline)
    log = (read_mixed_device_log if a.mixed_types else read_device_log)(spark, a.log)
    content = read_content_map(spark, a.content)
    doc = _load_json(a.config)
    if a.pipeline == "cap":
        run_cohort(spark, log, content, read_profile(spark, a.profile), CohortConfig.from_json(doc), a.out,
                   a.stages, store, a.until)
    elif a.pipeline == "scp":
        run_popularity(spark, log, content, read_profile(spark, a.profile), PopularityConfig.from_json(doc),
                       a.out, a.stages, store, a.until)
    else:
        run_monthly(spark, log, content, MonthlyConfig.from_json(doc), a.out, a.stages, store, a.until)
    spark.stop()


if __name__ == "__main__":
    main()
