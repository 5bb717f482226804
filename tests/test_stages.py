"""Stages that a second run takes over, and what makes them run again."""

from __future__ import annotations

import json
import os

import pytest
from conftest import local_path, rows

from playlens.config import CohortConfig
from playlens.plans import cohort, jobs
from playlens.plans.stages import Stages, files_fingerprint
from test_device_filter import busy_log


@pytest.fixture
def files(spark, tmp_path):
    busy_log(spark, devices=60, new=20).write.partitionBy("event").parquet(str(tmp_path / "log"))
    (tmp_path / "content.csv").write_text("title,length\nA,3:00\n")
    (tmp_path / "profile.csv").write_text("device_id,age,gender\n" + "".join(f"d{i},{i % 4},F\n" for i in range(60)))
    return {"log": str(tmp_path / "log"), "content": str(tmp_path / "content.csv"), "profile": str(tmp_path / "profile.csv")}


CFG = CohortConfig(cutoff_date="2019-06-01T00:00:00", reference_date="2019-01-01T00:00:00", analysis_duration=90)


def run(spark, files, out, cfg=CFG, until=None, log=None, fresh=False):
    from playlens.sources import read_content_map, read_device_log, read_profile
    store = Stages(spark, out, files, fresh, kind="cap")
    jobs.run_cohort(spark, log if log is not None else read_device_log(spark, files["log"]), read_content_map(spark, files["content"]),
                    read_profile(spark, files["profile"]), cfg, out, stages=True, store=store, until=until)
    return store.history


def test_a_stopped_run_goes_on_without_the_log(spark, files, tmp_path):
    out = str(tmp_path / "out")
    assert run(spark, files, out, until="shifted_log") == {"sessions": "computed", "shifted_log": "computed"}
    # the second run is given a log that cannot be read: it must not be looked at
    broken = spark.range(1).selectExpr("CAST(raise_error('the log was scanned') AS STRING) AS device_id", "'x' AS event",
                                       "'x' AS payload", "'x' AS time")
    done = run(spark, files, out, log=broken)
    assert done == {"sessions": "taken over", "shifted_log": "taken over", "usage": "computed", "segments": "computed"}
    first = rows(spark.read.parquet(os.path.join(out, "segments")))
    assert first and set(run(spark, files, out, log=broken).values()) == {"taken over"}
    assert rows(spark.read.parquet(os.path.join(out, "segments"))) == first


def test_settings_invalidate_the_stages_that_use_them(spark, files, tmp_path):
    out = str(tmp_path / "out")
    run(spark, files, out)
    assert run(spark, files, out, CFG.with_(active=0.2)) == {
        "sessions": "taken over", "shifted_log": "taken over", "usage": "taken over", "segments": "computed"}
    assert run(spark, files, out, CFG.with_(active=0.2, bin_duration=15)) == {
        "sessions": "taken over", "shifted_log": "taken over", "usage": "computed", "segments": "computed"}
    assert set(run(spark, files, out, CFG.with_(analysis_duration=60)).values()) == {"computed"}
    assert set(run(spark, files, out, CFG.with_(analysis_duration=60), fresh=True).values()) == {"computed"}


def test_inputs_invalidate_the_stages_that_read_them(spark, files, tmp_path):
    out = str(tmp_path / "out")
    run(spark, files, out)
    with open(files["profile"], "a") as f:
        f.write("d99,1,M\n")
    assert run(spark, files, out)["usage"] == "taken over"
    with open(files["content"], "a") as f:
        f.write("B,2:00\n")
    assert run(spark, files, out) == {"sessions": "taken over", "shifted_log": "taken over", "usage": "computed", "segments": "computed"}
    busy_log(spark, devices=3, new=3).write.mode("append").partitionBy("event").parquet(files["log"])
    assert set(run(spark, files, out).values()) == {"computed"}


def test_unfinished_and_changed_stages_run_again(spark, files, tmp_path):
    out = str(tmp_path / "out")
    store = Stages(spark, out, files)

    def fails():
        raise RuntimeError("stopped")
    store.run("sessions", lambda: spark.range(3).toDF("v"), {}, ("log",))
    again = Stages(spark, out, files)
    with pytest.raises(RuntimeError):  # other settings: the old rows are no longer marked once this one begins
        again.run("sessions", fails, {"x": 1}, ("log",))
    third = Stages(spark, out, files)
    assert third.run("sessions", lambda: spark.range(5).toDF("v"), {}, ("log",)).count() == 5
    part = next(f for f in os.listdir(os.path.join(out, "sessions")) if f.startswith("part-"))
    os.remove(os.path.join(out, "sessions", part))
    last = Stages(spark, out, files)
    assert last.run("sessions", lambda: spark.range(4).toDF("v"), {}, ("log",)).count() == 4
    assert last.history == {"sessions": "computed"}
    # rows of unknown origin are never taken over
    free = Stages(spark, out)
    assert free.run("sessions", lambda: spark.range(2).toDF("v")).count() == 2 and free.history == {"sessions": "computed"}


def test_empty_stage_keeps_its_schema(spark, files, tmp_path):
    for _ in range(2):
        store = Stages(spark, str(tmp_path / "out"), files)
        df = store.run("none", lambda: spark.range(0).selectExpr("id", "'a' AS b"), {}, ("log",))
        assert df.columns == ["id", "b"] and df.count() == 0
    assert store.history == {"none": "taken over"}


def test_command_line_resumes(spark, files, tmp_path, monkeypatch):
    cfg = tmp_path / "config.json"
    cfg.write_text(json.dumps({"main": {"CUTOFF_DATE": "2019-06-01T00:00:00", "REFERENCE_DATE": "2019-01-01T00:00:00"}}))
    monkeypatch.setattr(jobs, "build_session", lambda **k: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    stores = []
    monkeypatch.setattr(jobs, "Stages", lambda *a, **k: stores.append(Stages(*a, **k)) or stores[-1])
    args = ["cap", "--log", files["log"], "--content", files["content"], "--profile", files["profile"], "--config", str(cfg)]
    out = str(tmp_path / "cap")
    jobs.main([*args, "--out", out, "--until", "sessions"])
    jobs.main([*args, "--out", out, "--mixed-types"])
    assert [s.history for s in stores] == [{"sessions": "computed"}, {"sessions": "taken over", "segments": "computed"}]
    with pytest.raises(SystemExit):
        jobs.main([*args, "--out", out, "--until", "usage"])  # only written with --stages
    for kind in ("dlt", "scp"):  # another job in the same folder takes over nothing of this one
        jobs.main([kind, *args[1:], "--out", out])
        assert "taken over" not in stores[-1].history.values()
    from playlens.sources import read_content_map, read_device_log, read_profile
    log = read_device_log(spark, files["log"])
    jobs.main([*args, "--out", str(tmp_path / "cap2")])
    want = cohort.segment_counts(log, read_content_map(spark, files["content"]), read_profile(spark, files["profile"]), CFG)
    assert rows(spark.read.parquet(local_path(str(tmp_path / "cap2" / "segments"))).select(*want.columns)) == rows(want)
    assert files_fingerprint(spark, files["log"]) == files_fingerprint(spark, files["log"])
