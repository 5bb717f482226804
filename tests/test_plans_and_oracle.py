"""Plan shape of every registered query, and each query against its DuckDB oracle."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_mod
from playlens.plans import adapter, catalog

SF = os.environ.get("PLAYLENS_TEST_SF", "/root/testdata/sf0.001")
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")
KEYS = sorted(catalog.QUERIES)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["age", "gender", "activity_type", "bucket", "count"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", KEYS)
def test_plan_is_native(spark, name):
    df = entry_mod.queries()[name](spark, SF)
    text = plan_text(df)
    for node in FORBIDDEN:
        assert node not in text, f"{name}: {node} in plan"


def test_event_filter_reaches_the_scan(spark):
    df = entry_mod.queries()["pair_plays_by_flag"](spark, SF)
    scans = [line for line in plan_text(df).splitlines() if "FileScan parquet" in line]
    assert scans
    for line in scans:
        assert "PartitionFilters: [event" in line and "ITEM_PLAY_STARTED" in line
        assert "ReadSchema: struct<device_id:string,payload:string,time:string>" in line


def executed(df) -> str:
    """Final adaptive plan after running the query."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    text = plan_text(df)
    return text.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name, reads", [("pair_plays_by_flag", 1), ("scored_plays", 1), ("content_popularity", 1),
                                         ("scored_plays_full_weight", 0)])  # full: from the sessions written
def test_the_log_is_read_and_parsed_once(spark, name, reads):
    text = executed(entry_mod.queries()[name](spark, SF))
    assert sum("FileScan parquet" in x and "payload" in x for x in text.splitlines()) == reads
    assert sum("Generate inline" in x and "_bad" in x for x in text.splitlines()) == reads


def test_building_a_query_runs_no_job(spark):
    adapter.stored_log(spark, SF)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    log, content = adapter.stored_log(spark, SF), adapter.content_map(spark, SF)
    spark.sparkContext.setJobGroup("plans", "plans")
    from playlens.plans import cohort, monthly, subscription
    cohort.usage(log, content, catalog.COHORT)
    monthly.usage(log, content, catalog.MONTHLY)
    subscription.scored(log, content, out_of_range="full")
    assert not tracker.getJobIdsForGroup("plans")
    spark.sparkContext.setJobGroup("", "")


def test_derived_log_joins_the_tables_once(spark):
    text = plan_text(adapter.play_log(spark, SF)).split("== Initial Plan ==")[0]
    assert text.count("SortMergeJoin") == 1 and text.count("FileScan parquet") == 2


def test_check_data_exercises_the_rules(spark):
    q = entry_mod.queries()
    log = adapter.stored_log(spark, SF)
    assert q["read_clean_log"](spark, SF).count() < log.na.drop().count() < log.count()
    reasons = {r["reason"] for r in q["rejects"](spark, SF).collect()}
    assert reasons == {"payload is not JSON", "no item_name", "time is not readable", "no device_id", "length is not M:SS"}
    full = q["scored_plays_full_weight"](spark, SF)
    assert full.where("device_id IS NULL").count() > 0 and full.where("PercentPlayed IS NULL AND device_id IS NOT NULL").count() > 0
    assert q["priced_sessions"](spark, SF).count() < 0.9 * q["day_bucket"](spark, SF).count()


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, repr(round(v, 9)))
    if hasattr(v, "isoformat"):
        return (1, v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat())
    return (1, str(v))


def _sorted(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in recs)


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in ("lineitem", "orders", "part", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF)
    s_cols, s_rows = _sorted(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(entry_mod.oracle_sql()[name])
    d_cols, d_rows = _sorted([c[0] for c in res.description], res.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_pairing_plan_is_skew_safe(spark):
    """Copies collapse before the first shuffle (an aggregate without functions stands
    below each exchange of the events), and the window over events partitions by time
    chunk, so one hot key is spread over many tasks."""
    import re
    from conftest import log_frame
    from playlens.operators import pair_plays
    log = log_frame(spark, [("d", "ITEM_PLAY_STARTED", '{"item_name":"A"}', "2019-01-01T00:00:00")])
    plan = pair_plays(log)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    first = max(i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x)
    assert re.search(r"HashAggregate\(keys=.*functions=\[\]", lines[first + 1]), lines[first + 1]
    win = [x for x in lines if re.search(r"Window \[", x) and "_in0" in x]
    assert len(win) == 1
    partition = re.search(r"\], \[([^\]]*)\], \[([^\]]*)\]\s*$", win[0])
    assert "_chunk" in partition[1], win[0]
