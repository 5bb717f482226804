"""Dashboard roll-ups against the stored note results; sinks by round trip."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import AnalysisException

from conftest import local_path, rows
from playlens.operators import (
    activity_chart, dashboard_views, segment_filter, segment_rollup, segmentations, select_view,
)
from playlens.session import scratch_path
from playlens.sources import (
    read_content_map, read_profile, read_usage_input, rows_to_frame, write_csv, write_parquet,
    write_single_parquet,
)

# fixed values: the dashboard sample data, per (age, gender) and period 1..5 the
# counts of superactive, frequent, dormant, non-active; type "all" is 1000 each.
SAMPLE = {
    (1, "M"): [(300, 200, 100, 400), (200, 300, 200, 300), (150, 250, 100, 500), (100, 200, 50, 650), (50, 150, 10, 790)],
    (1, "F"): [(300, 200, 100, 400), (200, 300, 200, 300), (150, 250, 100, 500), (100, 200, 50, 650), (50, 150, 10, 790)],
    (2, "M"): [(600, 300, 100, 0), (300, 500, 50, 150), (550, 250, 100, 100), (400, 200, 150, 250), (200, 300, 200, 300)],
    (2, "F"): [(800, 100, 50, 50), (700, 200, 50, 50), (600, 250, 70, 80), (500, 250, 100, 150), (400, 100, 300, 200)],
    (3, "M"): [(200, 300, 200, 300), (200, 300, 200, 300), (150, 250, 100, 500), (100, 200, 50, 650), (50, 150, 10, 790)],
    (3, "F"): [(300, 200, 100, 400), (200, 300, 200, 300), (150, 250, 100, 500), (100, 200, 50, 650), (50, 150, 10, 790)],
}
TYPES = ("superactive", "frequent", "dormant", "non-active")


@pytest.fixture(scope="module")
def dash(spark):
    data = []
    for (age, gender), periods in SAMPLE.items():
        for p, counts in enumerate(periods, start=1):
            data.append((p, age, gender, "all", 1000))
            data.extend((p, age, gender, t, c) for t, c in zip(TYPES, counts))
    return rows_to_frame(spark, data, "time_period INT, age INT, gender STRING, type STRING, count BIGINT")


def test_sample_size(dash):
    assert dash.count() == 150


def test_age_view_matches_note(spark, dash):
    dashboard_views(spark, dash)
    got = {(r.time_period, r.type): r["count"] for r in select_view(spark, "age", age=1).collect()}
    assert len(got) == 25
    # stored values of the note for age 1
    assert got[(1, "all")] == 2000 and got[(1, "frequent")] == 400 and got[(5, "frequent")] == 300
    assert got[(4, "non-active")] == 1300 and got[(5, "non-active")] == 1580 and got[(5, "dormant")] == 20


def test_gender_view_matches_note(spark, dash):
    dashboard_views(spark, dash)
    got = {(r.time_period, r.type): r["count"] for r in select_view(spark, "gender", gender="F").collect()}
    assert len(got) == 25
    assert got[(1, "superactive")] == 1400 and got[(2, "dormant")] == 450 and got[(1, "non-active")] == 850
    assert got[(3, "all")] == 3000 and got[(5, "non-active")] == 1780 and got[(4, "frequent")] == 650


def test_full_view_filter(spark, dash):
    dashboard_views(spark, dash)
    a = rows(select_view(spark, "full", age=1, gender="F"))
    b = rows(segment_filter(dash, age=1, gender="F").select("time_period", "age", "gender", "type", "count"))
    assert a == b and len(a) == 25
    assert select_view(spark, "age").count() == 25  # default parameter age = 1


def test_rollups_and_grouping_sets(dash):
    by_gender = rows(segment_rollup(dash, ("gender",)))
    assert len(by_gender) == 50
    seg = segmentations(dash, with_total=False)
    for name, cols in (("age", ("age",)), ("gender", ("gender",)), ("age and gender", ("age", "gender"))):
        part = seg.where(seg.segmentation == name).select(*cols, "time_period", "type", "count")
        assert rows(part) == rows(segment_rollup(dash, cols))


def test_total_rows_sum_types(dash):
    plain = dash.where("type != 'all'")
    seg = segmentations(plain, names=("age",), with_total=True)
    totals = {(r.age, r.time_period): r["count"] for r in seg.where("type = 'all'").collect()}
    assert totals[(1, 1)] == 2000 and len(totals) == 15


def test_chart_pivot(dash):
    chart = activity_chart(dash, ("superactive", "all"))
    r = {x.time_period: x for x in chart.collect()}
    assert r[1]["all"] == 6000 and r[1]["superactive"] == 2500


def test_parquet_csv_round_trip(spark, dash):
    p = scratch_path(spark, "t-parquet")
    write_parquet(dash, p, partition_by=("gender",))
    assert rows(spark.read.parquet(p).select(*dash.columns)) == rows(dash)
    one = scratch_path(spark, "t-single")
    write_single_parquet(dash, one)
    assert len([f for f in os.listdir(local_path(one)) if f.endswith(".parquet")]) == 1
    c = scratch_path(spark, "t-csv")
    write_csv(dash, c)
    back = spark.read.csv(c, header=True, inferSchema=True)
    assert back.count() == 150


def test_csv_maps(spark):
    import pathlib
    tmp_path = pathlib.Path(local_path(scratch_path(spark, "t-maps")))
    tmp_path.mkdir(parents=True)
    (tmp_path / "profile.csv").write_bytes("\ufeffdevice_id,age,gender\r\n1,2,female\r\n".encode("utf-8"))
    prof = read_profile(spark, str(tmp_path / "profile.csv"))
    assert prof.columns == ["device_id", "age", "gender"]
    assert rows(prof) == [("1", "2", "female")]
    (tmp_path / "content.csv").write_text("Title,Length\nPhonics,4:01\n")
    assert rows(read_content_map(spark, str(tmp_path / "content.csv"))) == [("Phonics", "4:01")]
    (tmp_path / "usage.csv").write_text(",Device ID,Content ID,Time Period\n0,11,1,1\n1,22,2,2\n")
    u = read_usage_input(spark, str(tmp_path / "usage.csv"))
    assert u.columns == ["Device ID", "Content ID", "Time Period"]
    assert rows(u) == [(11, 1, "1"), (22, 2, "2")]


def test_missing_input_raises(spark):
    from playlens.sources import read_device_log
    with pytest.raises(AnalysisException):
        read_device_log(spark, "/nonexistent/playlens/log")


def test_view_parameters_are_bound_not_spliced(spark, dash):
    dashboard_views(spark, dash)
    assert select_view(spark, "gender", gender="M' OR '1'='1").count() == 0
    assert select_view(spark, "gender", gender="M").count() == 25


def test_checked_csv_reads_rows_and_lists_the_rest(spark, tmp_path):
    from playlens.operators import rejected_lines
    from playlens.sources import read_checked_csv, readable
    path = tmp_path / "usage.csv"
    path.write_text(",Device ID,Content ID,Time Period\n0,1,2,a\n1,x,2,b\n2,3\n3,4,5,c,6\n4,,7,d\n")
    checked = read_checked_csv(spark, str(path), "usage")
    assert sorted(map(tuple, readable(checked).collect())) == [(0, 1, 2, "a"), (4, None, 7, "d")]
    bad = rejected_lines(checked, "usage").collect()
    assert sorted(r["line"] for r in bad) == ["1,x,2,b", "2,3", "3,4,5,c,6"]
    assert {r["source"] for r in bad} == {"usage"} and all(r["file"].endswith("usage.csv") for r in bad)
    other = tmp_path / "profile.csv"
    other.write_text("note,GENDER,Device_ID,age\nn,F,d1,3\nn,M\n")
    checked = read_checked_csv(spark, str(other), "profile")
    assert list(map(tuple, readable(checked).collect())) == [("d1", "3", "F")]
    assert [r["line"] for r in rejected_lines(checked, "profile").collect()] == ["n,M"]
    with pytest.raises(ValueError):
        read_checked_csv(spark, str(other), "content")
    with pytest.raises(ValueError):
        read_checked_csv(spark, str(tmp_path / "profile.csv")[:-11] + "usage.csv", "profile")


def test_functions_leave_the_users_views_alone(spark):
    from playlens.operators import dashboard_functions, select_function
    dash = spark.createDataFrame([(1, 1, "M", "active", 2), (1, 1, "F", "active", 3), (2, 2, "M", "rare", 4), (1, None, "M", "rare", 5)],
                                 "time_period INT, age INT, gender STRING, type STRING, count LONG")
    for name in ("full", "age", "gender"):
        spark.range(1).toDF("mine").createOrReplaceTempView(name)
    dashboard_functions(spark, dash)
    dashboard_functions(spark, dash.where("age = 1"), prefix="young")
    assert rows(select_function(spark, "full")) == [(1, 1, "M", "active", 2)]
    assert rows(select_function(spark, "age", age=1), "age", "time_period", "type", "count") == [(1, 1, "active", 5)]
    assert rows(select_function(spark, "gender", gender="F"), "gender", "time_period", "type", "count") == [("F", 1, "active", 3)]
    assert rows(select_function(spark, "gender", gender="x' OR '1'='1")) == []
    assert rows(select_function(spark, "age", prefix="young", age=2)) == []
    assert spark.sql("SELECT sum(count) AS n FROM dashboard_age(age => 2)").first()["n"] == 4
    for name in ("full", "age", "gender"):
        assert spark.table(name).columns == ["mine"]
    with pytest.raises(ValueError):
        select_function(spark, "age", gender="M")
    with pytest.raises(ValueError):
        dashboard_functions(spark, dash, prefix="a b")


def test_rewritten_partition_leaves_the_others_files(spark, tmp_path):
    path = str(tmp_path / "usage")
    first = spark.createDataFrame([("a", 1, 5), ("b", 1, 6), ("a", 2, 7)], "device_id STRING, bucket INT, count INT")
    write_parquet(first, path, partition_by=("bucket",))
    files = lambda b: {f: os.path.getmtime(os.path.join(path, f"bucket={b}", f)) for f in os.listdir(os.path.join(path, f"bucket={b}"))}
    before = files(2), files(1)
    write_parquet(first.where("bucket = 1").selectExpr("device_id", "bucket", "count + 10 AS count"), path,
                  partition_by=("bucket",), only_partitions=True)
    assert rows(spark.read.parquet(path), "device_id", "bucket", "count") == [("a", 1, 15), ("a", 2, 7), ("b", 1, 16)]
    assert files(2) == before[0] and not set(files(1)) & set(before[1])
    with pytest.raises(ValueError):
        write_parquet(first, path, only_partitions=True)


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    from playlens.operators import users_by_segment
    from playlens.sources import write_bucketed
    usage = spark.range(900).selectExpr("CAST(id % 300 AS STRING) AS device_id", "CAST(id DIV 300 AS INT) AS bucket", "id % 7 AS count")
    profile = spark.range(280).selectExpr("CAST(id AS STRING) AS device_id", "CAST(id % 5 AS STRING) AS age", "'F' AS gender")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of many devices
    try:
        u = write_bucketed(usage, "stage_usage", str(tmp_path / "usage"), buckets=4)
        p = write_bucketed(profile, "stage_profile", str(tmp_path / "profile"), buckets=4)
        got = users_by_segment(u, p)
        got_rows = rows(got)
        text = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "SortMergeJoin [device_id" in text and "hashpartitioning(device_id" not in text
        assert "hashpartitioning(device_id" in users_by_segment(usage, profile)._jdf.queryExecution().executedPlan().toString()
        assert got_rows == rows(users_by_segment(usage, profile)) and got_rows
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS stage_usage")
        spark.sql("DROP TABLE IF EXISTS stage_profile")
