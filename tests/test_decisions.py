
from __future__ import annotations

from pyspark.sql import functions as F

from conftest import log_frame, rows
from playlens.config import CohortConfig, PopularityConfig
from playlens.functions import (
    day_bucket, duration_epoch, duration_time_of_day, end_of_stream, item_name, length_seconds,
    month_bucket, personal_cutoff, play_weight, shift_date,
)
from playlens.operators import (
    count_usage, first_time_users, pair_plays, price_sessions, rejects, score_plays,
)

CONNECT, START, FINISH = "DEVICE_FIRST_TIME_CONNECTED", "ITEM_PLAY_STARTED", "ITEM_PLAY_FINISHED"


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} STRING" for k in cols))
    return df.select(expr.alias("v")).first()["v"]


def test_d1_cutoff_month_index(spark):
    assert one(spark, personal_cutoff("s", 90), s="2019-09-10T00:00:00") == "2019-12-10T00:00:00"
    assert one(spark, personal_cutoff("s", 90), s="2019-11-01T00:00:00") == "2020-02-01T00:00:00"


def test_d2_shift_into_previous_year(spark):
    assert one(spark, shift_date("s", F.lit(1)), s="2019-01-05T00:00:00") == "2018-12-05T00:00:00"
    assert one(spark, shift_date("s", F.lit(13)), s="2019-01-05T10:11:12.877Z") == "2017-12-05T10:11:12.877Z"


def test_d3_reference_keeps_month_index(spark):
    assert one(spark, shift_date("s", F.lit(14)), s="2020-03-10T00:00:00") == "2019-01-10T00:00:00"


def test_d4_bucket_day_arithmetic(spark):
    assert one(spark, day_bucket("s", "r", 30), s="2020-01-01T00:00:00", r="2019-12-31T00:00:00") == 1


def test_d5_no_upper_clamp(spark):
    assert one(spark, day_bucket("s", "r", 30), s="2019-03-31T00:00:00", r="2019-01-01T00:00:00") == 4
    # floor, not truncation, below the reference
    assert one(spark, day_bucket("s", "r", 30), s="2018-12-31T00:00:00", r="2019-01-01T00:00:00") == 0


def test_d6_durations(spark):
    s, e = "2019-01-01T23:59:50", "2019-01-02T00:00:10"
    assert one(spark, duration_time_of_day("s", "e"), s=s, e=e) == -86380
    assert one(spark, duration_epoch("s", "e"), s=s, e=e) == 20
    assert one(spark, duration_epoch("s", "e"), s="2019-01-01T00:00:00.9", e="2019-01-01T00:00:01.1") == 1


def test_d7_d8_pairing_not_exclusive_and_by_flag(spark):
    log = log_frame(spark, [
        ("d", START, '{"item_name":"A.mp3"}', "2019-01-01T00:00:01"),
        ("d", START, '{"item_name":"A.mp3"}', "2019-01-01T00:00:02"),
        ("d", FINISH, '{"item_name":"A.mp3","did_reach_end_of_stream":false}', "2019-01-01T00:00:03"),
        ("d", FINISH, '{"item_name":"A.mp3","did_reach_end_of_stream":true}', "2019-01-01T00:00:04"),
    ])
    strict = rows(pair_plays(log), "start_time", "end_time")
    assert strict == [("2019-01-01T00:00:01", "2019-01-01T00:00:03"), ("2019-01-01T00:00:02", "2019-01-01T00:00:03")]
    flagged = rows(pair_plays(log, strict=False, by_flag=True), "start_time", "end_time", "reach_end_of_stream")
    assert flagged == [("2019-01-01T00:00:01", "2019-01-01T00:00:03", False),
                       ("2019-01-01T00:00:01", "2019-01-01T00:00:04", True),
                       ("2019-01-01T00:00:02", "2019-01-01T00:00:03", False),
                       ("2019-01-01T00:00:02", "2019-01-01T00:00:04", True)]


def test_ties_strict_and_non_strict(spark):
    log = log_frame(spark, [
        ("d", START, '{"item_name":"A"}', "2019-01-01T00:00:05"),
        ("d", FINISH, '{"item_name":"A"}', "2019-01-01T00:00:05"),
        ("d", FINISH, '{"item_name":"A"}', "2019-01-01T00:00:09"),
    ])
    assert rows(pair_plays(log, strict=True), "end_time") == [("2019-01-01T00:00:09",)]
    assert rows(pair_plays(log, strict=False), "end_time") == [("2019-01-01T00:00:05",)]


def test_d9_earliest_first_connect(spark):
    log = log_frame(spark, [("d", CONNECT, "", "2019-05-01T00:00:00"), ("d", CONNECT, "", "2019-03-02T00:00:00")])
    assert rows(first_time_users(log, CohortConfig()), "device_id", "setup_time", "shift_factor") == [
        ("d", "2019-03-02T00:00:00", 2)]


def test_d10_unreadable_rows_drop_and_are_listed(spark):
    log = log_frame(spark, [
        ("d", START, "{}", "2019-01-01T00:00:00"),
        ("d", START, "not json", "2019-01-01T00:00:01"),
        ("d", START, '{"item_name":"A.mp3"}', "2019-01-01T00:00:02"),
        ("d", FINISH, '{"item_name":"A.mp3"}', "2019-01-01T00:00:03"),
    ])
    assert rows(pair_plays(log), "start_time") == [("2019-01-01T00:00:02",)]
    cm = spark.createDataFrame([("A", "abc"), ("B", "1:05")], "title STRING, length STRING")
    assert rows(rejects(log, cm), "source", "id", "reason") == [
        ("content", "A", "length is not M:SS"), ("log", "d", "no item_name"), ("log", "d", "payload is not JSON")]


def test_d11_zero_length_item(spark):
    s = spark.createDataFrame([("d", "2019-01-01T00:00:00", "Z", "2019-01-01T00:00:00", 1)],
                              "device_id STRING, start_time STRING, item_name STRING, end_time STRING, bucket INT")
    cm = spark.createDataFrame([("Z", "0:00")], "title STRING, length STRING")
    assert rows(count_usage(price_sessions(s, cm), CohortConfig()), "count") == [(1,)]
    import datetime as dt
    t = dt.datetime(2019, 1, 1)
    sc = spark.createDataFrame([("d", "Z.mp3", t, t, True)],
                               "device_id STRING, item_name STRING, start TIMESTAMP, end TIMESTAMP, reach_end_of_stream BOOLEAN")
    assert score_plays(sc, cm).count() == 0


def test_d12_default_weights(spark):
    assert PopularityConfig().third == 0.67
    assert one(spark, play_weight(F.lit(0.6), PopularityConfig().weights()), x="") == 0.67
    assert one(spark, play_weight(F.lit(1.2), PopularityConfig().weights()), x="") is None
    assert one(spark, play_weight(F.lit(None).cast("double"), (0.0, 0.33, 0.66, 1.0), "full"), x="") == 1.0
    assert one(spark, play_weight(F.lit(-0.5), (0.0, 0.33, 0.66, 1.0), "full"), x="") == 1.0


def test_payload_fields(spark):
    assert one(spark, item_name("p"), p='{"item_name":"Dr. Seuss.mp3"}') == "Dr"
    assert one(spark, item_name("p"), p="{}") is None
    for p, want in [('{"did_reach_end_of_stream":true}', True), ('{"did_reach_end_of_stream":" true "}', True),
                    ('{"did_reach_end_of_stream":"True"}', False), ("{}", False), ("x", False)]:
        assert one(spark, end_of_stream("p"), p=p) is want


def test_length_parsing(spark):
    assert one(spark, length_seconds("x"), x="4:15") == 255
    assert one(spark, length_seconds("x"), x="75:00") == 4500
    assert one(spark, length_seconds("x", strict=True), x="75:00") is None
    assert one(spark, length_seconds("x", strict=True), x="0:41") == 41
    assert one(spark, length_seconds("x"), x="abc") is None


def test_month_bucket(spark):
    assert one(spark, month_bucket("s", F.lit("2019-01"), 90), s="2019-04-15T00:00:00") == 3
    assert one(spark, month_bucket("s", F.lit("2019-01"), 2), s="2019-04-15T00:00:00") is None


def test_activity_thresholds_are_double_products():
    # thresholds are fraction × bin length in double arithmetic, as in the original
    cfg = CohortConfig(active=0.1, semi_active=0.06, rare=0.03)
    assert cfg.activity_thresholds() == (0.1 * 30.0, 0.06 * 30.0, 0.03 * 30.0, 0.0)


def test_timestamp_log_at_the_reference_date(spark, tmp_path):
    """A device connected exactly at the reference date is no new user, however stored."""
    from playlens.sources import read_device_log
    cfg = CohortConfig()
    log = log_frame(spark, [("a", CONNECT, "", cfg.reference_date), ("b", CONNECT, "", "2019-02-01T00:00:00.5")])
    log.withColumn("time", F.col("time").cast("timestamp")).write.parquet(str(tmp_path / "log"))
    stored = read_device_log(spark, str(tmp_path / "log"))
    assert rows(stored, "time") == [(cfg.reference_date,), ("2019-02-01T00:00:00.500000",)]
    assert rows(first_time_users(stored, cfg), "device_id") == [("b",)]
    assert rows(first_time_users(log, cfg), "device_id") == [("b",)]


def test_d10_unreadable_length_or_duration_drops_without_check(spark):
    s = spark.createDataFrame([("d", "2019-01-01T00:00:00", "A", "2019-01-01T00:01:00", 1),
                               ("d", "2019-01-01T00:00:00", "B", "2019-01-01T00:01:00", 1),
                               ("d", "2019-02-31T00:00:00", "B", "2019-01-01T00:01:00", 1)],
                              "device_id STRING, start_time STRING, item_name STRING, end_time STRING, month INT")
    cm = spark.createDataFrame([("A", "abc"), ("B", "1:00")], "title STRING, length STRING")
    got = price_sessions(s, cm, duration="epoch", check=False)
    assert rows(got, "item_name", "start_time") == [("B", "2019-01-01T00:00:00")]


def test_f18_seconds_end_at_59(spark):
    assert one(spark, length_seconds("x", strict=True), x="1:59") == 119
    assert one(spark, length_seconds("x", strict=True), x="1:60") is None
    assert one(spark, length_seconds("x", strict=True), x="1:61") is None


def test_one_payload_reader(spark):
    """Pairing, the field functions and the rejects read payloads alike."""
    cases = [('{"item_name":"A","item_name":"B"}', "B"), ('{"item_name":"A"} trailing', None),
             ('{"item_name":"A","x":NaN}', "A"), ("{'item_name':'A'}", None), ('[{"item_name":"A"}]', None),
             ("", None), (None, None), ('{"item_name":null}', None)]
    for payload, want in cases:
        assert spark.createDataFrame([(payload,)], "p STRING").select(item_name("p").alias("v")).first()["v"] == want
        log = log_frame(spark, [("d", START, payload, "2019-01-01T00:00:02"), ("d", FINISH, payload, "2019-01-01T00:00:03")])
        assert rows(pair_plays(log), "item_name") == ([(want,)] if want else []), payload
        assert rejects(log).count() == (0 if want else 2), payload
    twice = '{"item_name":"A","did_reach_end_of_stream":true,"did_reach_end_of_stream":false}'
    assert one(spark, end_of_stream("p"), p=twice) is False


def test_rejects_list_unreadable_times_and_devices(spark):
    good = '{"item_name":"A"}'
    log = log_frame(spark, [("d", START, good, None), ("d", START, good, "soon"), (None, START, good, "2019-01-01T00:00:00"),
                            ("d", START, good, "2019-01-01T00:00:00")])
    assert rows(rejects(log), "reason") == [("no device_id",), ("time is not readable",), ("time is not readable",)]


def test_cluster_without_shared_folder_is_an_error():
    from types import SimpleNamespace
    import pytest
    from playlens.session import ensure_checkpoint_dir

    class Conf:
        def get(self, *a):
            return None
    fake = SimpleNamespace(conf=Conf(), sparkContext=SimpleNamespace(
        getCheckpointDir=lambda: None, getConf=Conf, master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake)


def test_popularity_has_the_same_bits_in_any_order(spark):
    """Sums of weights differ in the last bits with the order of the rows; counts do not."""
    from playlens.operators import content_popularity
    scored = spark.range(3000).selectExpr("CAST(id % 40 AS STRING) AS device_id", "CONCAT('i', id % 2) AS item_name",
                                          "0.5D AS PercentPlayed", "element_at(array(0.33D, 0.67D, 0.1D, 1D), CAST(id % 4 AS INT) + 1) AS weight")
    profile = spark.range(40).selectExpr("CAST(id AS STRING) AS device_id", "'1' AS age", "'F' AS gender")
    seen = set()
    for n, key in ((1, "device_id"), (3, "weight"), (7, "item_name")):
        got = content_popularity(scored.repartition(n, key), profile).collect()
        seen.add(tuple(sorted((r["item_name"], r["weighted_sum"].hex()) for r in got)))
    assert len(seen) == 1
    per = {"i0": (0.33, 0.1), "i1": (0.67, 1.0)}
    for name, total in next(iter(seen)):
        low, high = sorted(per[name])
        assert float.fromhex(total) == low * 750.0 + high * 750.0


def test_tolerant_payloads(spark):
    from playlens.functions.payload import split_item_name, tolerant_fields
    cases = [('{"item_name":"A.mp3"}', "A.mp3", None), ("{'item_name': 'A b.mp3', 'did_reach_end_of_stream': true}", "A b.mp3", "true"),
             ('{"did_reach_end_of_stream":true,"item_name":"A.mp3', "A.mp3", "true"), ("item_name=A.mp3;x=1", "A.mp3", None),
             ('{"item_name":', None, None), ("not json", None, None), ('{"my_item_name":"A"}', None, None), (None, None, None),
             ('{"item_name":"A"} trailing', "A", None), ('{"item_name":"","x":1}', "", None), ('{"item_name":"A",}', "A", None)]
    df = spark.createDataFrame([(i, p) for i, (p, _, _) in enumerate(cases)], "i INT, payload STRING")
    got = df.select("i", tolerant_fields("payload").alias("f")).select("i", "f.*").orderBy("i").collect()
    assert [(r["item_name"], r["did_reach_end_of_stream"]) for r in got] == [(n, f) for _, n, f in cases]
    assert one(spark, split_item_name("p"), p='{"category":"Songs","item_name":"Dr. A.mp3"}') == "Dr. A.mp3"
    assert one(spark, split_item_name("p", finished=True), p='{"did_reach_end_of_stream":true,"category":"Songs","item_name":"A.mp3"}') == "A.mp3"
    assert one(spark, split_item_name("p"), p='{"category":"Songs"}') is None


def test_tolerant_pairing_by_argument(spark):
    log = log_frame(spark, [("d", START, "{'item_name': 'A.mp3'}", "2019-01-01T00:00:01"),
                            ("d", FINISH, '{"item_name":"A.mp3"', "2019-01-01T00:00:09")])
    assert pair_plays(log).count() == 0 and rejects(log).count() == 2
    assert rows(pair_plays(log, payloads="tolerant")) == [("d", "A", "2019-01-01T00:00:01", "2019-01-01T00:00:09")]
    from playlens.operators import rejected_events
    assert rejected_events(log, payloads="tolerant").count() == 0
