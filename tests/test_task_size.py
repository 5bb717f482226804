"""What one task holds does not grow with the tables: partition sizes and partitioned writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import log_frame
from playlens.session import apply_defaults
from playlens.sources.sinks import write_parquet
from test_pairing import random_log, same


def test_more_data_gives_more_tasks(spark):
    apply_defaults(spark)
    first = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    spark.conf.set(first, "false")  # else a machine's cores set the number of tasks for small data
    try:
        # about 60 MB of text that hardly compresses
        rows = spark.range(1_000_000, numPartitions=4).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
        tasks = len(rows.repartition("id").groupBy(F.spark_partition_id().alias("p")).agg(F.max("text")).collect())
    finally:
        spark.conf.unset(first)
    assert tasks >= 3


def test_few_shuffle_partitions_do_not_make_large_tasks(spark):
    number, first = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    had = spark.conf.get(number)
    spark.conf.set(number, "2")
    spark.conf.set(first, "false")
    apply_defaults(spark)
    try:
        # about 60 MB of text that hardly compresses: 30 MB in each of two partitions
        rows = spark.range(1_000_000, numPartitions=4).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
        tasks = rows.repartition("id").groupBy(F.spark_partition_id().alias("p")).agg(
            F.count("text").alias("n"), F.max("text")).collect()
    finally:
        spark.conf.unset(first)
        spark.conf.set(number, had)
    assert sum(t.n for t in tasks) == 1_000_000
    assert len(tasks) >= 3


def test_a_larger_number_of_partitions_counts(spark):
    number, initial = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    apply_defaults(spark)
    had, before = spark.conf.get(number), spark.conf.get(initial)
    assert int(before) >= 1000
    try:
        spark.conf.set(number, "4000")
        apply_defaults(spark)
        assert spark.conf.get(initial) == "4000"
    finally:
        spark.conf.set(number, had)
        spark.conf.set(initial, before)


def test_a_task_scans_a_part_of_a_large_file(spark, tmp_path):
    apply_defaults(spark)
    path, least = str(tmp_path / "text"), "spark.sql.files.minPartitionNum"
    spark.range(1_000_000, numPartitions=1).select(F.sha2(F.col("id").cast("string"), 256).alias("text")).write.option(
        "compression", "none").text(path)
    spark.conf.set(least, "1")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() >= 4  # 65 MB
    finally:
        spark.conf.unset(least)


def test_a_partitioned_write_sorts_nothing(spark, tmp_path):
    apply_defaults(spark)
    log = log_frame(spark, random_log(5))
    log.createOrReplaceTempView("size_log")
    spark.sql(f"CREATE TABLE size_table (device_id STRING, event STRING) USING parquet PARTITIONED BY (event) "
              f"LOCATION '{tmp_path}/table'")
    try:
        text = spark.sql("EXPLAIN INSERT INTO size_table SELECT device_id, event FROM size_log").first()[0]
    finally:
        spark.sql("DROP TABLE size_table")
    assert "Sort" not in text, text
    path = str(tmp_path / "log")
    write_parquet(log, path, partition_by=("event",))
    same(spark.read.parquet(path).select(*log.columns), log)


def test_more_partitions_than_open_files_are_written_whole(spark, tmp_path):
    apply_defaults(spark)
    rows = spark.range(0, 5000, numPartitions=2).select("id", F.pmod("id", F.lit(40)).cast("int").alias("bucket"))
    path = str(tmp_path / "buckets")
    write_parquet(rows, path, partition_by=("bucket",))
    same(spark.read.parquet(path).select("id", "bucket"), rows)
