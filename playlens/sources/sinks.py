"""Outputs: Parquet per stage, single-file Parquet for small results, CSV, views."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: tuple[str, ...] = (), only_partitions: bool = False) -> None:
    """Stage hand-over. ``overwrite`` replaces an earlier run's directory; with ``only_partitions``
    just the partitions that ``df`` has rows of, so one day or bin can be written again and the files
    of the others stay as they are."""
    if only_partitions and not (partition_by and mode == "overwrite"):
        raise ValueError("only_partitions goes with partition_by and overwrite")
    w = df.write.mode(mode)
    if only_partitions:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, by: str = "device_id", buckets: int = 64) -> DataFrame:
    """A stage table dealt into ``buckets`` files by the hash of ``by`` and sorted by it, registered as
    ``table`` and read back. Tables with equal buckets join on ``by`` without a shuffle of either."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    # one task per bucket writes one file for it, instead of each task a file for every bucket
    (df.repartition(buckets, by).write.bucketBy(buckets, by).sortBy(by).mode("overwrite")
     .option("path", path).format("parquet").saveAsTable(table))
    return spark.table(table)


def write_single_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One Parquet file. Only for results of bounded size (e.g. one row per
    month): all rows pass through one task."""
    df.coalesce(1).write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    """CSV with a header line, written by the executors (nothing is collected)."""
    df.write.mode(mode).option("header", str(header).lower()).csv(path)


def register_views(spark: SparkSession, views: Mapping[str, DataFrame]) -> None:
    """Register each DataFrame as a session temp view under its key."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
