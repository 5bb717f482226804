"""Counts of a step that Spark leaves out of the plan because its input turns out empty."""

from __future__ import annotations

from pyspark.sql import functions as F

from playlens.operators.accounting import DropCounts


def test_a_step_left_out_for_an_empty_input_is_not_listed(spark, tmp_path):
    path, drops = str(tmp_path / "rows"), DropCounts()
    spark.range(0).selectExpr("id", "id % 3 AS k").write.parquet(path)
    some = spark.read.parquet(path).groupBy("k").count()  # known to be empty once its stage has run
    kept = drops.keep(some, "none", {"zero": F.col("k") == 0})
    assert kept.groupBy("count").count().orderBy("count").collect() == []
    assert drops.counts() in ({}, {"none": {"rows": 0, "zero": 0}})
