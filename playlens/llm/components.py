"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import materialise


def _to_minimum(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Link the neighbours of each ``u`` to the smallest id among them and ``u``.
    ``edges`` has ``u > v``. ``both_ways`` (large star): of all neighbours, the larger
    ones move; else (small star): the smaller ones and ``u`` itself."""
    if both_ways:
        near = edges.union(edges.select("v", "u"))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("k"), F.least("u", "m").alias("m"))
        moved = near.join(least, F.col("u") == F.col("k")).where(F.col("v") > F.col("u")).select("v", "m")
        return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
    moved = edges.join(least, F.col("u") == F.col("k")).select("v", "m")
    kept = least.select(F.col("k").alias("v"), "m")
    return moved.union(kept).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, root`` for each linked id: the smallest id reachable (roots left out).

    Each round is written to the shared folder; the number of rounds grows with
    the logarithm of the longest chain. A vertex with very many links is an
    aggregate with a map-side part and the large side of a join. Rows with a null
    end and links of an id with itself are ignored."""
    x, y = F.col(a), F.col(b)
    edges = materialise(links.where((x != y)).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(),
                        "links")
    last = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == last:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
        last = state
        edges = materialise(_to_minimum(_to_minimum(edges, True), False), "links")
