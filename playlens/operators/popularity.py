"""Percent played, weights and content popularity per segment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.config import PopularityConfig
from playlens.functions.activity import percent_played, play_weight
from playlens.functions.durations import length_seconds, played_for
from playlens.functions.payload import strip_extension
from playlens.operators.accounting import DropCounts
from playlens.operators.segments import join_profile


def score_plays(sessions: DataFrame, content: DataFrame, cfg: PopularityConfig | None = None,
                out_of_range: str = "drop", bare_names: bool = False, drops: DropCounts | None = None) -> DataFrame:
    """``device_id, item_name, PercentPlayed DOUBLE, weight DOUBLE`` per session.

    ``drop``: plays of known items whose share lies in [0, 1]; others (unknown
    item, zero length, negative or over-long play) are dropped.
    ``full``: three quarter weights, everything else (including unmatched plays
    and titles nobody played, with a null device) gets the last weight.
    ``bare_names``: ``item_name`` has no file extension (pairing cuts it off) and is
    joined as it is, so that no expression on it is pushed into the pairing.
    ``drops`` counts what ``drop`` leaves out (step ``scored``).
    """
    cfg = cfg or PopularityConfig()
    plays = sessions.select("device_id",
                            F.col("item_name") if bare_names else strip_extension("item_name").alias("item_name"),
                            played_for("start", "end").alias("_played"))
    cm = content.select(F.col("title").alias("item_name"),
                        length_seconds("length", strict=True).alias("_len"))
    if out_of_range == "drop":
        j = (plays.join(cm, "item_name") if drops is None
             else plays.join(cm.withColumn("_known", F.lit(True)), "item_name", "left"))
    else:
        # Full outer join written as: plays left-join content (whose skewed items
        # adaptive execution can split, unlike a full join's) plus titles no play
        # refers to (anti join against the distinct played items). Both sides read
        # the same pairing, whose exchanges are reused.
        played_items = plays.select("item_name").distinct()
        unplayed = (cm.join(played_items, "item_name", "left_anti")
                    .select(F.lit(None).cast("string").alias("device_id"), "item_name",
                            F.lit(None).cast("bigint").alias("_played"), "_len"))
        j = plays.join(cm, "item_name", "left").select("device_id", "item_name", "_played", "_len")
        j = j.unionByName(unplayed)
    pct = percent_played("_played", "_len")
    known = ["_known"] if "_known" in j.columns else []
    out = j.select("device_id", "item_name", pct.alias("PercentPlayed"),
                   play_weight(pct, cfg.weights(), out_of_range).alias("weight"), *known)
    if known:
        return drops.keep(out, "scored", {"unknown item": F.col("_known").isNull(),
                                          "unreadable length or time": F.col("PercentPlayed").isNull(),
                                          "share out of range": F.col("weight").isNull()}).drop("_known")
    return out.where(F.col("weight").isNotNull()) if out_of_range == "drop" else out


def content_popularity(scored: DataFrame, profile: DataFrame, drops: DropCounts | None = None) -> DataFrame:
    """``item_name, age, gender, weighted_sum``: summed weights per item and segment.

    Plays are counted per weight, and each weight is multiplied by its count at the end,
    smallest weight first. Whole numbers add up to the same in any order, so the sum has the same
    bits however the rows were dealt to tasks; a sum of the weights themselves has not.
    There are as many counts as different weights (four in the pipeline).

    Plays are first counted per (device, item, weight) — a map-side partial
    aggregate — so the profile join sees a few rows per device and item, never a
    hot device's every play. The profile is one row per device; ``drops`` counts the plays
    of devices without one (step ``profiled``).
    """
    per_device = scored.groupBy("device_id", "item_name", "weight").agg(F.count(F.lit(1)).alias("_n"))
    prof = profile.select("device_id", "age", "gender")
    per_weight = (join_profile(per_device, prof, drops, F.col("_n")).where(F.col("weight").isNotNull())
                  .groupBy("item_name", "age", "gender", "weight").agg(F.sum("_n").alias("_n")))
    counts = per_weight.groupBy("item_name", "age", "gender").agg(
        F.sort_array(F.collect_list(F.struct("weight", "_n"))).alias("_counts"))
    total = F.aggregate("_counts", F.lit(0.0), lambda s, c: s + c["weight"] * c["_n"].cast("double"))
    return counts.select("item_name", "age", "gender", total.alias("weighted_sum"))
