"""Driver test tables → device log, content map and profile.

Each line item becomes one play by the ordering customer:

* device: the customer key as text; item: ``item<partkey mod 20>.mp3``;
* start: ship date + line number × 12000 + ``(orderkey * 7919) mod 3600`` seconds;
* finish: start + quantity × 13 seconds (some plays run over midnight); reached the
  end when the return flag is ``A``;
* one first-connect event per device at midnight of its first play day, and for
  every third customer key a second one 40 days later.

The log is as untidy as a real one. By the order key, some plays come twice, some
starts have no payload, no time, text that is no JSON or no item name, and some
finishes a cut-off payload or no device. The content map has one length per item
(the size of the part with the largest key of the item's group, × 13 seconds), with
an unreadable length, a title twice, a title nobody plays and two played items
without a title; every tenth customer has no profile.
Every table is a lazy DataFrame over the parquet files, so its work grows
with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.functions.payload import DEVICE_FIRST_TIME_CONNECTED, ITEM_PLAY_FINISHED, ITEM_PLAY_STARTED
from playlens.session import scratch_path
from playlens.sources.logs import events, read_device_log
from playlens.sources.sinks import write_parquet

ISO = "yyyy-MM-dd'T'HH:mm:ss"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    off = F.col("l_linenumber") * 12000 + F.pmod(F.col("l_orderkey") * 7919, F.lit(3600))
    dur = F.col("l_quantity").cast("int") * 13
    # Orders grow with line items, so this is a large-large join at scale and
    # shuffles on the order key. Saying so (merge hint) also keeps small runs,
    # whose tables are single row groups, from doing all later work in one task.
    return (li.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("l_orderkey").alias("ok"), F.col("o_custkey").cast("string").alias("device_id"),
                    F.concat(F.lit("item"), F.pmod(F.col("l_partkey"), F.lit(20)).cast("string"),
                             F.lit(".mp3")).alias("nm"),
                    (F.col("l_returnflag") == F.lit("A")).alias("flag"),
                    F.timestamp_add("SECOND", off, F.col("l_shipdate")).alias("st"),
                    F.timestamp_add("SECOND", off + dur, F.col("l_shipdate")).alias("en")))


def _every(n: int) -> Column:
    return F.pmod(F.col("ok"), F.lit(n)) == 0


def play_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start and finish events ``device_id, event, payload, time`` (all text), from one
    pass over the plays."""
    named = F.concat(F.lit('"category":"Songs","item_name":"'), F.col("nm"), F.lit('"}'))
    reached = F.concat(F.lit('{"did_reach_end_of_stream":'), F.col("flag").cast("string"), F.lit(","), named)
    start = F.struct(
        F.col("device_id").alias("device_id"), F.lit(ITEM_PLAY_STARTED).alias("event"),
        F.when(_every(101), None).when(_every(107), "not json").when(_every(109), '{"category":"Songs"}')
        .otherwise(F.concat(F.lit("{"), named)).alias("payload"),
        F.when(~_every(103), F.date_format("st", ISO)).alias("time"))
    finish = F.struct(
        F.when(~_every(127), F.col("device_id")).alias("device_id"), F.lit(ITEM_PLAY_FINISHED).alias("event"),
        F.when(_every(113), '{"item_name":').otherwise(reached).alias("payload"),
        F.date_format("en", ISO).alias("time"))
    copies = F.when(_every(50), 2).otherwise(1)
    return plays(spark, sf_dir).select(F.inline(F.flatten(F.array_repeat(F.array(start, finish), copies))))


def connect_events(play_events: DataFrame) -> DataFrame:
    """First-connect events of the devices that start a play."""
    first = (events(play_events, ITEM_PLAY_STARTED)
             .where(F.col("device_id").isNotNull() & F.col("time").isNotNull())
             .groupBy("device_id").agg(F.min(F.substring("time", 1, 10)).alias("day")))
    days = F.when(F.pmod(F.col("device_id").cast("long"), F.lit(3)) == 0, F.array(F.lit(0), F.lit(40))).otherwise(
        F.array(F.lit(0)))
    return first.select("device_id", "day", F.explode(days).alias("after")).select(
        "device_id", F.lit(DEVICE_FIRST_TIME_CONNECTED).alias("event"), F.lit("").alias("payload"),
        F.concat(F.date_add(F.col("day").cast("date"), F.col("after")).cast("string"), F.lit("T00:00:00")).alias("time"))


_STORED: dict[tuple, str] = {}


def stored_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived device log, written once per application and state of the tables to
    the shared checkpoint folder as Parquet partitioned by ``event``, then read
    back like a production log (event filters prune partitions, projections
    prune columns). The plays are joined and written first; the connect events are
    derived from what was written."""
    newest = tuple(table(spark, sf_dir, t).agg(F.max("_metadata.file_modification_time")).first()[0]
                   for t in ("lineitem", "orders"))
    key = (spark.sparkContext.applicationId, sf_dir, newest)
    path = _STORED.get(key)
    if path is None:
        path = scratch_path(spark, "device-log")
        write_parquet(play_log(spark, sf_dir), path, partition_by=("event",))
        write_parquet(connect_events(read_device_log(spark, path)), path, mode="append", partition_by=("event",))
        _STORED[key] = path
    return read_device_log(spark, path)


def content_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``title, length`` (``M:SS``) from the whole part table: item k gathers the parts
    with key ≡ k (mod 20), as plays do."""
    k = F.col("k")
    grouped = (table(spark, sf_dir, "part").groupBy(F.pmod(F.col("p_partkey"), F.lit(20)).alias("k"))
               .agg(F.max_by("p_size", "p_partkey").alias("size")))
    title = F.when(k == 17, "item17x").when(k == 19, "item5").otherwise(F.concat(F.lit("item"), k.cast("string")))
    secs = F.col("size") * 13
    length = F.concat((secs / 60).cast("int").cast("string"), F.lit(":"),
                      F.lpad(F.pmod(secs, F.lit(60)).cast("string"), 2, "0"))
    return grouped.select(title.alias("title"), F.when(k == 13, "abc").otherwise(length).alias("length"))


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``device_id, age, gender`` (all text), one row per customer; those of every tenth
    customer key belong to no device of the log."""
    key = F.col("c_custkey").cast("string")
    return table(spark, sf_dir, "customer").select(
        F.when(F.pmod(F.col("c_custkey"), F.lit(10)) == 7, F.concat(F.lit("x"), key)).otherwise(key).alias("device_id"),
        (F.pmod(F.col("c_nationkey"), F.lit(6)) + 1).cast("string").alias("age"),
        F.when(F.pmod(F.col("c_custkey"), F.lit(2)) == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"))
