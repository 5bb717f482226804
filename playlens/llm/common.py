"""Helpers shared by the operators: tables, hand-over files, fixed-size bitmaps."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.session import scratch_path

# The two characters outside ASCII whose Unicode lower case holds an ASCII letter.
_TO_ASCII = {"İ": "", "K": ""}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str, rows_in_group: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    This cuts the lineage in storage that every executor reaches, so a lost
    executor repeats tasks of the current step only, and a step that is read
    twice is computed once. ``rows_in_group``: rows in a row group at most, for rows of large lists
    (a reader decodes many rows of a group at once).
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    group = {} if rows_in_group is None else {"parquet.block.row.count.limit": str(rows_in_group)}
    df.write.options(**group).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, most: dict[str, int]) -> None:
    """Lower the session's limits of an Arrow batch to ``most``; a positive number below that stays."""
    for key, limit in most.items():
        text = spark.conf.get(key)
        own = int(text) if text.lstrip("-").isdigit() else 0  # else a size with a unit
        if not 0 < own <= limit:
            spark.conf.set(key, str(limit))


def lower_for_ascii(text: Column) -> Column:
    """Lower case in which exactly the letters A-Z become a-z among the ASCII
    characters. Characters outside ASCII stay outside ASCII, so splitting on ASCII
    separators and comparing with ASCII words give the same as lowering A-Z alone."""
    for c, private in _TO_ASCII.items():
        text = F.replace(text, F.lit(c), F.lit(private))
    return F.lower(text)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers import this package: once per application, its sources
    are zipped and handed to Spark, as ``--py-files`` would."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    folder = tempfile.mkdtemp(prefix="playlens-py-")  # Spark serves the file from here
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, "playlens-src"), "zip", top, "playlens"))
    _SHIPPED.add(app)


def arrow_map(df: DataFrame, fn, schema) -> DataFrame:
    """``df.mapInArrow`` with workers that can import this package, and that keep no free
    Arrow memory of a task for the next one."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bitmap_positions(h: Column, log2_bits: int, hashes: int = 1) -> Column:
    """Bit positions of a 64-bit hash in a bitmap of ``2**log2_bits`` bits."""
    step = F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    mask = F.lit((1 << log2_bits) - 1)
    # bits of h and of its upper half: two's-complement products never overflow here
    low = h.bitwiseAND(F.lit(0xFFFFFFFF))
    return F.array(*[(low + step * F.lit(i)).bitwiseAND(mask) for i in range(hashes)])


def build_bitmap(df: DataFrame, h: Column, log2_bits: int, hashes: int = 1) -> np.ndarray:
    """Bloom bitmap over the 64-bit hashes ``h`` of ``df`` as 64-bit words.

    The bits are gathered by an aggregate with a map-side part; what reaches the
    driver is at most ``2**log2_bits / 64`` numbers, however many rows there are.
    """
    pos = F.explode(bitmap_positions(h, log2_bits, hashes)).alias("p")
    words = (df.where(h.isNotNull()).select(pos)
             .groupBy(F.shiftright("p", 6).cast("int").alias("w"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"),
                                           F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("b")))
    out = np.zeros(max(1, (1 << log2_bits) >> 6), dtype=np.uint64)
    got = words.toPandas()
    out[got["w"].to_numpy(dtype=np.int64)] = got["b"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def in_bitmap(bitmap: np.ndarray, h: np.ndarray, hashes: int = 1) -> np.ndarray:
    """Boolean array: whether each 64-bit hash may be in the bitmap."""
    h = h.view(np.uint64)
    low, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    mask = np.uint64(len(bitmap) * 64 - 1)
    out = np.ones(len(h), dtype=bool)
    for i in range(hashes):
        p = (low + step * np.uint64(i)) & mask
        out &= (bitmap[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
    return out
