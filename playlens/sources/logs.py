"""Device-log input: read, clean, filter."""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import Iterable
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LOG_COLUMNS = ("device_id", "event", "payload", "time")


def read_device_log(spark: SparkSession, path: str | Iterable[str]) -> DataFrame:
    """Parquet device log → ``device_id, event, payload, time`` as STRING.

    ``device_id`` may be stored as a number; it is cast to text so the joins with
    the CSV profile and map tables compare like with like. A ``time`` stored as
    TIMESTAMP is written as ISO text (``YYYY-MM-DDTHH:MM:SS[.ffffff]``). Only the four columns
    are projected, so the scan reads nothing else.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return as_log(spark.read.parquet(*paths))


def as_log(df: DataFrame) -> DataFrame:
    """The log's columns of ``df`` as text; a column it does not have is null."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema}
    cols = []
    for c in LOG_COLUMNS:
        if c not in kinds:
            cols.append(F.lit(None).cast("string").alias(c))
        elif c == "time" and kinds[c] in ("timestamp", "timestamp_ntz"):
            # ISO text with the "T" separator; the fraction is written only where
            # there is one. A text is then a prefix of later ones of its second, so
            # text order equals time order, and a whole second equals its plain text.
            whole = F.date_format(F.col(c), "yyyy-MM-dd'T'HH:mm:ss")
            full = F.date_format(F.col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            cols.append(F.when(full.endswith(".000000"), whole).otherwise(full).alias(c))
        else:
            cols.append(F.col(c).cast("string").alias(c))
    return df.select(*cols)


def read_mixed_device_log(spark: SparkSession, path: str) -> DataFrame:
    """``read_device_log`` for a folder whose files store the columns in different types
    (``device_id`` as a number in some, ``time`` as a timestamp in others, a column missing).

    Spark reads the files' footers in parallel and merges their schemas; where that succeeds the log is
    one scan. Where types conflict, folders are merged by themselves, and only in a folder
    with conflicts is each footer looked at. Files are then grouped by the types of the four columns:
    one scan per group (a handful, however many files), each with its own types, cast to
    text and united. Event filters and column pruning reach every scan."""
    if (merged := _merged_schema(spark, [path])) is not None:
        return as_log(spark.read.schema(merged).parquet(path))
    files = sorted(map(unquote, spark.read.parquet(path).inputFiles()))
    if not files:
        return read_device_log(spark, path)
    folders: dict[str, list[str]] = {}
    for f in files:
        folders.setdefault(f.rsplit("/", 1)[0], []).append(f)
    groups: dict[tuple, tuple[StructType, list[str]]] = {}
    with ThreadPool(FOOTER_THREADS) as pool:  # each call waits for a small job of its own
        whole = pool.map(lambda f: _merged_schema(spark, [f]), folders)
        units = [(schema, [x]) for x, schema in zip(folders, whole) if schema is not None]
        single = [f for x, schema in zip(folders, whole) if schema is None for f in folders[x]]
        units += [(schema, [f]) for f, schema in zip(single, pool.map(lambda f: spark.read.parquet(f).schema, single))]
    for schema, paths in units:
        kinds = tuple((f.name, f.dataType.simpleString()) for f in schema if f.name in LOG_COLUMNS)
        groups.setdefault(tuple(sorted(kinds)), (schema, []))[1].extend(paths)
    parts = []
    for schema, paths in groups.values():
        own = StructType([f for f in schema if f.name in LOG_COLUMNS])
        parts.append(as_log(spark.read.option("basePath", path).schema(own).parquet(*paths)))
    return reduce(DataFrame.unionByName, parts)


#: Folders or files whose footers are asked for at the same time.
FOOTER_THREADS = 16


def _merged_schema(spark: SparkSession, paths: list[str]) -> StructType | None:
    """Schema that all files below the paths agree on, or None where they conflict."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE" in str(e):
            return None
        raise


def clean(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows, then rows with a null in any column.

    ``dropDuplicates`` is a hash aggregate with a map-side partial step, so
    copies collapse before the shuffle and a large group of copies does not
    reach one task whole.
    """
    return df.dropDuplicates().na.drop()


def events(log: DataFrame, *names: str) -> DataFrame:
    """Rows whose ``event`` is one of ``names`` (pushed to the Parquet scan)."""
    if len(names) == 1:
        return log.where(F.col("event") == F.lit(names[0]))
    return log.where(F.col("event").isin(list(names)))


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows, for a look at a stage's output."""
    return df.limit(n)
