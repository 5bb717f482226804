"""Small reference tables: content map, profile map, usage input, literal rows."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from playlens.functions.durations import length_seconds

CONTENT_SCHEMA = StructType([StructField("title", StringType()), StructField("length", StringType())])
PROFILE_SCHEMA = StructType([StructField("device_id", StringType()), StructField("age", StringType()),
                             StructField("gender", StringType())])


def read_content_map(spark: SparkSession, path: str) -> DataFrame:
    """Content map CSV with a header: ``title, length`` (``M:SS``) as text. Columns are
    taken by name, whatever their order or case; further columns are left out."""
    return _named(spark.read.csv(path, header=True), CONTENT_SCHEMA)


def _named(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` by name (case-insensitive), as text."""
    found = {c.strip().lower(): c for c in df.columns}
    missing = [f.name for f in schema if f.name not in found]
    if missing:
        raise ValueError(f"missing columns {missing}; the file has {df.columns}")
    return df.select(*[F.col(f"`{found[f.name]}`").cast("string").alias(f.name) for f in schema])


def read_content_map_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Content map stored as Parquet; column names matched case-insensitively."""
    return _named(spark.read.parquet(path), CONTENT_SCHEMA)


def with_length_seconds(content: DataFrame, strict: bool = False, name: str = "length_seconds") -> DataFrame:
    """Adds the item length in seconds parsed from ``length``."""
    return content.withColumn(name, length_seconds("length", strict=strict))


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    """Profile CSV with a header: ``device_id, age, gender``, all text (no inference),
    taken by name. A UTF-8 byte-order mark before the first name is dropped by the reader."""
    return _named(spark.read.csv(path, header=True), PROFILE_SCHEMA)


USAGE_INPUT_SCHEMA = StructType([
    StructField("_index", LongType()), StructField("device", IntegerType()),
    StructField("content", IntegerType()), StructField("period", StringType()),
])


def read_usage_input(spark: SparkSession, path: str,
                     names: Sequence[str] = ("Device ID", "Content ID", "Time Period")) -> DataFrame:
    """Usage-input CSV (leading index column, then device, content, period) read
    with an explicit schema; the columns are renamed by position."""
    df = spark.read.csv(path, header=True, schema=USAGE_INPUT_SCHEMA)
    return df.drop("_index").toDF(*names)


#: Column that holds a line's text where the line cannot be read.
RAW = "_raw_line"
#: Inputs whose lines can be checked: their typed columns, found by name (usage: by position).
CSV_INPUTS = {"content": CONTENT_SCHEMA, "profile": PROFILE_SCHEMA, "usage": USAGE_INPUT_SCHEMA}


def read_checked_csv(spark: SparkSession, path: str, source: str) -> DataFrame:
    """The columns of the input ``source`` (``content``, ``profile`` or ``usage``), the line's text in
    ``RAW`` where it has too many or too few fields or a value that is not of its column's type (else null),
    and ``file``, the file the line comes from. One pass gives readable rows and unreadable lines."""
    schema = CSV_INPUTS[source]
    names = spark.read.csv(path, header=True).columns
    if source == "usage":
        if len(names) != len(schema):
            raise ValueError(f"expected {len(schema)} columns; the file has {names}")
        columns = dict(zip(names, schema.fields))
    else:
        known = {f.name: f for f in schema}
        columns = {n: known.get(n.strip().lower()) for n in names}
        missing = set(known) - {f.name for f in columns.values() if f}
        if missing:
            raise ValueError(f"missing columns {sorted(missing)}; the file has {names}")
    own = StructType([StructField(f"c{i}", f.dataType if f else StringType()) for i, f in enumerate(columns.values())])
    df = (spark.read.schema(own.add(RAW, StringType())).option("header", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", RAW).csv(path))
    place = {f.name: f"c{i}" for i, f in enumerate(columns.values()) if f}
    # the line depends on all columns, so that no query of the lines alone leaves their values unread
    line = F.when(F.length(F.concat_ws("", *df.columns[:-1])) >= 0, F.col(RAW)).alias(RAW)
    return df.select(*[F.col(place[f.name]).alias(f.name) for f in schema], line, F.col("_metadata.file_path").alias("file"))


def readable(checked: DataFrame) -> DataFrame:
    """Rows of ``read_checked_csv`` whose whole line could be read."""
    return checked.where(F.col(RAW).isNull()).drop(RAW, "file")


def rows_to_frame(spark: SparkSession, rows: Iterable[Sequence], schema: StructType | str) -> DataFrame:
    """Literal rows → DataFrame with a declared schema (fixtures, small lookups)."""
    return spark.createDataFrame(list(rows), schema=schema)
