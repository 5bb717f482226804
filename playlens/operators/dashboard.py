"""Dashboard data: roll-ups, grouping sets, parameterised selects, chart series.

The dashboard table is ``time_period INT, age INT, gender STRING, type STRING,
count BIGINT``; ``to_dashboard`` derives it from the cohort segment counts.
"""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.sources.sinks import register_views


def to_dashboard(segments: DataFrame) -> DataFrame:
    """Cohort segment counts → dashboard table (bucket → time_period, activity_type → type)."""
    return segments.select(F.col("bucket").cast("int").alias("time_period"),
                           F.col("age").try_cast("int").alias("age"),
                           F.col("gender"), F.col("activity_type").alias("type"),
                           F.col("count").cast("bigint").alias("count"))


def segment_rollup(dash: DataFrame, by: Sequence[str] = ("gender",)) -> DataFrame:
    """``sum(count)`` per (*by, time_period, type)."""
    return dash.groupBy(*by, "time_period", "type").agg(F.sum("count").alias("count"))


def dashboard_views(spark: SparkSession, dash: DataFrame) -> None:
    """Register ``full`` (the table), ``gender`` and ``age`` (its roll-ups)."""
    register_views(spark, {"full": dash, "gender": segment_rollup(dash, ("gender",)),
                           "age": segment_rollup(dash, ("age",))})


# fixed values: the parameterised selects of the dashboard and their defaults
VIEW_QUERIES = {
    "age": "SELECT * FROM age WHERE age = :age",
    "gender": "SELECT * FROM gender WHERE gender = :gender",
    "full": "SELECT * FROM full WHERE age = :age AND gender = :gender",
}
VIEW_DEFAULTS = {"age": 1, "gender": "M"}


def select_view(spark: SparkSession, view: str, **params) -> DataFrame:
    """Run a dashboard select with bound parameters (never spliced into the text)."""
    sql = VIEW_QUERIES[view]
    args = {k: params.get(k, v) for k, v in VIEW_DEFAULTS.items() if f":{k}" in sql}
    return spark.sql(sql, args=args)


# fixed values: parameters of the dashboard's selects with their defaults
FUNCTIONS = {"age": "age INT DEFAULT 1", "gender": "gender STRING DEFAULT 'M'",
             "full": "age INT DEFAULT 1, gender STRING DEFAULT 'M'"}


def dashboard_functions(spark: SparkSession, dash: DataFrame, prefix: str = "dashboard") -> None:
    """The dashboard's selects as SQL table functions ``<prefix>_full(age, gender)``, ``<prefix>_age(age)``
    and ``<prefix>_gender(gender)`` of the session, over the one view ``<prefix>_rows``. A user's own
    views and tables called ``full``, ``age`` or ``gender`` are left alone; parameters have defaults
    and may be given by name."""
    if not re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", prefix):
        raise ValueError(f"not a name: {prefix!r}")
    rows = f"{prefix}_rows"
    register_views(spark, {rows: dash})
    keys = {"age": ["age"], "gender": ["gender"], "full": []}
    for name, params in FUNCTIONS.items():
        own = f"{prefix}_{name}"
        by = [*keys[name], "time_period", "type"]
        body = (f"SELECT {', '.join(by)}, sum(count) AS count FROM {rows} GROUP BY {', '.join(by)}" if keys[name]
                else f"SELECT * FROM {rows}")
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spark.sql(body).schema)
        where = " AND ".join(f"r.{p.split()[0]} = {own}.{p.split()[0]}" for p in params.split(", "))
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {own}({params}) RETURNS TABLE({columns}) "
                  f"RETURN SELECT * FROM ({body}) r WHERE {where}")


def select_function(spark: SparkSession, name: str, prefix: str = "dashboard", **params) -> DataFrame:
    """Rows of a dashboard function; parameters are bound (never spliced into the text)."""
    known = {p.split()[0] for p in FUNCTIONS[name].split(", ")}
    if not set(params) <= known:
        raise ValueError(f"{name} takes {sorted(known)}")
    return spark.sql(f"SELECT * FROM {prefix}_{name}({', '.join(f'{k} => :{k}' for k in params)})", args=params)


def segment_filter(dash: DataFrame, age: int | None = None, gender: str | None = None) -> DataFrame:
    """Rows of one age and/or gender (DataFrame form of ``select_view``)."""
    cond = F.lit(True)
    if age is not None:
        cond = cond & (F.col("age") == F.lit(age))
    if gender is not None:
        cond = cond & (F.col("gender") == F.lit(gender))
    return dash.where(cond)


_SEGMENTS = {"age": ("age",), "gender": ("gender",), "age and gender": ("age", "gender")}


def segmentations(dash: DataFrame, names: Sequence[str] = ("age", "gender", "age and gender"),
                  with_total: bool = True, total_label: str = "all") -> DataFrame:
    """All chosen segmentations in one aggregation (GROUPING SETS).

    Returns ``segmentation, age, gender, time_period, type, count``; columns
    outside a segmentation are null. ``with_total`` adds, per segmentation and
    period, a row summing all types, labelled ``total_label``.
    """
    sets = []
    for n in names:
        cols = _SEGMENTS[n]
        sets.append((*cols, "time_period", "type"))
        if with_total:
            sets.append((*cols, "time_period"))
    grouped = dash.groupingSets([[F.col(c) for c in s] for s in sets],
                                "age", "gender", "time_period", "type")
    agg = grouped.agg(F.sum("count").alias("count"),
                      F.grouping("age").alias("_ga"), F.grouping("gender").alias("_gg"),
                      F.grouping("type").alias("_gt"))
    seg = (F.when((F.col("_ga") == 0) & (F.col("_gg") == 0), "age and gender")
           .when(F.col("_ga") == 0, "age").otherwise("gender"))
    typ = F.when(F.col("_gt") == 1, F.lit(total_label)).otherwise(F.col("type"))
    return agg.select(seg.alias("segmentation"), "age", "gender", "time_period",
                      typ.alias("type"), "count")


def activity_chart(dash: DataFrame, types: Sequence[str], x: str = "time_period") -> DataFrame:
    """Chart series: one row per ``x``, one ``sum(count)`` column per type.
    The type list is given, so no extra job collects the distinct values."""
    return dash.groupBy(x).pivot("type", list(types)).agg(F.sum("count"))
