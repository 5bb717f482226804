"""Stages of a job that a later run takes over instead of computing them again.

A stage's rows are written as Parquet; then, as the last step, a marker is written beside them
with two fingerprints:

* of what the stage was made from: its name, the configuration values it uses, the files of its
  inputs (path, length, time of change) and the fingerprint of the stage it follows;
* of the files it left behind.

A later run reads the marker first. Where both fingerprints are as they would be now, the stage's
files are read and nothing of what leads to it is planned, so the log is not even
listed by a scan. A changed input or setting, a stage that was stopped while writing (no
marker: it is taken away before the first file is written) and files changed by hand
make the stage and those after it run again. Settings that only later stages use leave a stage valid.

File lists are read by Spark (names and sizes only, no contents), so any file system will do.
"""

from __future__ import annotations

import hashlib
import json
import os
from typing import Any, Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playlens.operators.accounting import DropCounts
from playlens.sources.sinks import write_parquet, write_single_parquet

#: Part of every fingerprint; to be raised when a stage's rows come out differently.
VERSION = 1
MARKERS, DROPPED = "_stages", "_dropped"


def _digest(value: Any) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()


def files_fingerprint(spark: SparkSession, *paths: str, times: bool = True) -> str:
    """Number, lengths and names of all files below the paths, and when they were changed."""
    cols = ["path", "length", *(["modificationTime"] if times else [])]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths)).select(*cols)
    r = files.agg(F.count("*").alias("n"), F.sum("length").alias("bytes"), F.bit_xor(F.xxhash64(*cols)).alias("h")).first()
    return _digest([r["n"], r["bytes"], r["h"]])


class Stages:
    """Stages of one job below ``out``. ``inputs`` names the files each input comes from; without
    it (inputs given as DataFrames of unknown origin) every stage runs, and none is taken over.
    ``kind`` keeps the equally named stages of different jobs apart."""

    def __init__(self, spark: SparkSession, out: str, inputs: Mapping[str, str] | None = None,
                 fresh: bool = False, kind: str = ""):
        self.spark, self.out, self.fresh, self.kind = spark, out, fresh, kind
        self.inputs = None if inputs is None else dict(inputs)
        #: What became of each stage of this run: ``computed`` or ``taken over``.
        self.history: dict[str, str] = {}
        self._known: dict[str, str] = {}
        self._made_from: dict[str, str] = {}

    def _input(self, name: str) -> str:
        if name not in self._known:
            self._known[name] = files_fingerprint(self.spark, self.inputs[name])
        return self._known[name]

    def made_from(self, name: str, settings: Mapping[str, Any], inputs: tuple[str, ...], after: str | None) -> str | None:
        if self.inputs is None:
            return None
        before = None if after is None else self._made_from[after]
        return _digest([VERSION, self.kind, name, dict(settings), {i: self._input(i) for i in inputs}, before])

    def _marker(self, name: str) -> dict | None:
        try:
            found = self.spark.read.text(os.path.join(self.out, MARKERS, name)).collect()  # one line
        except AnalysisException:  # no marker
            return None
        return json.loads(found[0]["value"]) if len(found) == 1 else None

    def _mark(self, name: str, marker: dict | None) -> None:
        path = os.path.join(self.out, MARKERS, name)
        lines = [] if marker is None else [(json.dumps(marker),)]
        self.spark.createDataFrame(lines, "value STRING").coalesce(1).write.mode("overwrite").text(path)

    def run(self, name: str, build: Callable[[], DataFrame], settings: Mapping[str, Any] | None = None,
            inputs: tuple[str, ...] = (), after: str | None = None, single: bool = False,
            drops: DropCounts | None = None) -> DataFrame:
        """Rows of the stage, read from its files: those of an earlier run where they are
        still right, else from ``build()``, which is only called then. ``after`` is the stage it
        reads; ``single`` writes one file (for rows of bounded number). The rows that ``drops`` counts
        while the stage is written are listed below ``_dropped``."""
        path = os.path.join(self.out, name)
        made_from = self._made_from[name] = self.made_from(name, settings or {}, inputs, after)
        marker = None if made_from is None or self.fresh else self._marker(name)
        if marker and marker["made_from"] == made_from:
            try:
                if marker["files"] == files_fingerprint(self.spark, path):
                    self.history[name] = "taken over"
                    return self._read(path, marker["schema"])
            except AnalysisException:  # the folder is gone
                pass
        if made_from is not None:
            self._mark(name, None)
        df = build()
        (write_single_parquet if single else write_parquet)(df, path)
        self.history[name] = "computed"
        if drops is not None:
            lines = [(step, reason, n) for step, counts in drops.counts().items() for reason, n in counts.items()]
            write_single_parquet(self.spark.createDataFrame(lines, "step STRING, reason STRING, n LONG"),
                                 os.path.join(self.out, DROPPED, name))
        if made_from is not None:
            self._mark(name, {"made_from": made_from, "schema": df.schema.json(), "files": files_fingerprint(self.spark, path)})
        return self._read(path, df.schema.json())

    def _read(self, path: str, schema: str) -> DataFrame:
        return self.spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(path)
