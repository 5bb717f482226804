from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from playlens.session import build_session

    s = build_session(app="playlens-tests", master="local[*]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all columns by default)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def log_frame(spark, records):
    """Device log from (device_id, event, payload, time) tuples."""
    return spark.createDataFrame(records, "device_id STRING, event STRING, payload STRING, time STRING")


def local_path(p: str) -> str:
    """Filesystem path of a ``file:`` URI (local test runs only)."""
    return p[len("file:"):] if p.startswith("file:") else p
