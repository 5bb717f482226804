"""Session set-up and the shared folder used for checkpoints and hand-over files."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on. AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions. The
# runtime broadcast threshold stays at its conservative default: tables that
# grow with the data (profile, per-chunk minima) are broadcast only when small.
#
# What one task holds must not grow with the tables. A task sorts and hashes about 25 times
# the compressed bytes it reads, so shuffle partitions and scan splits are kept at 16 MB and
# more data gives more tasks. A shuffle is dealt into FIRST_PARTITIONS partitions or more, whose small
# neighbours are then read as one: with fewer (200 by default) each would pass 16 MB beyond
# 3.2 GB in a shuffle and grow on with the tables. A partitioned write keeps a file open for each of a few
# partitions instead of sorting the task's whole output first.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    "spark.sql.files.maxPartitionBytes": "16MB",
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}
#: Partitions a shuffle is dealt into at least (16 GB at 16 MB each); a session's larger number counts.
FIRST_PARTITIONS = 1000
_FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(app: str = "playlens", master: str | None = None,
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        conf["spark.ui.enabled"] = "false"
        conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf[_FIRST] = str(max(FIRST_PARTITIONS, shuffle_partitions or 0))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the runtime SQL settings of DEFAULT_CONF on an existing session, and the partitions of a shuffle."""
    for k, v in DEFAULT_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    own = (spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get(_FIRST, None) or 0)
    spark.conf.set(_FIRST, str(max(FIRST_PARTITIONS, *map(int, own))))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must name a folder every executor can reach; it is
    used as is, and a cluster session without it is an error. Only a local session
    without it gets a fresh folder, which is removed when the process ends.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="playlens-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
