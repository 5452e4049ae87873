"""Spark session and shared-folder helpers."""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session clock (the reference used the
# local wall clock, we pin UTC), AQE for runtime re-planning (partition
# coalescing, skew-join splitting) and no web UI.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster (about 100 TB of input, ~1000 executors).
# Explicit-count exchanges are avoided, so AQE sizes every shuffle: it starts
# from ``initialPartitionNum`` partitions (~1 GB each, sorted with spill, if a
# full 100 TB were shuffled) and coalesces to the advisory size; scans split at
# 512 MB; a partition 5x the median and over 1 GB is split by the skew join.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "100000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def get_session(master: str | None = None, app: str = "marketframe",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's default settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables: the setting
    ``spark.checkpoint.dir``, or else the folder set on the context. There is no
    default, as a folder of one machine would be lost to the others: a session with
    neither, on whatever master, is an error (entry points and tests name one)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and hasattr(spark, "_jsc"):  # Spark Connect has no context to ask
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        raise RuntimeError("spark.checkpoint.dir is unset: it must name a folder that the driver and all "
                           "executors share (stages and stream checkpoints are written there)")
    return d


# Folders written by ``materialize`` inside the innermost ``staging`` block of this thread (a
# stream's batch function runs in a thread of its own, beside a job's).
_OWNED: ContextVar[list[str] | None] = ContextVar("mf_owned", default=None)


@contextmanager
def staging(spark: SparkSession):
    """Owner of the intermediate tables written inside the block: they are
    deleted when it ends, so results must be written to tables of their own."""
    mine: list[str] = []
    token = _OWNED.set(mine)
    try:
        yield
    finally:
        _OWNED.reset(token)
        for path in mine:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df, name: str = "stage"):
    """Write ``df`` as Parquet to a fresh folder under the shared checkpoint
    directory and return a DataFrame over it.

    Cuts lineage at a stage boundary: later plans start from a small scan
    (with exact size statistics for AQE) instead of re-deriving the stage,
    and a lost executor re-reads the written files instead of recomputing.
    Inside a ``staging`` block the folder goes when the block ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if (owned := _OWNED.get()) is not None:
        owned.append(path)
    df.write.parquet(path)
    return spark.read.parquet(path)


def vacuum_stages(spark: SparkSession, older_than_seconds: float = 7 * 86_400) -> int:
    """Deletes the intermediate tables below the checkpoint folder that ``materialize`` wrote longer
    ago than that (those of queries have no owner that would). Returns how many went."""
    where = spark._jvm.org.apache.hadoop.fs.Path(checkpoint_dir(spark))
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    now = spark.sql("SELECT unix_millis(current_timestamp())").first()[0]
    gone = 0
    for f in fs.listStatus(where) if fs.exists(where) else []:
        if (f.isDirectory() and re.search(r"-[0-9a-f]{32}$", f.getPath().getName())
                and f.getModificationTime() <= now - 1000 * older_than_seconds):
            gone += fs.delete(f.getPath(), True)
    return gone
