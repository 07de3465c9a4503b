"""Session construction and the shared folder used to cut lineage.

On a cluster the session already exists and ``spark.checkpoint.dir`` names a shared
folder (HDFS / object store); we only read it. Tests and local runs have none, so
``shared_dir`` creates one under the system temp folder *only* when the setting is
unset.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Session settings the jobs rely on (reference: UTC session time zone, Snappy Parquet).
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app: str = "trilake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Get or create a session with the job settings applied.

    ``master``/``shuffle_partitions`` are for local runs; on a cluster leave them
    ``None`` so the submitter's settings win.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        b = b.config("spark.driver.memory", os.environ.get("TRILAKE_DRIVER_MEM", "6g"))
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("WARN")
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        pass
    apply_job_conf(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings on an existing session."""
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Path under the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session; sets a local one only when it is
    unset (tests, local mode).
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master or 'the cluster'} share")
        base = tempfile.mkdtemp(prefix="trilake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
        try:
            spark.sparkContext.setCheckpointDir(base)
        except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
            pass
    return "/".join([base.rstrip("/"), *parts]) if parts else base


def input_bytes(df) -> int:
    """Bytes that the planner expects a frame's scans to read: file sizes, no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def known_bytes(df) -> int:
    """``input_bytes``, or 0 where the planner knows no sizes (rows that come from no file)."""
    size = input_bytes(df)
    return size if size < 1 << 60 else 0


def size_shuffle_for(spark: SparkSession, *frames, target_bytes: int = 256 << 20) -> int:
    """``size_shuffle`` for jobs that shuffle about what they read. The session's own
    setting stays where it is larger, and small inputs leave it alone."""
    have = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = sum(input_bytes(f) for f in frames)
    return size_shuffle(spark, size, target_bytes) if size > have * target_bytes else have


def size_shuffle(spark: SparkSession, shuffle_bytes: int, target_bytes: int = 256 << 20,
                 max_split_bytes: int = 256 << 20) -> int:
    """Size shuffles for the data at hand.

    ``shuffle_bytes`` is the estimated size of the largest shuffle (after column
    pruning and partial aggregation, usually far below the input size). Sets
    ``spark.sql.shuffle.partitions`` so each reducer starts near ``target_bytes``, with
    AQE coalescing small partitions and splitting skewed ones at runtime; scan splits
    are at most ``max_split_bytes``. Never below the core count. Returns the count."""
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        cores = int(spark.conf.get("spark.default.parallelism", "8"))
    parts = max(cores, -(-int(shuffle_bytes) // int(target_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(int(target_bytes)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(int(max_split_bytes)))
    return parts
