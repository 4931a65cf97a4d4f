"""Session construction and the shared folder used to cut lineage.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names. Only in
local mode, where all tasks share one machine, is a private temporary folder used when
it is unset; on any other master that is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults that hold from local[8] up to a large cluster. Shuffle partitions are a
# starting point only: AQE coalesces small ones and splits skewed ones at runtime.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Remove reliable-checkpoint files once nothing references them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "wayfare",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the SparkContext.

    Reads ``spark.checkpoint.dir`` from the session. Sets a private folder only when
    nothing is configured and the master is local (tests, ad-hoc runs): executors on
    other machines could not read a folder of the driver's.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="wayfare-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root for written tables."""
    root = checkpoint_root(spark)
    return os.path.join(root, "wayfare", f"{name}-{uuid.uuid4().hex}")


def scale_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Session settings sized for an input of ``input_bytes`` on ``cores`` cores.

    Scan splits are ``target_partition_bytes`` each. Shuffle partitions start at one
    per target size of input, but between 2 and 4 per core: every stage here shuffles
    aggregated data far smaller than its input, and map-output metadata grows with
    maps x reducers, so a count proportional to raw input would be wasteful at 100 TB.
    AQE then merges partitions that turn out small and splits skewed ones (5x the
    median and above 1 GB). Broadcasts stay explicit and size-checked (see
    ``operators.joins``), so the automatic threshold keeps its small default.

    sf0.1 on 8 cores: 16 partitions. 100 TB on 8 000 cores: 32 000 partitions."""
    by_size = -(-input_bytes // target_partition_bytes)
    partitions = max(2 * cores, min(4 * cores, by_size))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * 1024 * 1024),
    }
