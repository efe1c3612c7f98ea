"""Session helpers.

The library never creates a session on its own; queries receive one.  ``build_session``
is for tests, the bench and local runs.  ``ensure_checkpoint_dir`` reads the
cluster's ``spark.checkpoint.dir`` and only falls back to a fresh local folder when the
setting is absent *and* the master is local (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "quarry", extra: dict | None = None) -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only where none is configured.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder (HDFS/S3/ABFS);
    a machine-local fallback is used only for a local master.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-{tag}-{uuid.uuid4().hex}"


def scale_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20,
               broadcast_bytes: int = 64 << 20) -> dict[str, str]:
    """Session settings sized for a given input volume and cluster (pass to
    ``build_session(extra=...)`` or the cluster's defaults).

    Scan splits and shuffle partitions target ``partition_bytes`` each (so a task's
    share fits executor memory with room for sorts and hash tables); the shuffle
    partition count is at least twice the cores and a multiple of them, AQE starts from
    it and coalesces what turns out small, and splits skewed partitions in joins.
    Example: 100 TB (10^14 bytes) on 8,000 cores -> 376,000 partitions of at most 256 MB.
    """
    import math
    parts = max(2 * total_cores, math.ceil(input_bytes / partition_bytes))
    parts = math.ceil(parts / total_cores) * total_cores
    mb = f"{partition_bytes >> 20}m"
    return {
        "spark.sql.files.maxPartitionBytes": mb,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": mb,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": mb,
        "spark.sql.autoBroadcastJoinThreshold": f"{broadcast_bytes >> 20}m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": f"{broadcast_bytes >> 20}m",
    }
