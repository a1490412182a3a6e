"""Session construction and the shared scratch location.

Batch jobs never depend on session settings for their results (all batch
timestamps stay TIMESTAMP_NTZ), but the streaming layer needs a UTC session
time zone for ``withWatermark``. Scratch output (checkpoints, version logs
written by queries) goes below ``spark.checkpoint.dir``, which a cluster
points at shared storage.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.compression.codec": "snappy",
    # checkpoint files of intermediates that are no longer referenced are
    # removed by the context cleaner (materialised intermediates, positional
    # index tags), so the shared checkpoint folder does not grow per run
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Settings for a large cluster (100 TB class inputs). Start shuffles wide and
# let AQE coalesce them to ~256 MB partitions; read ~512 MB file splits; keep
# skew-join splitting on; keep large streaming state in RocksDB.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", app: str = "clickflow",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local or cluster session with the settings the library is tuned for."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint root; set a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only when nothing is configured on a local master (tests) a folder under
    the system temp directory is created; any other master raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="clickflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return os.path.join(root.rstrip("/"), "clickflow", f"{name}-{uuid.uuid4().hex[:12]}")
