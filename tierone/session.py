"""Session construction and the shared working folder.

Jobs that materialise intermediate tables (silver before gold, write-then-read
checks, the run ledger) write under the folder the cluster names in
``spark.checkpoint.dir`` — a shared, fault-tolerant filesystem on a real
cluster. Only when the session has none (local runs, tests) do we create one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans joins from runtime sizes,
# splits skewed join partitions and coalesces small shuffle partitions.
SESSION_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Remove reliable-checkpoint files once their DataFrame is gone, so the
    # shared folder does not fill with spent checkpoints.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "tierone",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; set one only if the session has none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        # Local / test sessions only: a cluster names a shared folder itself.
        configured = tempfile.mkdtemp(prefix="tierone-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared folder."""
    return f"{shared_dir(spark)}/tierone/{name}-{uuid.uuid4().hex}"


MIB = 1024 * 1024


def scale_settings(shuffle_bytes: int, total_cores: int,
                   partition_bytes: int = 128 * MIB) -> dict[str, str]:
    """Shuffle and scan sizing for a run expected to shuffle ``shuffle_bytes``.

    Starts with enough shuffle partitions that each holds about
    ``partition_bytes`` (and at least two waves over every core), so a task's
    hash table and sort buffer fit in executor memory without heavy spill;
    AQE coalesces partitions that turn out small and splits skewed ones
    (a partition is "skewed" past four times the target size).
    """
    parts = max(2 * total_cores, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }
