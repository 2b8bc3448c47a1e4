"""Session construction and shared-storage helpers.

Everything that has to survive the loss of an executor (checkpoints, landing
files, streaming state, lineage cuts) lives under the folder the cluster names in
``spark.checkpoint.dir``. A private folder is only created when that setting is
absent, which is the local/test case.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; all of them are overridable by the caller.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.parquet.filterPushdown": "true",
    # Bucketed tables are written with exactly one sorted file per bucket, so scans may
    # report that order and the sort-merge joins of the gold views need no Sort per read.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    # Reliable checkpoints (the global numbering's frozen sort) are removed once their
    # DataFrame is garbage-collected, so repeated runs do not pile files up in the shared folder.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "folio",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Local/test session builder; on a cluster the job's own session is used instead."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only if none is configured."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote (Connect) sessions have no SparkContext
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="folio-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc is None:
        return configured.rstrip("/")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh sub-folder of the shared checkpoint folder (never machine-local on a cluster)."""
    root = ensure_checkpoint_dir(spark)
    if root.startswith("file:"):
        root = root[len("file:"):]
    pieces = [root, "folio", *parts]
    if unique:
        pieces.append(uuid.uuid4().hex[:12])
    return os.path.join(*pieces) if "://" not in root else "/".join(pieces)


MAX_SHUFFLE_PARTITIONS = 32768


def recommended_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Starting configuration for a run over ``input_bytes`` of parquet on ``total_cores``.

    * Scan splits of ``target_partition_bytes`` keep every task's input in memory budget.
    * The initial shuffle partition count is sized for the larger shuffles (the ratings
      summary and the catalogue joins) at about the same bytes per partition, and never
      below three waves of cores; AQE then coalesces small partitions and splits skewed
      ones at run time, so this is an upper bound rather than a guess to get exactly right.
      It is capped, because map-output bookkeeping grows with maps x reducers, and after
      the per-key pre-aggregation the shuffles are far smaller than the input.
    * Automatic broadcast stays at Spark's measured-size threshold.
    """
    shuffle = max(3 * total_cores, min(MAX_SHUFFLE_PARTITIONS, int(input_bytes // target_partition_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.sources.bucketing.enabled": "true",
        "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    }
