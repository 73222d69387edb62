"""Session construction and the shared scratch location.

Everything this package writes (sink tables, stream checkpoints, staged
stream input) goes below the folder named by ``spark.checkpoint.dir``, which
on a cluster is a shared file system that survives executor loss.  A local
folder is only made up when the setting is absent *and* the master is local
(tests, laptops); on a cluster an absent setting is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "quarry", extra: dict | None = None) -> SparkSession:
    """A session tuned for this package: AQE on, UTC, Arrow, UI off."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or cpus),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.driver.memory": os.environ.get("QUARRY_DRIVER_MEMORY", "16g"),
        # many short queries per session: keep little status history on the driver
        "spark.sql.ui.retainedExecutions": "50",
        "spark.ui.retainedJobs": "100",
        "spark.ui.retainedStages": "100",
        "spark.sql.streaming.ui.retainedQueries": "10",
    }
    conf.update(extra or {})
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for everything this package writes.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir);
    only when both are unset on a local master is a temp folder created and
    installed as the checkpoint dir.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:      # Spark Connect: only the conf is visible
            root = None
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/...) that all executors and the driver can reach")
    root = tempfile.mkdtemp(prefix="quarry-ckpt-")
    spark.sparkContext.setCheckpointDir(root)
    spark.conf.set("spark.checkpoint.dir", root)   # so later calls find it
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, never reused path under the shared scratch root."""
    return "/".join([scratch_root(spark), "quarry", *parts, uuid.uuid4().hex])


def cluster_conf(input_bytes: int, total_cores: int,
                 shuffle_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large cluster, sized from the input volume.

    Not applied to local sessions; pass them to ``spark-submit --conf`` or a
    builder.  Shuffle partitions start at about one per 256 MB of input
    (bounded by 2x cores below and 200k above) and AQE coalesces the small
    ones at run time; scan splits are 256 MB; skewed join partitions are
    split; the broadcast threshold stays modest because a broadcast is
    copied to every executor; stream state lives in RocksDB with changelog
    checkpoints; the skew budget of ``ordered_scan`` is set per group.
    """
    partitions = max(2 * total_cores, min(200_000, input_bytes // shuffle_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * shuffle_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(shuffle_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
        "spark.quarry.skew.maxGroupRows": "4000000",
        # long-lived drivers running many short queries and micro-batches
        "spark.sql.ui.retainedExecutions": "200",
        "spark.sql.streaming.ui.retainedQueries": "20",
    }
