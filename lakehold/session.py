"""Spark session settings shared by jobs, tests and the bench.

On a cluster the session comes from the platform; ``configure`` only fills in what is
missing, so cluster-level settings (shuffle partitions, checkpoint dir) win.
"""
from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. Values that only make sense for one machine
# (driver memory, shuffle partitions) are passed by the caller instead.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # respect the advisory size when coalescing (no swarm of tiny tasks on a busy cluster)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # also where what follows uses the join's partitions: it shuffles then, but only then
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # runtime (measured) size under which AQE turns a shuffle join into a broadcast
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    # joins whose measured build side has no partition above this hash it and sort neither side; not below the advisory size
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "lakehold",
          extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.sql.warehouse.dir": os.path.join(tempfile.gettempdir(), "lakehold-warehouse"),
    })
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Fill in the base settings that can change at run time and that nobody has set."""
    for k, v in BASE_CONF.items():
        if spark.conf.isModifiable(k) and spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster sets it to shared storage. Only a local session, whose executors are this
    machine, may go without: it gets a folder of its own. On a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="lakehold-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


TARGET_PARTITION_BYTES = 128 * 1024 * 1024


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int):
    """Within the block, enough shuffle partitions for ``input_bytes`` of (compressed) input at about
    128 MB each; AQE coalesces small ones. Never below what is configured, which comes back after."""
    key = "spark.sql.shuffle.partitions"
    configured = spark.conf.get(key)
    # rows in a shuffle take a few times the room of their columnar files
    wanted = -(-4 * int(input_bytes) // TARGET_PARTITION_BYTES)
    if wanted > int(configured):
        spark.conf.set(key, str(wanted))
    try:
        yield
    finally:
        spark.conf.set(key, configured)
