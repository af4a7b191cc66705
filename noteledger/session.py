"""Spark session helpers.

The library never creates a session behind the caller's back; these helpers
are for scripts, tests and the benchmark.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces small
# shuffle partitions at run time, and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files are removed once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(
    master: str | None = None,
    app_name: str = "noteledger",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only if unset.

    On a cluster the setting names a shared folder that survives executor
    loss, and its absence is an error. In local mode, where driver and tasks
    are one process, a fresh temporary folder serves. The context's folder is
    set once: every further call would open a new one.
    """
    context = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="noteledger-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(current)
    return current


def materialize(df):
    """Write ``df`` to the checkpoint folder and read it back (eager).

    Used where one plan would otherwise recompute the same joins several
    times (a role read by several branches, a fitted dictionary); it also
    cuts the lineage, so a lost executor does not replay the joins.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df):
    """``df`` written as a Parquet table below the checkpoint folder and read back: compressed, and read by columns."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cluster_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Shuffle and scan sizing for a given input size and core count.

    The initial shuffle partition count is high enough that each partition
    holds about ``target_partition_bytes`` of input (and at least 2 waves of
    tasks); AQE then coalesces small partitions and splits skewed ones, so
    the number only needs the right order of magnitude.
    """
    by_size = -(-int(input_bytes) // target_partition_bytes)
    partitions = max(2 * cores, by_size)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }
