"""SparkSession settings the operators rely on.

* session time zone pinned to UTC: naive timestamps are wall-clock values and
  every string → timestamp conversion must not depend on the host zone;
* ANSI mode on, so bad casts fail loudly unless an operator asks for ``try_*``;
* AQE with partition coalescing and skew-join splitting, so hot keys found at
  run time are split instead of landing in one task;
* dynamic partition overwrite, so an upsert rewrites only the partitions it
  touches;
* PySpark's per-call origin capture off (``dataFrameDebugging``): it costs
  several JVM round trips for every Column function while a plan is being
  built, and only adds the Python call site to error messages.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    master: str = "local[8]",
    app_name: str = "ampere",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and the bench; on a cluster pass ``master=None``
    and let spark-submit provide the master and executor sizing."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(CORE_CONF)
    conf.update(
        {
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("AMPERE_DRIVER_MEMORY", "8g"),
        }
    )
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_core_conf(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of ``CORE_CONF`` to an existing session."""
    for k, v in CORE_CONF.items():
        # a static setting of a running session stays as it is
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)


MB = 1024 * 1024


def cluster_conf(
    input_bytes: int, target_partition_bytes: int = 256 * MB, least: int = 200, most: int = 200_000
) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of input.

    Scan splits and post-shuffle partitions target ~256 MB, which fits
    executor memory without spill on typical 4–8 GB-per-core executors. The
    initial shuffle partition count follows the input size (AQE coalesces
    small ones down and splits skewed ones); a partition is "skewed" above
    2× the target. Broadcasts are capped at 64 MB. The number of initial
    partitions stays between ``least`` and ``most``, which bounds what the
    driver keeps per map task: 100 TB would take ~400,000 and get 200,000,
    of 512 MB each, unless ``most`` is raised.
    """
    parts = max(least, min(most, input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MB),
    }


def apply_cluster_conf(spark: SparkSession, input_bytes: int, **sizing: int) -> None:
    apply_core_conf(spark)
    for k, v in cluster_conf(input_bytes, **sizing).items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only where it is unset in a local session do we create one of our own; on
    a cluster executors could not read it, so there its absence is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="ampere-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current
