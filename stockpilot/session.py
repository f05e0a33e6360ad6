"""Session helpers: a local session for tests and benchmarks, and the shared
folder used for checkpoints and staged tables.

On a cluster the folder comes from ``spark.checkpoint.dir``, which must name
storage every executor and the driver can reach.  Only a local session may fall
back to a folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the plans built here.  AQE re-plans joins at run
# time: it turns a sort-merge join into a broadcast only when the measured
# shuffle output is under the adaptive threshold, coalesces small partitions
# and splits skewed ones.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def cluster_conf(largest_shuffle_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run whose largest shuffle moves
    ``largest_shuffle_bytes`` (for this job the projected order lines of the
    orders join, or the date-bounded forecast, whichever is larger).

    The initial shuffle partition count puts about ``partition_bytes`` in a
    partition, 200 partitions at least; AQE then coalesces small partitions and
    splits skewed ones.
    Pass these to ``SparkSession.builder.config`` or ``spark-submit --conf``;
    ``spark.checkpoint.dir`` must be set as well.
    """
    partitions = max(200, -(-largest_shuffle_bytes // partition_bytes))
    return {
        **PLAN_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "stockpilot") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("STOCKPILOT_DRIVER_MEMORY", "8g"))
    )
    for k, v in PLAN_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Reads ``spark.checkpoint.dir`` from the session.  When it is unset, a local
    session gets a fresh folder of its own; any other session is refused,
    because an executor-local folder does not survive the loss of that
    executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is unset: name a shared folder for checkpoints and staged tables")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="stockpilot-ckpt-"))
    return sc.getCheckpointDir()


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt by ``keys`` to all shuffle partitions.

    Adaptive execution leaves this number as it is, where it would put what is small
    when shuffled into few tasks.  For steps whose tasks need far more memory than the
    rows take when shuffled: rows about to be multiplied, joins followed by a grouping."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a path that ``scratch_path`` gave and that is no longer read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
