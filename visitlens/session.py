"""SparkSession construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from measured sizes
# (runtime broadcast only below the threshold), splits skewed shuffle
# partitions of sort-merge joins and coalesces small ones.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Sets per session or product are collected by hash up to this many groups a task.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "10000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Streaming state off-heap with incremental checkpoints (trend query).
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def cluster_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20
                 ) -> dict[str, str]:
    """Sizing for a job reading ``input_bytes`` on ``cores`` executor cores.

    Shuffle partitions are set so each holds about ``target_partition_bytes``
    (at least two waves of the cores); AQE then coalesces small ones and
    splits skewed ones against the same advisory size. Scan splits use the
    same size, so a task's input fits comfortably in executor memory.
    """
    parts = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes":
            str(4 * target_partition_bytes),
    }


def get_spark(master: str | None = None, app_name: str = "visitlens",
              shuffle_partitions: int | None = None,
              extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or fetch) a session with the settings the library assumes.

    On a cluster leave ``master`` unset so spark-submit decides; size
    ``shuffle_partitions`` to the data (about 128-256 MB per partition
    after the map side), AQE coalesces from there.
    """
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
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _session_checkpoint_dir(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    value = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    return value or sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    The shared folder is ``spark.checkpoint.dir`` (or the context's
    checkpoint dir). Only when neither is set and the master is local
    (tests) a folder under the system temp directory is created and
    registered with ``setCheckpointDir`` (``spark.checkpoint.dir`` itself
    cannot change at runtime); on a cluster executors would not share such
    a folder, so there the call raises.
    """
    base = _session_checkpoint_dir(spark)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir is not set and {master} is not a local "
                             "master: set it to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="visitlens-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", "", 1), exist_ok=True)
    return path


def materialize(df, name: str, written: list[str] | None = None):
    """Write ``df`` as Parquet under the shared scratch folder and read it back.

    Used for intermediates read by several reports: later jobs start from
    the files (lineage cut, survives executor loss) instead of recomputing.
    The path is appended to ``written`` so the caller can drop it later.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    if written is not None:
        written.append(path)
    return spark.read.parquet(path)


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch folders (Hadoop FileSystem, so any shared storage)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
