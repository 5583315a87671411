"""Session construction and the shared scratch folder.

Library code never picks a machine-local folder on a cluster: lineage is cut by
writing to ``spark.checkpoint.dir``, which the cluster names.  Only a local-mode
session without that setting (tests, bench) gets a fresh temporary folder; a
cluster without it is an error.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins from runtime sizes, splits
# skewed join partitions and coalesces small ones.
#
# Broadcast policy: the static planner estimates a side from compressed file
# sizes scaled by the projected columns, which is unreliable (at sf0.1 it chose
# to broadcast the transactions fact, the largest table).  So static broadcast
# is off and only AQE broadcasts, from the *measured* size of a finished shuffle
# stage below ``adaptive.autoBroadcastJoinThreshold``.  Frames with a proven
# bound (the per-table control rows) carry an explicit ``broadcast`` hint.
SCALE_CONF: dict[str, str] = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Runtime Bloom filters: before a large fact (10 GB or more to scan) is shuffled to a side that is
    # too large to broadcast, rows whose key can't be there are dropped at the scan.  Sized for
    # 20 million keys (20 MB), of a side of up to 1 GB.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "10g",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "20000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "40000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "160000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "320000000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # jobs that a run submits at once share the executors
    "spark.scheduler.mode": "FAIR",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "fraudmart",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Set here only when unset and the session is local (tests); a cluster
    session without it is a configuration error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="fraudmart-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def file_system(spark: SparkSession, path: str) -> tuple:
    """(Hadoop file system, path object) of a path."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system; nothing happens if it isn't there."""
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def matching_paths(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, modification time in ms) of what a glob pattern matches in the shared file system."""
    fs, target = file_system(spark, pattern)
    return sorted((s.getPath().toString(), s.getModificationTime()) for s in fs.globStatus(target) or [])


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), *parts)
