"""Session helpers.

The library never creates its own session inside an operator; these helpers
are for scripts, tests and the benchmark.  Shared storage for lineage cuts
and streaming checkpoints comes from ``spark.checkpoint.dir`` of the running
session; only a local session (tests) may do without it.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Catalyst only broadcasts a join side whose estimated size is below this
    # bound; above it the join stays a shuffle join (AQE may still demote it
    # at run time using the real shuffle statistics).
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of unreachable DataFrames are removed by the cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8,
              app_name: str = "cartwheel", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    return spark


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024 * 1024,
               max_split_bytes: int = 256 * 1024 * 1024) -> dict:
    """Partition sizing for a run over ``input_bytes`` of event data.

    * scan splits of at most ``max_split_bytes`` (``spark.sql.files.maxPartitionBytes``);
    * shuffle partitions so one partition carries about
      ``target_partition_bytes`` of the largest shuffle (the cart/purchase
      subset and per-key tables are far smaller than the input, so sizing
      from the whole input is conservative), at least 2 × cores so every
      core has work, rounded up to a multiple of the core count;
    * AQE coalesces small partitions and splits skewed ones at run time.

    For 100 TB on 1 000 executors × 8 cores this gives 416 000 partitions of
    ~250 MB each; for the local test data it falls back to 2 × cores."""
    by_size = -(-input_bytes // target_partition_bytes)
    n = max(2 * total_cores, by_size)
    n = -(-n // total_cores) * total_cores
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(max_split_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(min(target_partition_bytes, 64 * 1024 * 1024)),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared file system (HDFS/S3/ABFS...); a
    cluster session without it is an error, because files in one machine's
    temporary folder are invisible to the others.  A local session (tests)
    has only one machine and gets a fresh folder, remembered as the
    SparkContext's checkpoint folder.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cartwheel-ckpt-"))
        d = sc.getCheckpointDir()
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/cartwheel/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path's scheme."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


__all__ = ["get_spark", "scale_conf", "checkpoint_root", "scratch_path", "path_exists"]
