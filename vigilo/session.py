"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session tuned like the tests expect (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("vigilo")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("VIGILO_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster the folder is set by the deployment on a shared file system and
    is only read here. Only when nothing is set — local tests — a scratch folder
    is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS/S3/...) for the cluster")
        configured = tempfile.mkdtemp(prefix="vigilo-ckpt-")  # local mode only (tests)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def pin(df):
    """Reliable checkpoint of ``df`` computed once.

    ``checkpoint()`` writes with a second job that recomputes its input
    unless it is cached, so the input is persisted first, written to the
    shared checkpoint folder, and the cache released: the returned frame
    reads the checkpoint files (short lineage, survives executor loss). A
    frame its caller has cached stays cached.
    """
    ensure_checkpoint_dir(df.sparkSession)
    if df.is_cached or df.storageLevel.useMemory or df.storageLevel.useDisk:
        return df.checkpoint(eager=True)
    cached = df.persist()
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()


def cluster_conf(input_bytes: int, executor_cores: int, executors: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings to start from on a cluster, sized from the input volume.

    Shuffle partitions are sized so a post-shuffle partition is about
    ``target_partition_bytes`` (AQE then coalesces small ones and splits
    skewed ones); scans read ``target_partition_bytes`` splits. The
    checkpoint folder is NOT set here: it must come from the deployment
    (a shared file system), see :func:`ensure_checkpoint_dir`.
    """
    slots = max(1, executor_cores * executors)
    partitions = max(slots * 2, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(int(partitions)),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.parquet.aggregatePushdown": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.session.timeZone": "UTC",
    }
