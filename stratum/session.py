"""Session helpers: a local session for tests/bench and checkpoint-dir policy."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "stratum") -> SparkSession:
    """A local session configured like the test/bench environment."""
    parts = shuffle_partitions or (int(cores) if str(cores).isdigit() else 8)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("STRATUM_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting one only for local masters.

    On a cluster the directory must be a shared folder named by the
    deployment in ``spark.checkpoint.dir``; a machine-local temporary folder
    would lose checkpoints with the executor, so it is refused there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master != "local" and not sc.master.startswith("local["):   # local-cluster has executors
        raise RuntimeError(
            "spark.checkpoint.dir is unset: point it at a shared folder "
            "(HDFS/S3/ABFS) before running fixpoint operators on a cluster")
    path = tempfile.mkdtemp(prefix="stratum-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
