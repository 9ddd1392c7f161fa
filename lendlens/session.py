"""Session helpers for tests, the bench and the driver entry point.

Library functions never create a session; they take DataFrames. These helpers
exist for local runs only.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app: str = "lendlens", driver_memory: str = "8g") -> SparkSession:
    """A local session configured like the tests expect (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names (``spark.checkpoint.dir``).

    Raises when none is configured: operators that cut lineage must write to
    storage every executor can reach, never to a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    raise RuntimeError(
        "No checkpoint folder: set spark.checkpoint.dir to shared storage "
        "(or call SparkContext.setCheckpointDir) before running this operator.")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the configured checkpoint folder; create a scratch one only for a
    local-mode session where none is set (tests, bench)."""
    try:
        return checkpoint_dir(spark)
    except RuntimeError:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lendlens-ckpt-"))
        return spark.sparkContext.getCheckpointDir()
