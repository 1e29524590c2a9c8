"""Session settings and the shared folder for stored intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Partition counts and sizes are left to adaptive execution and to the cluster's own defaults.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.filterPushdown": "true",
    # Call sites per column operator cost milliseconds each when a plan is built in Python.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def session(app: str = "souklake", **extra: str) -> SparkSession:
    """Session for a cluster: the master and the sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(app: str, cores: str = "8", memory: str = "8g") -> SparkSession:
    """Session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.ui.enabled", "false")
        # Test files have one row group each, so the cores are only busy behind a shuffle.
        .config("spark.sql.adaptive.localShuffleReader.enabled", "false")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, as the cluster names it.

    Only a local session without one gets a folder of this machine.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="souklake-")
    spark.conf.set(CHECKPOINT_DIR, made)
    return made


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
