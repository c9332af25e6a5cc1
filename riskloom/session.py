"""Session defaults and the shared folder in which fitted tables are kept."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(app: str = "riskloom", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names in `spark.checkpoint.dir`.

    Only a local master may fall back to a temporary folder, since there driver and executors share a disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="riskloom-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir() or made
