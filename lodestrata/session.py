"""Sessions, and cutting lineage in a way that survives lost executors."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "lodestrata", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and small runs; clusters bring their own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")  # small data still fills the cores
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, as the session names it.

    Only a local session without the setting gets a temporary folder; on a cluster its absence is an error, as a
    machine-local folder would be lost with the machine.
    """
    context = spark.sparkContext
    java = context._jsc.sc()
    if java.getCheckpointDir().isDefined():
        return java.getCheckpointDir().get()
    folder = context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lodestrata-")
    context.setCheckpointDir(folder)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, with its lineage cut there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
