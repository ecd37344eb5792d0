"""Session defaults and the shared scratch area used for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(cores: str = "*", app: str = "millrace", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    sc = spark.sparkContext
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="millrace-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage by a table written to the shared folder, so a lost executor does not lose the data.

    Unlike ``checkpoint()`` this runs the plan once, stores columns, gives the next plan real sizes to choose joins by,
    and does not carry the old plan's constraints along.
    """
    path = scratch_path(df.sparkSession, "round")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def task_slots(spark: SparkSession) -> int:
    """How many reduce tasks one shuffle is meant to have."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Costly row work on a table of few files: hash the rows over the task slots first.

    A table with at least as many files as slots is left alone, so a large table is never shuffled for this.
    """
    slots = task_slots(df.sparkSession)
    return df.repartition(slots, key) if len(df.inputFiles()) < slots else df
