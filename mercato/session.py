"""Session settings the engine needs, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings, so they can be applied to a session somebody else opened.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Written tables take about two thirds of what they do with the default.
    "spark.sql.parquet.compression.codec": "zstd",
    # Shuffle files go when the query that made them ends, not at some later garbage
    # collection of the driver.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(cores: str = "8", partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("mercato")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "12g")
    )
    for name, value in extra.items():
        builder = builder.config(name, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder for intermediate tables, one per application: under
    `spark.checkpoint.dir`. Only a session that runs in this one process does without
    that setting, and gets a temporary folder. It can be deleted once the application
    has ended."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="mercato-")
        context.setCheckpointDir(root)
        root = context.getCheckpointDir()
    return os.path.join(root, f"mercato-{context.applicationId}")


def fresh_folder(spark: SparkSession, label: str) -> str:
    return os.path.join(scratch_root(spark), f"{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut the lineage through a written table: every later reader sees the same
    rows even if executors are lost, and nothing upstream runs twice."""
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
