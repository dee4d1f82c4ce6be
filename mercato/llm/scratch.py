"""Written intermediate tables in the folder that the session shares."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session. Only a session that runs in this one
    process (tests) does without that setting; a folder is made and set for it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.sparkContext.setCheckpointDir(root)
    return root


class Scratch:
    """Tables of one operator call. Writing cuts the lineage: later readers see the
    same rows even if executors are lost. `drop` removes a table that nothing later
    reads any more."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._scratch_path = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(conf).delete(path, True)

    def release(self) -> None:
        """Let Spark delete shuffle files that nothing refers to any more, rather than
        at its next garbage collection."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
