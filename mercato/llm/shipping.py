"""Python functions over Arrow batches, with this package's code sent to the workers."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

ARCHIVE = "mercato_code.zip"
# Rows of a batch between Spark and a worker, unless the session has its own number:
# whole texts are in them, and each task holds a batch several times.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
SPARKS_ROWS, BATCH_ROWS = "10000", "2000"


def ship(spark: SparkSession) -> None:
    """Workers import the package from an archive added once to the application."""
    context = spark.sparkContext
    if spark.conf.get(BATCH) == SPARKS_ROWS:
        spark.conf.set(BATCH, BATCH_ROWS)
    if getattr(context, "_mercato_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="mercato-code-"), ARCHIVE)
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    context._mercato_shipped = True


def give_back() -> None:
    """Free memory of this worker goes back to the system: a worker lives on beside the
    tasks that need none of it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def tidy(function: Callable) -> Callable:
    """`function` over the batches of a task, which keeps no free memory behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(tidy(function), schema)
