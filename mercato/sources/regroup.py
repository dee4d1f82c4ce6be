"""Rows of one partition together, by way of files instead of a shuffle.

Each task writes what it has of each partition; then a partition's files are read together
and written as a few large ones. Files hold a column's values side by side, so wide rows that
repeat their values take about a third of what they take in a shuffle."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.sources import versions

# What one task reads, and about what a file of the result takes.
SHARE = 24 * 1024 * 1024


def partition_bytes(spark: SparkSession, folder: str, depth: int) -> dict[str, int]:
    """Bytes of each partition, as its folders name it. One entry for each comes to the driver."""
    out = {}
    for place in versions._inside(spark, folder, depth):
        system, path = versions._files(spark, place)
        out["/".join(place.split("/")[-depth:])] = system.getContentSummary(path).getLength()
    return out


def is_partition(partition: str, kinds: Mapping[str, str]) -> Column:
    """Whether a row is of `year=1997/month=4`."""
    tests = []
    for step in partition.split("/"):
        column, _, raw = step.partition("=")
        value = F.lit(unquote(raw)).cast(kinds[column])
        tests.append(F.col(column).isNull() if raw == versions.NO_VALUE else F.col(column) == value)
    return reduce(and_, tests)


def shares(sizes: Mapping[str, int], share: int) -> list[tuple[list[str], int]]:
    """Partitions that are read together and by how many tasks: a large one by several, small
    ones several by two. One task alone only if it reads them all, as Spark lets the single
    tasks of a union run as one."""
    out, small, filled = [], [], 0
    if sum(sizes.values()) <= share:
        return [(sorted(sizes), 1)] if sizes else []
    for partition, size in sorted(sizes.items()):
        if size > share:
            out.append(([partition], math.ceil(size / share)))
            continue
        if filled + size > 2 * share:
            out.append((small, 2))
            small, filled = [], 0
        small.append(partition)
        filled += size
    return [*out, (small, 2)] if small else out


def by_files(df: DataFrame, columns: Sequence[str], folder: str, share: int | None = None) -> DataFrame:
    """The rows of the frame, those of a partition in few tasks. They are written to the
    folder, which the frame that is returned reads."""
    spark = df.sparkSession
    df.write.partitionBy(*columns).parquet(folder)
    written = spark.read.schema(df.schema).parquet(folder).select(*df.columns)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    groups = shares(partition_bytes(spark, folder, len(columns)), share or SHARE)
    if len(groups) < 2:
        return written.coalesce(groups[0][1]) if groups else written
    some = [written.where(reduce(or_, [is_partition(p, kinds) for p in names])).coalesce(n) for names, n in groups]
    return reduce(DataFrame.unionAll, some)


def remove(spark: SparkSession, folder: str) -> None:
    system, path = versions._files(spark, folder)
    system.delete(path, True)
